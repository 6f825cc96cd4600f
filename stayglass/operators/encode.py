"""Encoders fitted on training rows, as DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass.operators.columns import quoted
from stayglass.operators.ranks import global_row_number


def standardize(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """``(x - mean) / population std`` as ``<column>_std``; 0 for a constant column."""
    facts = (df if fit_on is None else fit_on).agg(
        F.struct(*[
            F.struct(F.avg(quoted(c)).alias("mean"), F.stddev_pop(quoted(c)).alias("std")).alias(f"s{i}")
            for i, c in enumerate(columns)
        ])
    ).scalar()
    scaled = {
        f"{c}_std": F.when(F.col(f"_f.s{i}.std") > 0, (F.col(quoted(c)) - F.col(f"_f.s{i}.mean")) / F.col(f"_f.s{i}.std"))
        .otherwise(F.when(F.col(quoted(c)).isNotNull(), F.lit(0.0)))
        for i, c in enumerate(columns)
    }
    return df.withColumn("_f", facts).withColumns(scaled).drop("_f")


def category_codes(train: DataFrame, column: str) -> DataFrame:
    """Distinct non-null training categories with their 0-based position in sorted order."""
    names = train.select(quoted(column)).where(F.col(quoted(column)).isNotNull()).distinct()
    return global_row_number(names, [column], "_code").withColumn("_code", F.col("_code") - 1)


def label_encode(df: DataFrame, train: DataFrame, column: str, name: str) -> DataFrame:
    """Sorted code of the training categories; categories not seen there get 0."""
    return df.join(category_codes(train, column), column, "left").withColumn(
        name, F.coalesce("_code", F.lit(0).cast("bigint"))
    ).drop("_code")


def one_hot_position(df: DataFrame, train: DataFrame, column: str, name: str) -> DataFrame:
    """Index of the 1 in the one-hot vector without its first category, null when all are 0.

    The vector has (categories - 1) entries; the first category in sorted order and unseen ones
    are all zeros.
    """
    return df.join(category_codes(train, column), column, "left").withColumn(
        name, F.when(F.col("_code") > 0, F.col("_code") - 1)
    ).drop("_code")
