"""Row filters, fills, dedupe, set operations and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.functions import geo
from stayglass.operators.columns import quoted
from stayglass.operators.quantiles import exact_quantiles


def without_denied(df: DataFrame, column: str, denied: Sequence[str] = fv.DENIED_HOTELS) -> DataFrame:
    """Remove rows whose text equals a listed name, ignoring case; null stays."""
    hit = F.lower(F.col(quoted(column))).isin([d.lower() for d in denied])
    return df.where(~F.coalesce(hit, F.lit(False)))


def anti_join_denied(df: DataFrame, column: str, denied: DataFrame, denied_column: str) -> DataFrame:
    """Same for a deny-list held in a table of any size; Spark picks the join from its size."""
    names = denied.select(F.lower(F.col(quoted(denied_column))).alias("_denied")).distinct()
    return df.join(names, F.lower(F.col(quoted(column))) == F.col("_denied"), "left_anti")


def within_or_null(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    c = F.col(quoted(column))
    return df.where(F.coalesce(c.between(low, high), F.lit(True)))


def plausible(c: Column, low: float = fv.PLAUSIBLE_MILES[0], high: float = fv.PLAUSIBLE_MILES[1]) -> Column:
    return c.between(low, high)


def plausibility_report(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    c = F.col(quoted(column))
    return df.agg(
        F.count(c).alias("with_value"),
        F.count_if(plausible(c, low, high)).alias("plausible"),
        F.count_if(~plausible(c, low, high)).alias("implausible"),
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
    )


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill({k: v for k, v in values.items() if k in df.columns})


def tukey_fences(df: DataFrame, column: str) -> DataFrame:
    """One row: q1, q3, iqr, low_fence, high_fence."""
    iqr = F.col("q3") - F.col("q1")
    return exact_quantiles(df, column, {"q1": 0.25, "q3": 0.75}).select(
        "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - 1.5 * iqr).alias("low_fence"),
        (F.col("q3") + 1.5 * iqr).alias("high_fence"),
    )


def outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows outside the Tukey fences; the fences come in as one scalar subquery."""
    fences = tukey_fences(df, column).select(F.struct("low_fence", "high_fence").alias("f")).scalar()
    c = F.col(quoted(column))
    return (
        df.where(c.isNotNull())
        .withColumn("_f", fences)
        .where((c < F.col("_f.low_fence")) | (c > F.col("_f.high_fence")))
        .drop("_f")
    )


def fill_missing_distance(df: DataFrame, lat: str, lon: str, distance: str,
                          point: tuple[float, float]) -> DataFrame:
    """Miles to the reference point where the distance is missing and coordinates exist."""
    miles = geo.haversine_miles(F.col(lat), F.col(lon), F.lit(point[0]), F.lit(point[1]))
    return df.withColumn(distance, F.coalesce(F.col(quoted(distance)), miles))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order; null keys compare equal.

    ``order`` should be a total order; the remaining columns break any tie left, so the survivor
    does not depend on partitioning. Runs as an aggregate and not as a window, so copies of a hot
    key are reduced before the shuffle instead of meeting in one sorted task.
    """
    key = [k for k in key if k in df.columns]
    if not key:
        return df
    rest = [c for c in df.columns if c not in key]
    ranked = F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)],
        *[F.col(quoted(c)).alias(f"_c{i}") for i, c in enumerate(rest)],
    )
    first = df.groupBy(*[quoted(k) for k in key]).agg(F.min(ranked).alias("_first"))
    return first.select(
        *[F.col(quoted(c)) if c in key else F.col(f"_first._c{rest.index(c)}").alias(c) for c in df.columns]
    )


def union_by_name(*frames: DataFrame) -> DataFrame:
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f, allowMissingColumns=True)
    return result


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows in the order, as TakeOrderedAndProject; end ``order`` with a unique column."""
    return df.orderBy(*order).limit(k)


def top_categories(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, by name on ties: columns ``column``, n. At most k rows."""
    counts = df.where(F.col(quoted(column)).isNotNull()).groupBy(quoted(column)).agg(
        F.count(F.lit(1)).alias("n")
    )
    return top_k(counts, k, F.desc("n"), F.asc(quoted(column)))


def in_top_categories(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose category is among the k most frequent."""
    return df.join(top_categories(df, column, k).select(quoted(column)), column, "left_semi")


def collapse_to_top(df: DataFrame, column: str, k: int, result: str, other: str = "other") -> DataFrame:
    """Keep the k most frequent categories, everything else (null too) becomes ``other``."""
    kept = top_categories(df, column, k).agg(F.collect_list(quoted(column)).alias("kept")).scalar()
    c = F.col(quoted(column))
    return df.withColumn(
        result, F.when(F.coalesce(F.array_contains(kept, c), F.lit(False)), c).otherwise(other)
    )
