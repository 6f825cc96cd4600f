"""Train / validation / test splits and their reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass.operators.profile import value_counts
from stayglass.operators.ranks import hash_cut, hash_cuts, order_hash
from stayglass.operators.rows import top_k

SEED = 42


def random_split(df: DataFrame, key: str, held_out: float = 0.4, test_share: float = 0.5,
                 seed: int = SEED, name: str = "split") -> DataFrame:
    """Exact-size random split by hash order of a unique key.

    ``ceil(held_out * n)`` rows are held out, of those ``ceil(test_share * held)`` are test rows.
    The rows themselves are never shuffled: a scan finds the cut hashes, then each row is
    labelled on its own.
    """
    first, second = order_hash(F.col(key), seed), order_hash(F.col(key), seed + 1)
    both = hash_cuts(df, first, second, held_out, test_share)
    cut = both[0] if both else hash_cut(df.select(first.alias("h")), lambda n: n - F.ceil(F.lit(held_out) * n))
    in_train = F.coalesce(F.col("_h") < F.col("_cut"), F.lit(True))
    marked = df.withColumn("_h", first).withColumn("_cut", cut).withColumn("_train", in_train)
    if both:
        test_cut = both[1]
    else:
        held = marked.where(~F.col("_train")).select(second.alias("h"))
        test_cut = hash_cut(held, lambda n: n - F.ceil(F.lit(test_share) * n))
    in_val = F.coalesce(second < F.col("_cut2"), F.lit(True))
    return (
        marked.withColumn("_cut2", test_cut)
        .withColumn(name, F.when(F.col("_train"), "train").when(in_val, "val").otherwise("test"))
        .drop("_h", "_cut", "_train", "_cut2")
    )


def time_split(df: DataFrame, day: str, key: str, boundary: dt.date, val_share: float = 0.35,
               seed: int = SEED, name: str = "split") -> DataFrame:
    """Before the boundary train, after it test; the boundary day is divided at random.

    ``floor(val_share * n)`` rows of the boundary day validate, the rest test. A null day gets no
    split.
    """
    h = order_hash(F.col(key), seed)
    on_day = F.col(day) == F.lit(boundary)
    cut = hash_cut(df.where(on_day).select(h.alias("h")), lambda n: F.floor(F.lit(val_share) * n))
    in_val = F.coalesce(h < F.col("_cut"), F.lit(True))
    return (
        df.withColumn("_cut", cut)
        .withColumn(
            name,
            F.when(F.col(day) < F.lit(boundary), "train")
            .when(on_day & in_val, "val")
            .when(F.col(day).isNotNull(), "test"),
        )
        .drop("_cut")
    )


def split_balance(df: DataFrame, price: str, day: str, flag: Column, category: str,
                  name: str = "split") -> DataFrame:
    """Per split: rows, target mean and spread on both scales, dates, share of the flag, top category."""
    stats = df.groupBy(name).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(price), 2).alias("price_mean"),
        F.round(F.stddev_samp(price), 2).alias("price_std"),
        F.round(F.avg(F.log1p(price)), 4).alias("log_mean"),
        F.round(F.stddev_samp(F.log1p(price)), 4).alias("log_std"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.countDistinct(day).alias("days"),
        F.round(F.count_if(flag) * 100.0 / F.count(F.lit(1)), 4).alias("flag_pct"),
    )
    counts = df.where(F.col(category).isNotNull()).groupBy(name, category).agg(F.count(F.lit(1)).alias("_k"))
    top = counts.groupBy(name).agg(
        F.min_by(F.struct(category, "_k"), F.struct(-F.col("_k"), F.col(category))).alias("_top")
    )
    return stats.join(top, name, "left").select(
        *stats.columns,
        F.col(f"_top.{category}").alias("top_category"),
        F.round(F.col("_top._k") * 100.0 / F.col("n"), 4).alias("top_category_pct"),
    )


def distribution_overview(df: DataFrame, price: str, flags: dict[str, Column], categories: Sequence[str]) -> DataFrame:
    """One row before splitting: target stats, flag shares, top category and its share per column."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.log1p(price)).alias("log_mean"),
        F.stddev_samp(F.log1p(price)).alias("log_std"),
        F.avg(price).alias("price_mean"),
        F.stddev_samp(price).alias("price_std"),
        *[(F.count_if(c) * 100.0 / F.count(F.lit(1))).alias(f"{k}_pct") for k, c in flags.items()],
    )
    for c in categories:
        top = top_k(value_counts(df, c), 1, F.desc("n"), F.asc(c)).agg(
            F.max(F.struct(c, "n")).alias("t")
        ).scalar()
        row = row.withColumn("_t", top).withColumns({
            f"top_{c}": F.col(f"_t.{c}"),
            f"top_{c}_pct": F.col("_t.n") * 100.0 / F.col("n"),
        }).drop("_t")
    return row


def coverage_check(parts: DataFrame, key: str, name: str = "split") -> DataFrame:
    """One row: rows, rows without a split, keys in more than one split. Complete and disjoint
    when the last two are 0."""
    per_key = parts.groupBy(key).agg(F.countDistinct(name).alias("_splits"), F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
        F.count_if(F.col("_splits") == 0).alias("unassigned"),
        F.count_if(F.col("_splits") > 1).alias("overlapping"),
    )


def split_metadata(df: DataFrame, kind: str, seed: int, features: Sequence[str], name: str = "split") -> DataFrame:
    """One row: sizes, ratios, feature list."""
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        *[F.count_if(F.col(name) == s).alias(f"{s}_samples") for s in ("train", "val", "test")],
    ).select(
        F.lit(kind).alias("split_type"),
        F.lit(seed).cast("bigint").alias("random_state"),
        "total_samples", "train_samples", "val_samples", "test_samples",
        *[
            F.round(F.try_divide(F.col(f"{s}_samples"), F.col("total_samples")), 4).alias(f"{s}_ratio")
            for s in ("train", "val", "test")
        ],
        F.array(*[F.lit(f) for f in features]).alias("feature_columns"),
    )
