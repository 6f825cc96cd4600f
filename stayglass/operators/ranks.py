"""Positions in a global order, found without sorting everything in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayglass.operators.columns import quoted
from stayglass.operators.profile import daily_counts
from stayglass.operators.quantiles import values_at_ranks
from stayglass.session import use_checkpoints


def global_row_number(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """1-based position in the order; ``order`` has to be unique per row.

    Range partitions are sorted and numbered on their own, then shifted by the sizes of the
    partitions before them. The numbered rows are checkpointed to reliable storage first: both
    uses must see the same partitions, even if an executor is lost in between.
    """
    use_checkpoints(df.sparkSession)
    numbered = (
        df.repartitionByRange(*[quoted(c) for c in order])
        .sortWithinPartitions(*[quoted(c) for c in order])
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_at", 33)
    # one row per partition
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    local = F.col("_at") - F.shiftleft(part, 33)
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + local + 1)
        .drop("_part", "_start", "_at")
    )


def order_hash(column: Column, seed: int) -> Column:
    """Reproducible random order: md5 of seed and id."""
    return F.md5(F.concat(F.lit(f"{seed}|"), column.cast("string")))


def hash_cut(hashes: DataFrame, size_of: Callable[[Column], Column]) -> Column:
    """Literal: the hash at zero-based rank ``size_of(total)``; null when that is past the end.

    ``hashes`` has one hex text column ``h``, distinct per row. Counting by the first four digits
    finds the one slice in 65,536 that holds the rank; only that slice is sorted. The one value is
    read back here, so plans that use it don't scan the hashes again.
    """
    digits = hashes.select("h", F.substring("h", 1, 4).alias("_slice"))
    # 65,536 rows at most
    slices = digits.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        "_slice",
        "_n",
        (F.sum("_n").over(Window.orderBy("_slice")) - F.col("_n")).alias("_start"),
        size_of(F.sum("_n").over(Window.partitionBy(F.lit(0)))).cast("bigint").alias("_rank"),
    )
    target = slices.where("_start <= _rank AND _rank < _start + _n")
    position = F.row_number().over(Window.partitionBy("_slice").orderBy("h")) - 1 + F.col("_start")
    found = (
        digits.join(F.broadcast(target), "_slice")
        .withColumn("_position", position)
        .where("_position = _rank")
        .agg(F.max("h"))
        .first()
    )
    return F.lit(found[0]).cast("string")


def hash_cuts(df: DataFrame, first: Column, second: Column, held_out: float, test_share: float) -> tuple[Column, Column] | None:
    """``hash_cut`` of ``first`` over all rows, ``ceil(held_out * n)`` being held out, and of ``second`` over those, in one scan.

    Hashes are uniform, so the rank lies within a few deviations of its share; rows outside that are counted, those within
    come back, about 12 times the square root of the rows. None where a rank lies outside (null or much repeated keys).
    """
    n = df.count()
    if not n:
        return None

    def window(rank: int, total: int) -> tuple[str, str]:
        share = rank / total
        width = 5 * math.sqrt(max(share * (1 - share), 0.0) / total) + 10 / total
        low, high = (f"{int(min(max(x, 0.0), 1.0) * 2**48):012x}" for x in (share - width, share + width))
        return low, high if len(high) == 12 and share + width < 1 else "g"  # past all digits

    held = math.ceil(held_out * n)
    (low, high), (low2, high2) = window(n - held, n), window(held - math.ceil(test_share * held), held) if held else ("", "")
    h, h2 = F.col("_h"), F.col("_h2")
    part = (
        F.when(h.isNull() | (h < low), 0).when(h < high, 1)
        .when(h2 < low2, 2).when(h2 < high2, 3).otherwise(4)
    )
    near = F.col("_part")
    found = (
        df.select(first.alias("_h"), second.alias("_h2")).select(h, h2, part.alias("_part"))
        .groupBy("_part", F.when(near == 1, h).alias("_h"), F.when(near.isin(1, 3), h2).alias("_h2"))
        .agg(F.count(F.lit(1)).alias("_n")).toArrow().to_pylist()
    )

    def at_rank(values: list[tuple[str, int]], rank: int) -> str | None:
        for value, count in sorted(values):
            if 0 <= rank < count:
                return value
            rank -= count
        return None

    rows = [(r["_part"], r["_h"], r["_h2"], r["_n"]) for r in found]
    cut = at_rank([(x, k) for p, x, _, k in rows if p == 1], n - held - sum(k for p, _, _, k in rows if p == 0))
    if cut is None:
        return None
    edge = [(x2, k) for p, x, x2, k in rows if p == 1 and x >= cut]
    held = sum(k for p, _, _, k in rows if p > 1) + sum(k for _, k in edge)
    below = sum(k for p, _, _, k in rows if p == 2) + sum(k for x2, k in edge if x2 < low2)
    within = [(x2, k) for p, _, x2, k in rows if p == 3] + [(x2, k) for x2, k in edge if low2 <= x2 < high2]
    cut2 = at_rank(within, held - math.ceil(test_share * held) - below)
    return None if cut2 is None else (F.lit(cut), F.lit(cut2))


def contiguous_folds(df: DataFrame, order: str, folds: int, name: str = "fold") -> DataFrame:
    """Unshuffled folds of equal size (the first ones take the remainder) along a unique number."""
    def starts(total: Column) -> list[Column]:
        base, rest = F.floor(total / folds), total % folds
        return [(F.lit(i) * base + F.least(F.lit(i), rest)).cast("bigint") for i in range(1, folds)]

    names = [f"c{i}" for i in range(1, folds)]
    cuts = values_at_ranks(df, order, starts, names).select(F.struct(*names)).scalar()
    fold = F.lit(0).cast("bigint")
    for c in names:
        fold = fold + F.when(F.col(order) >= F.col(f"_cuts.{c}"), 1).otherwise(0)
    return df.withColumn("_cuts", cuts).withColumn(name, fold).drop("_cuts")


def cumulative_share(df: DataFrame, day: str) -> DataFrame:
    """Per day: n, running total, running share in percent.

    The window runs over the daily counts, one row per calendar day.
    """
    counts = daily_counts(df, day)
    running = F.sum("n").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select(
        "day", "n", running.alias("running_n"), F.round(running * 100.0 / total, 4).alias("running_pct")
    )
