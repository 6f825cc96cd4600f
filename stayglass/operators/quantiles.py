"""Exact order statistics without gathering a group in one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one buffer. Here the
values are first counted per (group, value) - a hot group is spread over its values and shrinks
map-side - then cut into bins at approximate quantiles, and only the bins that hold a wanted rank
are sorted. The approximate cuts steer the work; the result is exact whatever they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayglass.session import work_path

STEP = 16  # cuts between two that are looked at first
BINS = 256  # a sorted slice holds about this share of the distinct values of its group


def _ranked_values(df: DataFrame, value: Column, by: Sequence[str], ranks_of) -> DataFrame:
    """Columns: by, _v, _n (rows with that value), _total, _end (rows up to and with it).

    Holds at least the values at the zero-based ranks ``ranks_of(total)``.
    """
    by = list(by)
    clean = df.select(*by, value.alias("_v")).where("_v IS NOT NULL")
    # one scan of the input; what follows reads the counts, written once
    path = work_path(df.sparkSession, "value-counts")
    clean.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n")).write.parquet(path)
    counted = df.sparkSession.read.parquet(path)
    facts = [
        F.percentile_approx("_v", [i / BINS for i in range(1, BINS)], 16 * BINS).alias("_cuts"),
        F.sum("_n").alias("_total"),
    ]
    keys = [f"_k{i}" for i in range(len(by))]
    if by:
        per_group = counted.groupBy(*[F.col(c).alias(k) for c, k in zip(by, keys)]).agg(*facts)
        located = counted.join(per_group, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, keys)]).drop(*keys)
    else:
        whole = counted.agg(F.struct(*facts).alias("f")).select("f").scalar()
        located = counted.withColumn("_f", whole).select("_v", "_n", "_f._cuts", "_f._total")
    located = located.withColumn("_bin", _position(F.col("_cuts"), F.col("_v"))).drop("_cuts")

    # at most BINS rows per group reach this window
    before = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    bins = located.groupBy(*by, "_bin").agg(F.sum("_n").alias("_bin_n"), F.max("_total").alias("_bin_total"))
    running = F.sum("_bin_n").over(before.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.withColumn("_start", running - F.col("_bin_n"))
    holds = reduce(lambda a, b: a | b, [
        (F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_bin_n"))
        for rank in ranks_of(F.col("_bin_total"))
    ])
    wanted = bins.where(holds).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], F.col("_bin").alias("_b"), "_start"
    )
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, keys)]
    kept = located.join(wanted, [*same, F.col("_bin") == F.col("_b")])
    in_bin = Window.partitionBy(*by, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return kept.select(*by, "_v", "_n", "_total", (F.col("_start") + F.sum("_n").over(in_bin)).alias("_end"))


def _position(cuts: Column, value: Column) -> Column:
    """How many of the ascending cuts are below the value: first among every ``STEP``-th cut, then between two of those."""
    # repeated cuts are all below the value or none is, so the coarse ones that are below it come first
    coarse = F.filter(F.array(*[F.get(cuts, F.lit(i)) for i in range(STEP - 1, BINS - 1, STEP)]), lambda cut: cut < value)
    start = F.size(coarse) * STEP
    return start + F.size(F.filter(F.slice(cuts, start + 1, F.lit(STEP)), lambda cut: cut < value))


def exact_quantiles(df: DataFrame, value: Column | str, quantiles: dict[str, float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles: ``by`` columns plus one column per entry of ``quantiles``.

    Groups without a value are absent from the result.
    """
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    value = F.when(~F.isnan(value), value)

    def edge(p: float, total: Column, up: bool) -> Column:
        position = F.lit(float(p)) * (total - 1)
        return F.ceil(position) if up else F.floor(position)

    ranked = _ranked_values(
        df, value, by,
        lambda total: [edge(p, total, up) for p in quantiles.values() for up in (False, True)],
    )
    total = F.col("_total")
    found = []
    for name, p in quantiles.items():
        for up in (False, True):
            hit = F.when(F.col("_end") > edge(p, total, up), F.col("_v"))
            found.append(F.min(hit).alias(f"_{name}_{'hi' if up else 'lo'}"))
    picked = ranked.groupBy(*by).agg(F.max("_total").alias("_total"), *found)
    result = []
    for name, p in quantiles.items():
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        position = F.lit(float(p)) * (total - 1)
        result.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return picked.select(*by, *result)


def values_at_ranks(df: DataFrame, value: Column | str, ranks_of, names: Sequence[str]) -> DataFrame:
    """One row with the values at the zero-based ranks ``ranks_of(total)``, named ``names``."""
    value = F.col(value) if isinstance(value, str) else value
    ranked = _ranked_values(df, value, (), ranks_of)
    hits = [
        F.min(F.when(F.col("_end") > rank, F.col("_v"))).alias(name)
        for rank, name in zip(ranks_of(F.col("_total")), names)
    ]
    return ranked.agg(*hits)
