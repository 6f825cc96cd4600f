"""Exploratory profile of a price table as one long report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass.operators import profile as p
from stayglass.operators.rows import tukey_fences, union_by_name


def price_profile(df: DataFrame, price: str, numeric: Sequence[str], categories: Sequence[str],
                  bins: Mapping[str, tuple[Sequence[float], Sequence[str]]] | None = None,
                  flags: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows (section, item, metric, value): target statistics, correlations, trend lines,
    category figures, binned means and flag premiums.

    Statistics that need no order share one aggregate; quantiles come from exact selection.
    """
    c = F.col(price)
    target = df.where(c.isNotNull()).agg(
        F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.skewness(c).alias("skewness"), F.kurtosis(c).alias("kurtosis"),
        F.skewness(F.log1p(c)).alias("log_skewness"), F.kurtosis(F.log1p(c)).alias("log_kurtosis"),
    )
    k2, pvalue = p.normality(F.col("skewness"), F.col("kurtosis"), F.col("n"))
    target = target.withColumns({"k2": k2, "p_value": pvalue})
    parts = [_long(target, "target"), _long(tukey_fences(df, price), "quartiles")]
    parts.append(p.correlation_ranking(df, numeric, price).select(
        F.lit("correlation").alias("section"), F.col("feature").alias("item"), F.lit("r").alias("metric"),
        F.col("r").alias("value"),
    ))
    for x in numeric:
        parts.append(_long(p.trend_line(df, price, x), "trend", x))
    for category in categories:
        stats = p.category_stats(df, category, price)
        parts.append(stats.select(
            F.lit(f"category:{category}").alias("section"), F.col(category).cast("string").alias("item"),
            F.explode(F.map_from_arrays(
                F.array(*[F.lit(m) for m in ("mean", "median", "n")]),
                F.array("mean", "median", F.col("n").cast("double")),
            )).alias("metric", "value"),
        ))
    for measure, (edges, labels) in (bins or {}).items():
        parts.append(p.binned_profile(df, F.col(measure), edges, labels, price).select(
            F.lit(f"bins:{measure}").alias("section"), F.col("bin").alias("item"),
            F.explode(F.map_from_arrays(
                F.array(*[F.lit(m) for m in ("mean", "median", "n")]),
                F.array("mean", "median", F.col("n").cast("double")),
            )).alias("metric", "value"),
        ))
    for name, test in (flags or {}).items():
        parts.append(_long(p.group_premium(df, test, price), "premium", name))
    report = union_by_name(*parts)
    return report.select("section", "item", "metric", F.round("value", 4).alias("value"))


def _long(row: DataFrame, section: str, item: str = "") -> DataFrame:
    doubles = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns])
    return doubles.unpivot([], doubles.columns, "metric", "value").select(
        F.lit(section).alias("section"), F.lit(item).alias("item"), "metric", "value"
    )
