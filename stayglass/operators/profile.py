"""Distribution, category and correlation profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass.functions.buckets import bucket_right_closed
from stayglass.operators.comoments import correlations
from stayglass.operators.quantiles import exact_quantiles, values_at_ranks
from stayglass.operators.rows import in_top_categories, top_k, union_by_name


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """One row: total, missing, min, max, mean, median, std."""
    c = F.col(column)
    median = exact_quantiles(df, column, {"median": 0.5}).scalar()
    return df.agg(
        F.count(c).alias("total"),
        F.count_if(c.isNull()).alias("missing"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
    ).withColumn("median", median)


def moments(df: DataFrame, column: Column, prefix: str = "") -> DataFrame:
    """One row: n, population skewness, excess kurtosis."""
    return df.agg(
        F.count(column).alias(f"{prefix}n"),
        F.skewness(column).alias(f"{prefix}skewness"),
        F.kurtosis(column).alias(f"{prefix}kurtosis"),
    )


def sample_skewness(skewness: Column, n: Column) -> Column:
    """Bias-adjusted skewness from the population one; null below three values."""
    n = n.cast("double")
    return F.when(n >= 3, skewness * F.sqrt(n * (n - 1)) / (n - 2))


def normality(skewness: Column, kurtosis: Column, n: Column) -> tuple[Column, Column]:
    """D'Agostino-Pearson K-squared and its p-value from population skewness and excess kurtosis."""
    n = n.cast("double")
    y = skewness * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    z1 = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(F.log(w2) / 2)

    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    q = (kurtosis + 3 - expected) / F.sqrt(variance)
    b = (
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6 + 8 / b * (2 / b + F.sqrt(1 + 4 / (b * b)))
    ratio = (1 - 2 / a) / (1 + q * F.sqrt(2 / (a - 4)))
    z2 = (1 - 2 / (9 * a) - F.cbrt(ratio)) / F.sqrt(2 / (9 * a))
    k2 = z1 * z1 + z2 * z2
    return k2, F.exp(-k2 / 2)


def log_transform_report(df: DataFrame, column: str) -> DataFrame:
    """Sample skewness before and after log1p, and the improvement."""
    c = F.col(column)
    return df.where(c.isNotNull()).agg(
        F.count(c).alias("n"),
        F.skewness(c).alias("_s"),
        F.skewness(F.log1p(c)).alias("_ls"),
    ).select(
        "n",
        sample_skewness(F.col("_s"), F.col("n")).alias("skew"),
        sample_skewness(F.col("_ls"), F.col("n")).alias("log_skew"),
    ).withColumn("improvement", F.abs("skew") - F.abs("log_skew"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def category_stats(df: DataFrame, category: str, value: str) -> DataFrame:
    """Per category: mean, median, std (sample), n - two decimals."""
    known = df.where(F.col(category).isNotNull())
    stats = known.groupBy(category).agg(
        F.round(F.avg(value), 2).alias("mean"),
        F.round(F.stddev_samp(value), 2).alias("std"),
        F.count(value).alias("n"),
    )
    medians = exact_quantiles(known, value, {"_median": 0.5}, [category])
    return stats.join(medians, category, "left").select(
        category, "mean", F.round("_median", 2).alias("median"), "std", "n"
    )


def category_spread(df: DataFrame, category: str, value: str) -> DataFrame:
    """Highest against lowest category mean (two decimals), absolute and in percent."""
    means = df.where(F.col(category).isNotNull()).groupBy(category).agg(
        F.round(F.avg(value), 2).alias("mean")
    )
    name = F.col(category)
    low, high = F.min("mean"), F.max("mean")
    return means.where("mean IS NOT NULL").agg(
        F.min_by(name, F.struct(-F.col("mean"), name)).alias("highest"),
        F.min_by(name, F.struct(F.col("mean"), name)).alias("lowest"),
        (high - low).alias("spread"),
        (F.try_divide(high - low, low) * 100).alias("spread_pct"),
    )


def ranked_categories(stats: DataFrame, category: str, k: int) -> DataFrame:
    """The k categories with the highest mean, numbered from 1."""
    top = top_k(stats, k, F.desc_nulls_last("mean"), F.asc(category))
    numbered = top.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("mean")).alias("_m"), F.col(category), F.col("mean"), F.col("n")))).alias("_all")
    )
    return numbered.select(F.posexplode("_all").alias("_pos", "r")).select(
        (F.col("_pos") + 1).cast("bigint").alias("rank"), f"r.{category}", "r.mean", "r.n"
    )


def group_premium(df: DataFrame, flag: Column, value: str) -> DataFrame:
    """Mean where the flag holds minus mean where it does not, and in percent of the latter."""
    facts = df.agg(
        F.avg(F.when(flag, F.col(value))).alias("mean_with"),
        F.avg(F.when(~flag, F.col(value))).alias("mean_without"),
    )
    gap = F.col("mean_with") - F.col("mean_without")
    return facts.select(
        "mean_with", "mean_without", gap.alias("premium"),
        (F.try_divide(gap, F.col("mean_without")) * 100).alias("premium_pct"),
    )


def binned_profile(df: DataFrame, measure: Column, edges: Sequence[float], labels: Sequence[str],
                   value: str) -> DataFrame:
    """Per right-closed bin: mean, median, n; bins without rows appear with n = 0."""
    binned = df.select(
        bucket_right_closed(measure, edges, labels).alias("bin"), F.col(value).alias("_v")
    ).where("bin IS NOT NULL AND _v IS NOT NULL")
    stats = binned.groupBy("bin").agg(F.avg("_v").alias("mean"), F.count("_v").alias("n"))
    medians = exact_quantiles(binned, "_v", {"median": 0.5}, ["bin"])
    spark = df.sparkSession
    bins = spark.createDataFrame([(i, b) for i, b in enumerate(labels)], "bin_no bigint, bin string")
    return (
        bins.join(stats, "bin", "left").join(medians, "bin", "left")
        .select("bin_no", "bin", F.round("mean", 2).alias("mean"), F.round("median", 2).alias("median"),
                F.coalesce("n", F.lit(0)).alias("n"))
    )


def strength_label(r: Column) -> Column:
    size = F.abs(r)
    return (
        F.when(size > 0.3, "strong").when(size > 0.15, "moderate").when(size > 0.05, "weak")
        .otherwise("minimal")
    )


def pearson(x: str | Column, y: str | Column) -> Column:
    """Correlation over the rows that have both; null when either is constant there.

    ``corr`` itself fails on a constant column in ANSI mode.
    """
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlation_ranking(df: DataFrame, features: Sequence[str], target: str, min_rows: int = 10) -> DataFrame:
    """Pearson r with the target on pairwise complete rows, one row per feature with enough rows.

    Rows with a null or NaN on either side are skipped per feature; all features share one scan.
    """
    found = correlations(df, list(features), [target]).withColumnRenamed("x", "feature")
    return found.where((F.col("n") > min_rows) & F.col("r").isNotNull()).select(
        "feature", "r", "n",
        strength_label(F.col("r")).alias("strength"),
        F.when(F.col("r") > 0, "positive").otherwise("negative").alias("direction"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form, all ordered pairs, in one scan.

    A varying column correlates with itself by 1; constant columns have no correlation.
    """
    itself = (F.col("x") == F.col("y")) & F.col("r").isNotNull()
    return correlations(df, list(columns), list(columns)).select("x", "y", F.when(itself, 1.0).otherwise(F.col("r")).alias("r"))


def trend_line(df: DataFrame, y: str, x: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def histogram(df: DataFrame, column: Column, bins: int = 50) -> DataFrame:
    """Equal-width bins over the value range, the last one closed: bin, low, high, n, density."""
    values = df.select(column.cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    span = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("total"))).scalar()
    # a single value gets a span of one around it
    flat = F.col("s.low") == F.col("s.high")
    low = F.when(flat, F.col("s.low") - 0.5).otherwise(F.col("s.low"))
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("s.high") - F.col("s.low")) / bins
    counts = (
        values.withColumn("s", span)
        .withColumn("bin", F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1).cast("bigint")))
        .groupBy("bin")
        .agg(F.count("v").alias("n"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return (
        all_bins.join(counts, "bin", "left")
        .withColumn("s", span)
        .select(
            "bin",
            (low + F.col("bin") * width).alias("low"),
            (low + (F.col("bin") + 1) * width).alias("high"),
            F.coalesce("n", F.lit(0)).alias("n"),
            (F.coalesce("n", F.lit(0)) / (F.col("s.total") * width)).alias("density"),
        )
    )


def boxplot_stats(df: DataFrame, category: str, value: str, k: int = 10) -> DataFrame:
    """Five numbers per category among the k most frequent: box and furthest values inside the fences."""
    top = in_top_categories(df, category, k).select(category, value).where(F.col(value).isNotNull())
    boxes = exact_quantiles(top, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [category])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col(value) >= F.col("q1") - reach) & (F.col(value) <= F.col("q3") + reach)
    return top.join(boxes, category).groupBy(category, "q1", "median", "q3").agg(
        F.count(value).alias("n"),
        F.min(F.when(inside, F.col(value))).alias("low_whisker"),
        F.max(F.when(inside, F.col(value))).alias("high_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def _tail(c: Sequence[float], d: Sequence[float], x: Column) -> Column:
    top = F.lit(c[0])
    for k in c[1:]:
        top = top * x + k
    bottom = F.lit(d[0])
    for k in d[1:]:
        bottom = bottom * x + k
    return top / bottom


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile by Acklam's rational approximation (relative error 1.2e-9)."""
    # fixed values: published coefficients
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01, 1.0]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00, 1.0]
    edge = 0.02425
    centre = p - 0.5
    low = F.sqrt(-2 * F.log(p))
    high = F.sqrt(-2 * F.log(1 - p))
    return (
        F.when(p < edge, _tail(c, d, low))
        .when(p > 1 - edge, -_tail(c, d, high))
        .otherwise(centre * _tail(a, b, centre * centre))
    )


def qq_points(df: DataFrame, column: str, points: int = 100) -> DataFrame:
    """Ordered values against normal quantiles at ``points`` evenly spread ranks.

    The ranks run over all values and use Filliben's medians; only the picked order statistics
    leave the distributed selection.
    """
    def ranks(total: Column) -> list[Column]:
        return [F.floor((total - 1) * F.lit(i) / F.lit(points - 1)).cast("bigint") for i in range(points)]

    names = [f"v{i}" for i in range(points)]
    picked = values_at_ranks(df, column, ranks, names)
    n = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).agg(
        F.count(F.lit(1))
    ).scalar()
    long = picked.select(F.posexplode(F.array(*names)).alias("point", "ordered_value")).withColumn("n", n)
    i = F.floor((F.col("n") - 1) * F.col("point") / F.lit(points - 1)) + 1
    median_rank = (
        F.when(i == F.col("n"), F.pow(F.lit(0.5), 1.0 / F.col("n")))
        .when(i == 1, 1.0 - F.pow(F.lit(0.5), 1.0 / F.col("n")))
        .otherwise((i - 0.3175) / (F.col("n") + 0.365))
    )
    return long.select(
        F.col("point").cast("bigint").alias("point"),
        i.cast("bigint").alias("rank"),
        inverse_normal(median_rank).alias("normal_quantile"),
        "ordered_value",
    )


def normal_curve(df: DataFrame, column: str, points: int = 100) -> DataFrame:
    """Fitted normal density (population std) on an even grid over the value range."""
    fit = df.agg(
        F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"),
        F.avg(column).alias("mu"), F.stddev_pop(column).alias("sigma"),
    )
    x = F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / F.lit(float(points - 1))
    z = (F.col("x") - F.col("mu")) / F.col("sigma")
    return (
        fit.withColumn("point", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint"))))
        .withColumn("x", x)
        .select("point", "x", (F.exp(-z * z / 2) / (F.col("sigma") * F.sqrt(2 * F.pi()))).alias("density"))
    )


def skew_label(c: Column) -> Column:
    return (
        F.when(c > 1, "highly right-skewed").when(c > 0.5, "moderately right-skewed")
        .when(c > -0.5, "approximately symmetric").when(c.isNotNull(), "left-skewed")
    )


def kurtosis_label(c: Column) -> Column:
    return (
        F.when(c > 3, "heavy-tailed").when(c < -1, "light-tailed")
        .when(c.isNotNull(), "normal tails")
    )


def transform_label(skew: Column) -> Column:
    size = F.abs(skew)
    return F.when(size > 1, "log recommended").when(size > 0.5, "consider log").otherwise("original scale")


def log_label(skew: Column, log_skew: Column) -> Column:
    helps = (F.abs(log_skew) < F.abs(skew)) & (F.abs(log_skew) < 0.5)
    return F.when(helps, "use log1p").otherwise("minimal improvement")


def outlier_label(pct: Column) -> Column:
    return F.when(pct > 5, "high").otherwise("manageable")


def pattern_label(r: Column, up: str, down: str, none: str) -> Column:
    return F.when(r > 0.1, up).when(r < -0.1, down).otherwise(none)


def profile_labels(df: DataFrame, column: str) -> DataFrame:
    """One row of verbal findings about a price column."""
    c = F.col(column)
    fences = exact_quantiles(df, column, {"q1": 0.25, "q3": 0.75}).agg(
        F.struct(
            F.max(F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("low"),
            F.max(F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("high"),
        )
    ).scalar()
    known = df.where(c.isNotNull()).select(c.alias("v")).withColumn("f", fences)
    out = (F.col("v") < F.col("f.low")) | (F.col("v") > F.col("f.high"))
    facts = known.agg(
        F.count("v").alias("n"),
        F.skewness("v").alias("skew"),
        F.kurtosis("v").alias("kurt"),
        F.skewness(F.log1p("v")).alias("log_skew"),
        (F.count_if(out) * 100.0 / F.count("v")).alias("outlier_pct"),
    )
    _, p = normality(F.col("skew"), F.col("kurt"), F.col("n"))
    return facts.select(
        "n",
        skew_label(F.col("skew")).alias("skew_label"),
        kurtosis_label(F.col("kurt")).alias("kurtosis_label"),
        F.when(p < 0.05, "not normal").otherwise("normal").alias("normality_label"),
        transform_label(F.col("skew")).alias("transform_label"),
        log_label(F.col("skew"), F.col("log_skew")).alias("log_label"),
        F.round("outlier_pct", 4).alias("outlier_pct"),
        outlier_label(F.col("outlier_pct")).alias("outlier_label"),
    )


def daily_counts(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def daily_volume_stats(df: DataFrame, day: str) -> DataFrame:
    """Date range, span, distinct days and the spread of daily counts."""
    return daily_counts(df, day).agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        (F.datediff(F.max("day"), F.min("day")) + 1).cast("bigint").alias("span_days"),
        F.count("day").alias("days"),
        F.avg("n").alias("mean_n"),
        F.min("n").alias("min_n"),
        F.max("n").alias("max_n"),
        F.stddev_samp("n").alias("std_n"),
    )


def busiest_and_quietest(df: DataFrame, day: str, k: int = 3) -> DataFrame:
    counts = daily_counts(df, day)
    busiest = top_k(counts, k, F.desc("n"), F.asc("day")).withColumn("kind", F.lit("busiest"))
    quietest = top_k(counts, k, F.asc("n"), F.asc("day")).withColumn("kind", F.lit("quietest"))
    return busiest.unionByName(quietest)


def regression_metrics(df: DataFrame, log_true: str, log_pred: str, true: str, pred: str) -> DataFrame:
    """RMSE, MAE and R2 on both scales, MAPE - one aggregate."""
    return df.agg(*metric_columns(log_true, log_pred, true, pred))


def metric_columns(log_true: str, log_pred: str, true: str, pred: str) -> list[Column]:
    """The aggregates of ``regression_metrics``."""
    def trio(y: str, p: str, suffix: str) -> list[Column]:
        e = F.col(y) - F.col(p)
        spread = F.var_pop(y) * F.count(y)
        return [
            F.sqrt(F.avg(e * e)).alias(f"rmse_{suffix}"),
            F.avg(F.abs(e)).alias(f"mae_{suffix}"),
            (1 - F.try_divide(F.sum(e * e), spread)).alias(f"r2_{suffix}"),
        ]

    share = F.try_divide(F.col(true) - F.col(pred), F.col(true))
    return [
        *trio(log_true, log_pred, "log"), *trio(true, pred, "orig"),
        (F.avg(F.abs(share)) * 100).alias("mape"),
        F.count(F.lit(1)).alias("n"),
    ]
