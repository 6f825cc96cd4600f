"""Distribution, category, correlation and volume profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.catalog.registry import STAYS, bucket_sql, rd, register, tidy
from stayglass.catalog.source_queries import RANDOM_SPLIT
from stayglass.operators import columns as cols
from stayglass.operators import profile as p
from stayglass.operators import splits
from stayglass.operators.quantiles import exact_quantiles
from stayglass.operators.rows import tukey_fences
from stayglass.sources import tables as t

NUMERIC = ["l_quantity", "l_discount", "l_tax", "l_partkey", "l_suppkey"]


def lines(spark, folder):
    """Line items with some discounts missing."""
    return t.table(spark, folder, "lineitem").withColumn(
        "l_discount", F.when(F.col("l_partkey") % 6 != 0, F.col("l_discount"))
    )


LINES = "lines AS (SELECT * REPLACE (CASE WHEN l_partkey % 6 <> 0 THEN l_discount END AS l_discount) FROM lineitem)"


@register("value_counts", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, folder):
    return p.value_counts(t.stays(spark, folder), "status")


def _category_sql(where: str = "") -> str:
    return f"""
SELECT room, {rd('avg(price)', 2)} AS mean, {rd('quantile_cont(price, 0.5)', 2)} AS median,
       {rd('stddev_samp(price)', 2)} AS std, count(price) AS n FROM stays {where} GROUP BY room"""


@register("category_stats", f"WITH {STAYS} {_category_sql()}")
def category_stats(spark, folder):
    return p.category_stats(t.stays(spark, folder), "room", "price")


@register("category_spread", f"""
WITH {STAYS}, s AS ({_category_sql()}), o AS (SELECT * FROM s ORDER BY mean DESC, room)
SELECT (SELECT room FROM s ORDER BY mean DESC, room LIMIT 1) AS highest, (SELECT room FROM s ORDER BY mean, room LIMIT 1) AS lowest,
       {rd('max(mean) - min(mean)')} AS spread, {rd('(max(mean) - min(mean)) / min(mean) * 100')} AS spread_pct FROM s""")
def category_spread(spark, folder):
    return tidy(p.category_spread(t.stays(spark, folder), "room", "price"))


@register("group_premium", f"""
WITH {STAYS}, g AS (SELECT avg(price) FILTER (isodow(checkin) >= 6) AS a, avg(price) FILTER (isodow(checkin) < 6) AS b FROM stays)
SELECT {rd('a')} AS mean_with, {rd('b')} AS mean_without, {rd('a - b')} AS premium, {rd('(a - b) / b * 100')} AS premium_pct FROM g""")
def group_premium(spark, folder):
    return tidy(p.group_premium(t.stays(spark, folder), F.weekday("checkin") >= 5, "price"))


# no stay is booked more than 200 days ahead, so the last bin stays empty
LEAD_PROFILE = ([-1, 0, 7, 30, 90, 200, float("inf")], [*fv.LEAD_BINS[1], "beyond"])


@register("binned_profile", f"""
WITH {STAYS}, b AS (SELECT {bucket_sql('(checkin - snapshot)', *LEAD_PROFILE)} AS bin, price FROM stays),
s AS (SELECT bin, avg(price) AS mean, quantile_cont(price, 0.5) AS median, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY bin),
d(bin_no, bin) AS (VALUES {", ".join(f"({i}, '{b}')" for i, b in enumerate(LEAD_PROFILE[1]))})
SELECT CAST(bin_no AS BIGINT) AS bin_no, d.bin, {rd('mean', 2)} AS mean, {rd('median', 2)} AS median, coalesce(n, 0) AS n
FROM d LEFT JOIN s USING (bin)""")
def binned_profile(spark, folder):
    lead = F.datediff("checkin", "snapshot")
    return p.binned_profile(t.stays(spark, folder), lead, *LEAD_PROFILE, "price")


@register("describe_column", f"""
WITH {STAYS}, x AS (SELECT CASE WHEN stay_id % 17 <> 0 THEN price END AS price FROM stays)
SELECT count(price) AS total, count(*) - count(price) AS missing, min(price) AS min, max(price) AS max, {rd('avg(price)')} AS mean,
       {rd('stddev_samp(price)')} AS std, {rd('quantile_cont(price, 0.5)')} AS median FROM x""")
def describe_column(spark, folder):
    priced = t.stays(spark, folder).select(F.when(F.col("stay_id") % 17 != 0, F.col("price")).alias("price"))
    return tidy(p.describe_column(priced, "price"))


QUARTILES = "q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)"


@register("quartiles", f"""
WITH {QUARTILES} SELECT {rd('q1')} AS q1, {rd('q3')} AS q3, {rd('q3 - q1')} AS iqr,
  {rd('q1 - 1.5 * (q3 - q1)')} AS low_fence, {rd('q3 + 1.5 * (q3 - q1)')} AS high_fence FROM q""")
def quartiles(spark, folder):
    return tidy(tukey_fences(t.stays(spark, folder), "price"))


@register("grouped_quartiles", f"""
SELECT l_returnflag, l_linestatus, {rd('quantile_cont(l_extendedprice, 0.25)')} AS q1,
  {rd('quantile_cont(l_extendedprice, 0.5)')} AS q2, {rd('quantile_cont(l_extendedprice, 0.9)')} AS p90 FROM lineitem GROUP BY ALL""")
def grouped_quartiles(spark, folder):
    found = exact_quantiles(
        t.table(spark, folder, "lineitem"), "l_extendedprice", {"q1": 0.25, "q2": 0.5, "p90": 0.9},
        ["l_returnflag", "l_linestatus"],
    )
    return tidy(found)


MOMENTS = """
m AS (SELECT avg(x) AS mu FROM x), c AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, avg(power(x - mu, 3)) / power(avg(power(x - mu, 2)), 1.5) AS skew,
         avg(power(x - mu, 4)) / power(avg(power(x - mu, 2)), 2) - 3 AS kurt FROM x, m)"""


@register("moments", f"""
WITH x AS (SELECT o_totalprice AS x FROM orders), {MOMENTS}
SELECT CAST(n AS BIGINT) AS n, {rd('skew')} AS skewness, {rd('kurt')} AS kurtosis FROM c""")
def moments(spark, folder):
    return tidy(p.moments(t.stays(spark, folder), F.col("price")))


@register("log_transform_report", f"""
WITH s AS (SELECT count(*) AS n, skewness(o_totalprice) AS a, skewness(ln(1 + o_totalprice)) AS b FROM orders)
SELECT n, {rd('a')} AS skew, {rd('b')} AS log_skew, {rd('abs(a) - abs(b)')} AS improvement FROM s""")
def log_transform_report(spark, folder):
    return tidy(p.log_transform_report(t.stays(spark, folder), "price"))


# the test for 5,000 hotels or however many there are: balances are close to uniform, so the
# statistic is far from 0
@register("normality_test", f"""
WITH x AS (SELECT c_acctbal AS x FROM customer), {MOMENTS},
a AS (SELECT *, skew * sqrt((n+1)*(n+3)/(6*(n-2))) AS y,
        3*(n*n+27*n-70)*(n+1)*(n+3)/((n-2)*(n+5)*(n+7)*(n+9)) AS beta,
        3*(n-1)/(n+1) AS e, 24*n*(n-2)*(n-3)/((n+1)*(n+1)*(n+3)*(n+5)) AS v,
        6*(n*n-5*n+2)/((n+7)*(n+9)) * sqrt(6*(n+3)*(n+5)/(n*(n-2)*(n-3))) AS bb FROM c),
b AS (SELECT *, sqrt(2*(beta-1)) - 1 AS w2, (kurt + 3 - e)/sqrt(v) AS q, 6 + 8/bb*(2/bb + sqrt(1 + 4/(bb*bb))) AS aa FROM a),
z AS (SELECT *, asinh(y/sqrt(2/(w2-1)))/sqrt(ln(w2)/2) AS z1,
        (1 - 2/(9*aa) - cbrt((1-2/aa)/(1+q*sqrt(2/(aa-4)))))/sqrt(2/(9*aa)) AS z2 FROM b)
SELECT CAST(n AS BIGINT) AS n, {rd('z1*z1 + z2*z2', 3)} AS k2, {rd('exp(-(z1*z1 + z2*z2)/2)', 6)} AS p_value FROM z""")
def normality_test(spark, folder):
    customers = t.table(spark, folder, "customer")
    facts = p.moments(customers, F.col("c_acctbal"))
    k2, value = p.normality(F.col("skewness"), F.col("kurtosis"), F.col("n"))
    return facts.select("n", F.round(k2, 3).alias("k2"), F.round(value, 6).alias("p_value"))


@register("correlation_ranking", f"WITH {LINES}, r AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS r, count(*) FILTER ({c} IS NOT NULL) AS n FROM lines"
    for c in NUMERIC) + f""")
SELECT feature, {rd('r')} AS r, n, CASE WHEN abs(r) > 0.3 THEN 'strong' WHEN abs(r) > 0.15 THEN 'moderate'
  WHEN abs(r) > 0.05 THEN 'weak' ELSE 'minimal' END AS strength, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction
FROM r ORDER BY abs(r) DESC, feature""")
def correlation_ranking(spark, folder):
    ranking = p.correlation_ranking(lines(spark, folder), NUMERIC, "l_extendedprice")
    return tidy(ranking).orderBy(F.desc(F.abs("r")), "feature")


MATRIX = ["l_extendedprice", *NUMERIC]


@register("correlation_matrix", f"WITH {LINES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {rd(f'corr({a}, {b})')} AS r FROM lines" for a in MATRIX for b in MATRIX))
def correlation_matrix(spark, folder):
    return tidy(p.correlation_matrix(lines(spark, folder), MATRIX))


@register("trend_line", f"""
SELECT {rd('regr_slope(l_extendedprice, l_quantity)')} AS slope, {rd('regr_intercept(l_extendedprice, l_quantity)')} AS intercept FROM lineitem""")
def trend_line(spark, folder):
    return tidy(p.trend_line(t.table(spark, folder, "lineitem"), "l_extendedprice", "l_quantity"))


@register("histogram", f"""
WITH s AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 50 AS w, count(*) AS total FROM orders),
c AS (SELECT least(CAST(floor((o_totalprice - lo) / w) AS BIGINT), 49) AS bin, count(*) AS n FROM orders, s GROUP BY 1)
SELECT CAST(b.i AS BIGINT) AS bin, {rd('lo + b.i * w')} AS low, {rd('lo + (b.i + 1) * w')} AS high, coalesce(n, 0) AS n,
       {rd('coalesce(n, 0) / (total * w) * 1e6')} AS density_per_million
FROM range(50) b(i) LEFT JOIN c ON b.i = c.bin, s""")
def histogram(spark, folder):
    h = p.histogram(t.stays(spark, folder), F.col("price"))
    return tidy(h.select("bin", "low", "high", "n", (F.col("density") * 1e6).alias("density_per_million")))


@register("boxplot_stats", f"""
WITH {STAYS}, k AS (SELECT 'C' || (hotel % 40) AS kind, price FROM stays),
top AS (SELECT kind FROM k GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 10),
x AS (SELECT * FROM k WHERE kind IN (SELECT kind FROM top)),
q AS (SELECT kind, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM x GROUP BY kind),
f AS (SELECT x.*, q1, median, q3, price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM x JOIN q USING (kind))
SELECT kind, {rd('any_value(q1)')} AS q1, {rd('any_value(median)')} AS median, {rd('any_value(q3)')} AS q3, count(*) AS n,
  min(price) FILTER (inside) AS low_whisker, max(price) FILTER (inside) AS high_whisker, count(*) FILTER (NOT inside) AS outliers
FROM f GROUP BY kind""")
def boxplot_stats(spark, folder):
    kinds = t.stays(spark, folder).select(F.concat(F.lit("C"), F.col("hotel") % 40).alias("kind"), "price")
    return tidy(p.boxplot_stats(kinds, "kind", "price"))


@register("qq_points")
def qq_points(spark, folder):
    return tidy(p.qq_points(t.stays(spark, folder), "price"))


@register("normal_curve", f"""
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(o_totalprice) AS mu, stddev_pop(o_totalprice) AS sd FROM orders),
g AS (SELECT i, lo + (hi - lo) * i / 99.0::DOUBLE AS x, mu, sd FROM range(100) r(i), s)
SELECT CAST(i AS BIGINT) AS point, {rd('x')} AS x,
       {rd('exp(-power((x - mu) / sd, 2) / 2) / (sd * sqrt(2 * pi())) * 1e6')} AS density_per_million FROM g""")
def normal_curve(spark, folder):
    curve = p.normal_curve(t.stays(spark, folder), "price")
    return tidy(curve.select("point", "x", (F.col("density") * 1e6).alias("density_per_million")))


@register("regression_metrics", f"""
WITH r AS (SELECT ln(1 + o_totalprice) AS y, ln(1 + o_totalprice) + (o_orderkey % 7 - 3) / 10.0::DOUBLE AS p, o_totalprice AS yo,
             o_totalprice * (1 + (o_orderkey % 7 - 3) / 10.0::DOUBLE) AS po FROM orders),
m AS (SELECT avg(y) AS my, avg(yo) AS mo FROM r)
SELECT {rd('sqrt(avg(power(y - p, 2)))')} AS rmse_log, {rd('avg(abs(y - p))')} AS mae_log,
  {rd('1 - sum(power(y - p, 2)) / sum(power(y - my, 2))')} AS r2_log,
  {rd('sqrt(avg(power(yo - po, 2)))')} AS rmse_orig, {rd('avg(abs(yo - po))')} AS mae_orig,
  {rd('1 - sum(power(yo - po, 2)) / sum(power(yo - mo, 2))')} AS r2_orig,
  {rd('avg(abs((yo - po) / yo)) * 100')} AS mape, count(*) AS n FROM r, m""")
def regression_metrics(spark, folder):
    shift = (F.col("stay_id") % 7 - 3) / 10.0
    scored = t.stays(spark, folder).select(
        F.log1p("price").alias("y"), (F.log1p("price") + shift).alias("p"),
        F.col("price").alias("yo"), (F.col("price") * (1 + shift)).alias("po"),
    )
    return tidy(p.regression_metrics(scored, "y", "p", "yo", "po"))


@register("coverage_report", "WITH x AS (SELECT CASE WHEN o_custkey % 20 <> 0 THEN 1 END AS lat, o_orderkey AS stay_id FROM orders) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) - count({c}) AS missing, {rd(f'count({c}) * 100.0::DOUBLE / count(*)')} AS coverage_pct FROM x"
    for c in ("lat", "stay_id")))
def coverage_report(spark, folder):
    return tidy(cols.coverage_report(t.stays(spark, folder).select("lat", "stay_id")))


@register("daily_volume_stats", f"""
WITH {STAYS}, d AS (SELECT checkin AS day, count(*) AS n FROM stays GROUP BY 1)
SELECT min(day) AS first_day, max(day) AS last_day, CAST(max(day) - min(day) + 1 AS BIGINT) AS span_days, count(*) AS days,
       {rd('avg(n)')} AS mean_n, min(n) AS min_n, max(n) AS max_n, {rd('stddev_samp(n)')} AS std_n FROM d""")
def daily_volume_stats(spark, folder):
    return tidy(p.daily_volume_stats(t.stays(spark, folder), "checkin"))


@register("split_balance", RANDOM_SPLIT + f""",
top AS (SELECT split, room, count(*) AS k, row_number() OVER (PARTITION BY split ORDER BY count(*) DESC, room) AS rn2 FROM split GROUP BY split, room)
SELECT split, any_value(c) AS n, any_value(pm) AS price_mean, any_value(ps) AS price_std, any_value(lm) AS log_mean, any_value(ls) AS log_std,
  any_value(fd) AS first_day, any_value(ld) AS last_day, any_value(dd) AS days, any_value(fp) AS flag_pct,
  any_value(top.room) AS top_category, any_value({rd('top.k * 100.0::DOUBLE / c')}) AS top_category_pct
FROM (SELECT split, count(*) AS c, {rd('avg(price)', 2)} AS pm, {rd('stddev_samp(price)', 2)} AS ps, {rd('avg(ln(1 + price))')} AS lm,
        {rd('stddev_samp(ln(1 + price))')} AS ls, min(checkin) AS fd, max(checkin) AS ld, count(DISTINCT checkin) AS dd,
        {rd('count(*) FILTER (isodow(checkin) >= 6) * 100.0::DOUBLE / count(*)')} AS fp FROM split GROUP BY split)
JOIN top USING (split) WHERE top.rn2 = 1 GROUP BY split""")
def split_balance(spark, folder):
    parts = splits.random_split(t.stays(spark, folder), "stay_id")
    return splits.split_balance(parts, "price", "checkin", F.weekday("checkin") >= 5, "room")


@register("distribution_overview", f"""
WITH {STAYS}, r AS (SELECT room, count(*) AS k FROM stays GROUP BY room ORDER BY k DESC, room LIMIT 1)
SELECT count(*) AS n, {rd('avg(ln(1 + price))')} AS log_mean, {rd('stddev_samp(ln(1 + price))')} AS log_std, {rd('avg(price)', 2)} AS price_mean,
  {rd('stddev_samp(price)', 2)} AS price_std, {rd('count(*) FILTER (isodow(checkin) >= 6) * 100.0::DOUBLE / count(*)')} AS weekend_pct,
  any_value(r.room) AS top_room, {rd('any_value(r.k) * 100.0::DOUBLE / count(*)')} AS top_room_pct FROM stays, r""")
def distribution_overview(spark, folder):
    overview = splits.distribution_overview(
        t.stays(spark, folder), "price", {"weekend": F.weekday("checkin") >= 5}, ["room"]
    )
    return tidy(overview.withColumns({"price_mean": F.round("price_mean", 2), "price_std": F.round("price_std", 2)}))
