"""Selection, filters, fills, dedupe and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.catalog.registry import HOLIDAYS, STAYS, miles, rd, register, tidy
from stayglass.catalog.source_queries import RANDOM_SPLIT
from stayglass.operators import columns as cols
from stayglass.operators import profile, ranks, rows, splits
from stayglass.sources import tables as t


@register("canonical_rename", "SELECT o_orderkey AS stay_id, o_totalprice AS price_usd FROM orders")
def canonical_rename(spark, folder):
    frame = t.stays(spark, folder).select("stay_id", "price")
    return cols.canonical_name(frame, fv.PRICE_NAMES, "price_usd")


@register("select_available", f"WITH {STAYS} SELECT stay_id, checkin, lat FROM stays")
def select_available(spark, folder):
    return cols.select_available(t.stays(spark, folder), ["stay_id", "SNOW_ON_GROUND", "checkin", "lat"])


@register("dedupe_columns_by_coverage", f"""
WITH {STAYS} SELECT stay_id, CASE WHEN stay_id % 5 <> 0 THEN price / 2 END AS "Distance from attraction" FROM stays""")
def dedupe_columns_by_coverage(spark, folder):
    key = F.col("stay_id")
    frame = t.stays(spark, folder).select(
        "stay_id",
        F.when(key % 3 == 0, F.col("price")).alias("Distance from attraction"),
        F.when(key % 5 != 0, F.col("price") / 2).alias("distance_to_attraction"),
    )
    return cols.keep_best_covered(frame, ["distance", "attraction"], "Distance from attraction")


@register("anti_join_denylist", """
SELECT o_orderkey AS stay_id FROM orders WHERE lower(o_orderpriority) NOT IN ('1-urgent', '5-low')
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def anti_join_denylist(spark, folder):
    allowed = rows.without_denied(t.stays(spark, folder), "room", ["1-URGENT", "5-Low"])
    broke = t.table(spark, folder, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("k"))
    return rows.anti_join_denied(
        allowed.withColumn("hotel", F.col("hotel").cast("string")), "hotel", broke, "k"
    ).select("stay_id")


@register("range_filter_keep_null", """
WITH p AS (SELECT o_orderkey AS stay_id, CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS price FROM orders)
SELECT * FROM p WHERE price IS NULL OR price BETWEEN 20000 AND 300000""")
def range_filter_keep_null(spark, folder):
    priced = t.stays(spark, folder).select("stay_id", F.when(F.col("stay_id") % 17 != 0, F.col("price")).alias("price"))
    return rows.within_or_null(priced, "price", 20000, 300000)


@register("drop_null_subset", f"WITH {STAYS} SELECT stay_id, lat, lon FROM stays WHERE lat IS NOT NULL")
def drop_null_subset(spark, folder):
    return t.stays(spark, folder).select("stay_id", "lat", "lon").na.drop(subset=["lat", "lon"])


@register("complete_cases", f"""
WITH {STAYS}, c AS (SELECT *, CASE WHEN stay_id % 17 <> 0 THEN price END AS p FROM stays)
SELECT count(*) AS total, count(*) FILTER (lat IS NOT NULL AND p IS NOT NULL) AS complete,
       count(*) FILTER (lat IS NULL OR p IS NULL) AS removed FROM c""")
def complete_cases(spark, folder):
    frame = t.stays(spark, folder).select("lat", "room", F.when(F.col("stay_id") % 17 != 0, F.col("price")).alias("p"))
    kept = rows.complete_cases(frame, ["lat", "room", "p"]).agg(F.count(F.lit(1)).alias("complete")).scalar()
    return frame.agg(F.count(F.lit(1)).alias("total")).withColumn("complete", kept).withColumn(
        "removed", F.col("total") - F.col("complete")
    )


def _sparse(spark, folder):
    key = F.col("stay_id")
    return t.stays(spark, folder).select(
        "stay_id", "room",
        F.lit(None).cast("string").alias("deal"),
        F.when(key % 10 == 0, F.col("price")).alias("rare"),
        F.when(key % 10 == 1, F.col("price")).alias("district"),
        F.when(key % 10 < 4, F.col("price")).alias("part"),
        F.when(key % 10 != 0, F.col("price")).alias("most"),
    )


@register("drop_empty_columns", """
SELECT o_orderkey AS stay_id, o_orderpriority AS room, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice END AS rare,
  CASE WHEN o_orderkey % 10 = 1 THEN o_totalprice END AS district, CASE WHEN o_orderkey % 10 < 4 THEN o_totalprice END AS part,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS most FROM orders""")
def drop_empty_columns(spark, folder):
    return cols.drop_empty(_sparse(spark, folder))


@register("drop_low_coverage", """
SELECT o_orderkey AS stay_id, o_orderpriority AS room,
  CASE WHEN o_orderkey % 10 = 1 THEN o_totalprice END AS district, CASE WHEN o_orderkey % 10 < 4 THEN o_totalprice END AS part,
  CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS most FROM orders""")
def drop_low_coverage(spark, folder):
    return cols.drop_low_coverage(_sparse(spark, folder))


@register("select_by_missing_rate", """
SELECT o_orderpriority AS room, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS most FROM orders""")
def select_by_missing_rate(spark, folder):
    frame = _sparse(spark, folder)
    return frame.select(*cols.features_by_missing_rate(frame, ["room", "rare", "part", "most", "absent"]))


@register("fill_constants", f"""
WITH {STAYS}
SELECT stay_id, coalesce(lat, 0.0) AS lat, CASE WHEN stay_id % 4 = 0 THEN 2 ELSE stay_id % 4 END AS guests,
       CASE WHEN stay_id % 6 = 0 THEN 'None' ELSE room END AS segment FROM stays""")
def fill_constants(spark, folder):
    key = F.col("stay_id")
    frame = t.stays(spark, folder).select(
        "stay_id", "lat", F.when(key % 4 != 0, key % 4).alias("guests"),
        F.when(key % 6 != 0, F.col("room")).alias("segment"),
    )
    return rows.fill(frame, {"guests": fv.DEFAULT_GUESTS, "lat": 0.0, "segment": "None", "absent": 1})


@register("default_if_column_empty", """
SELECT o_orderkey AS stay_id, 10.5::DOUBLE AS "MEAN_TEMPERATURE", 15.2::DOUBLE AS "MAX_TEMPERATURE",
  CASE WHEN o_orderkey % 2 = 0 THEN 1.0::DOUBLE END AS "TOTAL_SNOW" FROM orders""")
def default_if_column_empty(spark, folder):
    frame = t.stays(spark, folder).select(
        "stay_id", F.lit(None).cast("double").alias("MAX_TEMPERATURE"),
        F.when(F.col("stay_id") % 2 == 0, F.lit(1.0)).alias("TOTAL_SNOW"),
    )
    wanted = {k: fv.WEATHER_DEFAULTS[k] for k in ("MEAN_TEMPERATURE", "MAX_TEMPERATURE", "TOTAL_SNOW")}
    return cols.default_if_empty(frame, wanted)


@register("coerce_by_map", f"""
WITH {STAYS}
SELECT stay_id, CASE WHEN stay_id % 9 <> 0 THEN stay_id % 5 END AS guests,
       CASE WHEN stay_id % 7 <> 0 THEN price END AS price, checkin,
       CASE WHEN stay_id % 3 = 0 THEN true WHEN stay_id % 3 = 1 THEN false END AS flag FROM stays""")
def coerce_by_map(spark, folder):
    key = F.col("stay_id")
    frame = t.stays(spark, folder).select(
        "stay_id",
        F.when(key % 9 == 0, "two").otherwise(F.concat(key % 5, F.lit(".0"))).alias("guests"),
        F.when(key % 7 == 0, "N/A").otherwise(F.col("price").cast("string")).alias("price"),
        F.date_format("checkin", "yyyy-MM-dd").alias("checkin"),
        F.when(key % 3 == 0, "True").when(key % 3 == 1, "0").otherwise("maybe").alias("flag"),
    )
    return cols.coerce(frame, {"guests": "bigint", "price": "double", "checkin": "date", "flag": "boolean"})


@register("trim_strings", "SELECT p_partkey, p_name, CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS p_type FROM part")
def trim_strings(spark, folder):
    padded = t.table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
        F.when(F.col("p_partkey") % 5 != 0, F.concat("p_type", F.lit("   "))).alias("p_type"),
    )
    return cols.trim_strings(padded)


@register("plausibility_check", """
WITH d AS (SELECT CASE WHEN p_partkey % 17 <> 0 THEN p_size * 1.5::DOUBLE - 3 END AS miles FROM part)
SELECT count(miles) AS with_value, count(*) FILTER (miles BETWEEN 0 AND 50) AS plausible,
       count(*) FILTER (miles < 0 OR miles > 50) AS implausible, min(miles) AS min_value, max(miles) AS max_value FROM d""")
def plausibility_check(spark, folder):
    d = t.table(spark, folder, "part").select(
        F.when(F.col("p_partkey") % 17 != 0, F.col("p_size") * 1.5 - 3).alias("miles")
    )
    return rows.plausibility_report(d, "miles", *fv.PLAUSIBLE_MILES)


@register("iqr_outliers", """
WITH x AS (SELECT event_id, user_id, event_type, value AS price FROM events),
q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM x)
SELECT x.* FROM x, q WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)""")
def iqr_outliers(spark, folder):
    events = t.table(spark, folder, "events").select("event_id", "user_id", "event_type", F.col("value").alias("price"))
    return rows.outliers(events, "price")


@register("fill_missing_distance", f"""
WITH {STAYS}
SELECT stay_id, {rd("coalesce(CASE WHEN stay_id % 4 <> 0 THEN price / 1000 END, " + miles('lat', 'lon', '43.6414::DOUBLE', '-79.3894::DOUBLE') + ")")} AS distance
FROM stays""")
def fill_missing_distance(spark, folder):
    known = t.stays(spark, folder).withColumn("distance", F.when(F.col("stay_id") % 4 != 0, F.col("price") / 1000))
    return tidy(rows.fill_missing_distance(known, "lat", "lon", "distance", fv.ATTRACTIONS[0][1:]).select("stay_id", "distance"))


@register("dedupe_keep_first", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_keep_first(spark, folder):
    lines = t.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"), "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return tidy(
        rows.keep_first(lines, ["l_orderkey", "l_linenumber", "absent"], [F.col("l_shipdate"), F.col("l_partkey")]),
        keep=("l_extendedprice",),
    )


@register("cumulative_share", f"""
WITH {STAYS}, d AS (SELECT checkin AS day, count(*) AS n FROM stays GROUP BY 1)
SELECT day, n, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS running,
       {rd('CAST(sum(n) OVER (ORDER BY day) AS DOUBLE) * 100.0::DOUBLE / sum(n) OVER ()')} AS running_pct FROM d""")
def cumulative_share(spark, folder):
    share = ranks.cumulative_share(t.stays(spark, folder), "checkin")
    return share.withColumnRenamed("running_n", "running")


@register("ranked_categories", f"""
WITH s AS (SELECT 'C' || (o_custkey % 40) AS kind, {rd('avg(o_totalprice)', 2)} AS mean, count(*) AS n FROM orders GROUP BY 1)
SELECT row_number() OVER (ORDER BY mean DESC, kind) AS rank, kind, mean, n FROM s ORDER BY mean DESC, kind LIMIT 5""")
def ranked_categories(spark, folder):
    kinds = t.stays(spark, folder).select(F.concat(F.lit("C"), F.col("hotel") % 40).alias("kind"), "price")
    return profile.ranked_categories(profile.category_stats(kinds, "kind", "price"), "kind", 5)


@register("random_split_exact", RANDOM_SPLIT + "SELECT stay_id, split FROM split")
def random_split_exact(spark, folder):
    return splits.random_split(t.stays(spark, folder).select("stay_id"), "stay_id")


@register("busiest_quietest_days", f"""
WITH {STAYS}, d AS (SELECT checkin AS day, count(*) AS n FROM stays GROUP BY 1)
SELECT * FROM (SELECT day, n, 'busiest' AS kind FROM d ORDER BY n DESC, day LIMIT 3)
UNION ALL SELECT * FROM (SELECT day, n, 'quietest' AS kind FROM d ORDER BY n, day LIMIT 3)""")
def busiest_quietest_days(spark, folder):
    return profile.busiest_and_quietest(t.stays(spark, folder), "checkin", 3)


@register("audit_sample", f"""
WITH {STAYS} SELECT stay_id, price, room FROM stays WHERE price > 300000 ORDER BY price DESC, stay_id LIMIT 5""")
def audit_sample(spark, folder):
    removed = t.stays(spark, folder).where("price > 300000").select("stay_id", "price", "room")
    return rows.top_k(removed, 5, F.desc("price"), F.asc("stay_id"))


@register("split_coverage_check", RANDOM_SPLIT + """
SELECT count(*) AS total, count(*) FILTER (split IS NULL) AS unassigned, CAST(0 AS BIGINT) AS overlapping FROM split""")
def split_coverage_check(spark, folder):
    parts = splits.random_split(t.stays(spark, folder).select("stay_id"), "stay_id")
    return splits.coverage_check(parts, "stay_id")


@register("distinct_days", f"WITH {STAYS} SELECT DISTINCT checkin FROM stays ORDER BY 1")
def distinct_days(spark, folder):
    return t.stays(spark, folder).select("checkin").distinct().orderBy("checkin")


@register("calendar_union", f"""
WITH {STAYS}, {HOLIDAYS} SELECT day FROM holidays UNION SELECT checkin FROM stays WHERE month(checkin) = 12 AND day(checkin) >= 25""")
def calendar_union(spark, folder):
    federal = t.holidays(spark, folder)
    regional = t.stays(spark, folder).select(F.col("checkin").alias("day")).where("month(day) = 12 AND day(day) >= 25")
    return rows.union_by_name(federal, regional).distinct()


@register("union_missing_columns", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS brand FROM customer
UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part""")
def union_missing_columns(spark, folder):
    customers = t.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    parts = t.table(spark, folder, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")
    )
    return rows.union_by_name(customers, parts)
