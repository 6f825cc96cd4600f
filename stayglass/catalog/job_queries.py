"""Composed jobs over the lodging views."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.catalog.join_queries import ENRICHED
from stayglass.catalog.model_queries import FEATURES, model_rows
from stayglass.catalog.profile_queries import MOMENTS
from stayglass.catalog.registry import (
    HOLIDAYS, STAYS, WEATHER, bucket_sql, case_sql, miles, rd, register, stay_features_sql, tidy,
)
from stayglass.catalog.scalar_queries import ADDRESS_TEXTS, NAME_TEXTS, ROOM_TEXTS, pick, pick_sql
from stayglass.functions import geo
from stayglass.operators import stay_features as sf
from stayglass.plans import features as feature_plan
from stayglass.plans import fix_distances, profile, train
from stayglass.plans import transform as transform_plan
from stayglass.plans.unify import unify
from stayglass.session import work_path
from stayglass.sources import files
from stayglass.sources import tables as t


@register("job_unify", f"""
WITH {stay_features_sql(True)}, {WEATHER},
daily AS (SELECT day, avg(mean_temp) AS mean_temp, avg(max_temp) AS max_temp FROM weather GROUP BY day)
SELECT stay_id, stays.checkin, checkout, price, {rd('mean_temp')} AS mean_temp, {rd('max_temp')} AS max_temp, {ENRICHED}
FROM stays LEFT JOIN daily ON checkin = day LEFT JOIN feat USING (stay_id)""")
def job_unify(spark, folder):
    unified = unify(
        t.stays(spark, folder), t.city_events(spark, folder), t.station_weather(spark, folder),
        ["mean_temp", "max_temp"], mode="spatial",
    )
    return tidy(unified.select(
        "stay_id", "checkin", "checkout", "price", "mean_temp", "max_temp", *sf.SPATIAL_FEATURES
    ), keep=("price",))


BASIC = ", ".join(
    f"coalesce({c}, 'None') AS {c}" if c == "events_primary_segment" else f"coalesce({c}, 0) AS {c}"
    for c in sf.BASIC_FEATURES
)


@register("job_unify_basic", f"""
WITH {stay_features_sql(False)}, {WEATHER}
SELECT stay_id, station, {rd('mean_temp')} AS mean_temp, {BASIC}
FROM stays LEFT JOIN weather ON checkin = day LEFT JOIN basic USING (stay_id)""")
def job_unify_basic(spark, folder):
    # no coordinates: features from dates alone, weather kept per station
    stays = t.stays(spark, folder).drop("lat", "lon")
    unified = unify(
        stays, t.city_events(spark, folder), t.station_weather(spark, folder), ["mean_temp"], weather_fanout=True
    )
    return tidy(unified.select("stay_id", "station", "mean_temp", *sf.BASIC_FEATURES))


def listings(spark, folder):
    """Stays as raw listing rows with the texts a scrape would hold."""
    key = F.col("stay_id")
    usd = F.round(F.col("price") / 250, 2)
    return t.stays(spark, folder).select(
        "stay_id",
        F.date_format("snapshot", "yyyy-MM-dd").alias("Date"),
        F.date_format("checkin", "yyyy-MM-dd").alias("Check-in Date"),
        F.date_format("checkout", "yyyy-MM-dd").alias("Check-out Date"),
        F.when(key % 97 == 0, "Scarborough Home").otherwise(pick(NAME_TEXTS, F.col("hotel"))).alias("Hotel name"),
        F.when(key % 3 == 0, pick(ADDRESS_TEXTS, key)).alias("Address"),
        F.concat(F.lit(" "), pick(ROOM_TEXTS, key)).alias("Room Type"),
        F.when(key % 2 == 0, "2").alias("Number of People"),
        F.when(key % 5 == 0, F.concat(F.format_number(key % 90 / 10.0, 1), F.lit(" miles from downtown"))).alias("distance to attraction"),
        F.when(key % 5 != 1, F.concat(F.format_number(key % 70 / 10.0, 1), F.lit(" miles from downtown"))).alias("Distance from attraction"),
        F.lit(None).cast("string").alias("Deal Info"),
        F.when(key % 10 == 0, F.col("lat")).alias("rare"),
        F.when(key % 41 == 0, "Free airport taxi").otherwise(F.concat(F.lit("$"), F.format_number(usd, 2))).alias("price"),
        (key % 30).cast("double").alias("events_total_score"),
        F.lit(None).cast("double").alias("MEAN_TEMPERATURE"),
    )


TRANSFORMED = f"""
{STAYS}, {HOLIDAYS}, raw AS (
  SELECT *, CASE WHEN stay_id % 97 = 0 THEN 'Scarborough Home' ELSE {pick_sql(NAME_TEXTS, 'hotel')} END AS hname,
    CASE WHEN stay_id % 3 = 0 THEN {pick_sql(ADDRESS_TEXTS, 'stay_id')} END AS address,
    {pick_sql(ROOM_TEXTS, 'stay_id')} AS rtype,
    CASE WHEN stay_id % 41 <> 0 THEN {rd('price / 250', 2)} END AS usd FROM stays),
placed AS (
  SELECT *, coalesce({case_sql('address', fv.ADDRESS_RULES)}, {case_sql('hname', fv.HOTEL_NAME_RULES)}) AS named FROM raw
  WHERE lower(hname) <> 'scarborough home' AND (usd IS NULL OR usd BETWEEN 25 AND 2000)),
d(name, dlat, dlon) AS (VALUES {", ".join(f"('{n}', {a}::DOUBLE, {o}::DOUBLE)" for n, a, o in fv.DISTRICTS)}),
final AS (
  SELECT stay_id, snapshot, checkin, checkout, hname, address, rtype, usd, {rd('usd * 1.35::DOUBLE', 2)} AS cad,
    CASE WHEN stay_id % 5 <> 1 THEN (stay_id % 70) / 10.0::DOUBLE END AS miles,
    coalesce(named, 'Yonge - Dundas') AS district, dlat, dlon,
    EXISTS (SELECT 1 FROM holidays WHERE day BETWEEN checkin AND checkout) AS is_holiday,
    (isodow(checkin) >= 6 OR (checkout - checkin) >= 6 - isodow(checkin)) AS is_weekend,
    CAST(checkout - checkin AS BIGINT) AS nights, greatest(CAST(checkin - snapshot AS BIGINT), 0) AS lead,
    CAST(week(checkin) AS BIGINT) AS week, {case_sql('rtype', fv.ROOM_RULES, fv.DEFAULT_ROOM)} AS room_category
  FROM placed LEFT JOIN d ON lower(d.name) = lower(coalesce(named, 'Toronto')))
"""


@register("job_transform", f"""
WITH {TRANSFORMED}
SELECT stay_id, snapshot AS "Date", checkin AS "Check-in Date", checkout AS "Check-out Date", hname AS "Hotel name",
  address AS "Address", rtype AS "Room Type", CAST(2 AS BIGINT) AS "Number of People", miles AS "Distance from attraction",
  usd AS price_usd, cad AS price_cad, CAST(stay_id % 30 AS DOUBLE) AS events_total_score, 10.5::DOUBLE AS "MEAN_TEMPERATURE", nights AS length_of_stay,
  15.2::DOUBLE AS "MAX_TEMPERATURE", 5.8::DOUBLE AS "MIN_TEMPERATURE", 66.2::DOUBLE AS "TOTAL_PRECIPITATION",
  0.0::DOUBLE AS "TOTAL_SNOW", 0.0::DOUBLE AS "SNOW_ON_GROUND", 45.0::DOUBLE AS "SPEED_MAX_GUST", 85.0::DOUBLE AS "MAX_REL_HUMIDITY",
  is_holiday, district, dlat AS latitude, dlon AS longitude, is_weekend, week AS week_of_year, lead AS booking_lead_time, room_category
FROM final""")
def job_transform(spark, folder):
    raw = files.stored(listings(spark, folder), "listings")
    return transform_plan.transform(raw, t.holidays(spark, folder))


@register("job_features", f"""
WITH {TRANSFORMED}, p AS (SELECT *, CAST(stay_id % 30 AS DOUBLE) AS score FROM final WHERE cad IS NOT NULL),
top AS (SELECT district FROM p GROUP BY district ORDER BY count(*) DESC, district LIMIT 5)
SELECT stay_id, {rd('ln(1 + cad)', 6)} AS log_price_cad, {bucket_sql('miles', *fv.DISTANCE_BINS)} AS distance_category,
  {bucket_sql('lead', *fv.LEAD_BINS)} AS lead_time_category, {bucket_sql('nights', *fv.STAY_BINS)} AS stay_category,
  {bucket_sql('score', *fv.EVENT_BINS)} AS event_intensity, 'mild' AS temp_category,
  CAST(month(checkin) AS BIGINT) AS checkin_month, CAST(isodow(checkin) - 1 AS BIGINT) AS checkin_day_of_week,
  CAST(quarter(checkin) AS BIGINT) AS checkin_quarter,
  CASE WHEN is_weekend THEN 'True' ELSE 'False' END || '_' || CASE WHEN is_holiday THEN 'True' ELSE 'False' END AS weekend_holiday,
  CASE WHEN district IN (SELECT district FROM top) THEN district ELSE 'other' END AS district_simple,
  CASE WHEN district IN (SELECT district FROM top) THEN district ELSE 'other' END || '_' || room_category AS district_room_combo
FROM p""")
def job_features(spark, folder):
    transformed = files.stored(job_transform(spark, folder), "transformed")
    engineered = feature_plan.engineer_features(transformed)
    return engineered.select(
        "stay_id", F.round("log_price_cad", 6).alias("log_price_cad"), "distance_category", "lead_time_category",
        "stay_category", "event_intensity", "temp_category", "checkin_month", "checkin_day_of_week",
        "checkin_quarter", "weekend_holiday", "district_simple", "district_room_combo",
    )


@register("job_model_table", f"""
WITH {TRANSFORMED} SELECT count(*) AS n, CAST(11 AS BIGINT) AS features FROM final WHERE cad IS NOT NULL""")
def job_model_table(spark, folder):
    wanted = [
        "district", "district_simple", "booking_lead_time", "length_of_stay", "room_category", "is_weekend", "is_holiday",
        "week_of_year", "weekend_holiday", "checkin_month", "Distance from attraction", "MEAN_TEMPERATURE", "absent",
    ]
    transformed = files.stored(job_transform(spark, folder), "transformed")
    engineered = feature_plan.engineer_features(transformed)
    table, kept = feature_plan.model_table(engineered, wanted, keep=["stay_id"])
    return table.agg(F.count(F.lit(1)).alias("n")).withColumn("features", F.lit(len(kept)).cast("bigint"))


FIXED = f"""
WITH {STAYS}, s AS (
  SELECT stay_id, lat, lon, CASE WHEN stay_id % 4 <> 0 THEN {miles('lat', 'lon', '43.6452::DOUBLE', '-79.3806::DOUBLE')} + (stay_id % 7) / 100.0::DOUBLE END AS dist FROM stays),
p(ord, plat, plon) AS (VALUES {", ".join(f"({i}, {a}::DOUBLE, {o}::DOUBLE)" for i, (_, a, o) in enumerate(fv.ATTRACTIONS))}),
c AS (SELECT ord, plat, plon, corr({miles('lat', 'lon', 'plat', 'plon')}, dist) AS r FROM s, p WHERE lat IS NOT NULL AND dist IS NOT NULL GROUP BY ALL),
b AS (SELECT plat, plon FROM c ORDER BY r DESC, ord LIMIT 1)
SELECT stay_id, {rd(f"coalesce(dist, {miles('lat', 'lon', 'plat', 'plon')})")} AS distance FROM s, b"""


def _recorded(spark, folder):
    recorded = geo.haversine_miles(F.col("lat"), F.col("lon"), F.lit(43.6452), F.lit(-79.3806)) + (F.col("stay_id") % 7) / 100.0
    return t.stays(spark, folder).select(
        "stay_id", "lat", "lon", F.when(F.col("stay_id") % 4 != 0, recorded).alias("distance")
    )


@register("job_fix_distances", FIXED)
def job_fix_distances(spark, folder):
    fixed = fix_distances.fix_distances(_recorded(spark, folder), "lat", "lon", "distance")
    return tidy(fixed.select("stay_id", "distance"))


@register("job_fix_distances_check", f"""
SELECT count(distance) AS with_value, count(*) FILTER (distance BETWEEN {fv.PLAUSIBLE_MILES[0]} AND {fv.PLAUSIBLE_MILES[1]}) AS plausible,
  count(*) FILTER (distance NOT BETWEEN {fv.PLAUSIBLE_MILES[0]} AND {fv.PLAUSIBLE_MILES[1]}) AS implausible,
  {rd('min(distance)')} AS min_value, {rd('max(distance)')} AS max_value FROM ({FIXED})""")
def job_fix_distances_check(spark, folder):
    """The whole job: the table is written, fixed in place and checked as written."""
    path = files.write_table(_recorded(spark, folder), work_path(spark, "distances"))
    return tidy(fix_distances.run(spark.read.parquet(path), path, lat="lat", lon="lon", distance="distance"))


def _profile_sql() -> str:
    def one(section, item, metric, expr, source):
        return f"SELECT '{section}' AS section, {item} AS item, '{metric}' AS metric, {rd(f'CAST(({expr}) AS DOUBLE)')} AS value FROM {source}"

    lead = "CAST(checkin - snapshot AS DOUBLE)"
    parts = [one("target", "''", m, e, "c, x GROUP BY n, skew, kurt") for m, e in (
        ("n", "n"), ("min", "min(x)"), ("max", "max(x)"), ("mean", "avg(x)"), ("std", "stddev_samp(x)"),
        ("skewness", "skew"), ("kurtosis", "kurt"))]
    parts += [one("target", "''", "log_skewness", "skew", "lc"), one("target", "''", "log_kurtosis", "kurt", "lc")]
    parts += [one("quartiles", "''", m, e, "q") for m, e in (
        ("q1", "q1"), ("q3", "q3"), ("iqr", "q3 - q1"), ("low_fence", "q1 - 1.5 * (q3 - q1)"), ("high_fence", "q3 + 1.5 * (q3 - q1)"))]
    for column, expr in (("lead", lead), ("nights", "CAST(checkout - checkin AS DOUBLE)")):
        parts.append(one("correlation", f"'{column}'", "r", f"corr({expr}, price)", "stays"))
        parts.append(one("trend", f"'{column}'", "slope", f"regr_slope(price, {expr})", "stays"))
        parts.append(one("trend", f"'{column}'", "intercept", f"regr_intercept(price, {expr})", "stays"))
    for m, e in (("mean", rd("avg(price)", 2)), ("median", rd("quantile_cont(price, 0.5)", 2)), ("n", "count(*)")):
        parts.append(one("category:room", "room", m, e, "stays GROUP BY room"))
        empty = "0" if m == "n" else "NULL"
        parts.append(one("bins:lead", "d.bin", m, f"coalesce(any_value(b.{m}), {empty})", "d LEFT JOIN b USING (bin) GROUP BY d.bin"))
    w, o = "avg(price) FILTER (isodow(checkin) >= 6)", "avg(price) FILTER (isodow(checkin) < 6)"
    parts += [one("premium", "'weekend'", m, e, "stays") for m, e in (
        ("mean_with", w), ("mean_without", o), ("premium", f"{w} - {o}"), ("premium_pct", f"({w} - {o}) / ({o}) * 100"))]
    return f"""
WITH {STAYS}, x AS (SELECT price AS x FROM stays), {MOMENTS},
lm AS (SELECT avg(ln(1 + x)) AS mu FROM x), lc AS (
  SELECT avg(power(ln(1 + x) - mu, 3)) / power(avg(power(ln(1 + x) - mu, 2)), 1.5) AS skew,
         avg(power(ln(1 + x) - mu, 4)) / power(avg(power(ln(1 + x) - mu, 2)), 2) - 3 AS kurt FROM x, lm),
q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM stays),
d(bin) AS (VALUES {", ".join(f"('{b}')" for b in fv.LEAD_BINS[1])}),
b AS (SELECT {bucket_sql('(checkin - snapshot)', *fv.LEAD_BINS)} AS bin, {rd('avg(price)', 2)} AS mean,
        {rd('quantile_cont(price, 0.5)', 2)} AS median, count(*) AS n FROM stays GROUP BY 1)
""" + " UNION ALL ".join(parts)


@register("job_profile", _profile_sql())
def job_profile(spark, folder):
    stays = t.stays(spark, folder).withColumns({
        "lead": F.datediff("checkin", "snapshot").cast("double"),
        "nights": F.datediff("checkout", "checkin").cast("double"),
    })
    report = profile.price_profile(
        stays, "price", ["lead", "nights"], ["room"], {"lead": fv.LEAD_BINS}, {"weekend": F.weekday("checkin") >= 5}
    )
    # the test statistic has a query of its own
    return report.where("metric NOT IN ('k2', 'p_value')")


@register("job_train")
def job_train(spark, folder):
    data = model_rows(spark, folder)
    fit_rows, val = data.where("split = 'train'").drop("split"), data.where("split = 'val'").drop("split")
    specs = [*train.BASELINES, *train.ADVANCED]
    board, _ = train.compare(specs, fit_rows, val, FEATURES, "log_price", "price")
    return tidy(board)
