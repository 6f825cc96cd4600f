"""Registration and the SQL twins of the lodging views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def tidy(df: DataFrame, digits: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded, whole numbers as bigint: the shape the comparison expects."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType) and f.name not in keep:
            out.append(F.round(c, digits).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(c.cast("bigint").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def rd(expr: str, digits: int = 4) -> str:
    """Decimal half-up rounding of a double's shortest text, as Spark's ``round`` does it."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


STAYS = """
stays AS (
  SELECT o_orderkey AS stay_id, CAST(o_orderdate AS DATE) AS checkin,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 + 1 AS INTEGER) AS checkout,
         CAST(o_orderdate AS DATE) - CAST(o_orderkey % 120 AS INTEGER) AS snapshot,
         o_totalprice AS price, o_orderpriority AS room, o_orderstatus AS status,
         o_custkey AS hotel, c_mktsegment AS district,
         CASE WHEN o_custkey % 20 <> 0
              THEN 43.60::DOUBLE + CAST(o_custkey % 100 AS DOUBLE) * 0.001::DOUBLE END AS lat,
         -79.50::DOUBLE + CAST(o_custkey % 150 AS DOUBLE) * 0.001::DOUBLE AS lon
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

CITY_EVENTS = """
city_events AS (
  SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS event_id,
         CAST(l_shipdate AS DATE) AS day, l_quantity * 0.25::DOUBLE AS score, l_returnflag AS segment,
         43.60::DOUBLE + CAST(l_partkey % 120 AS DOUBLE) * 0.001::DOUBLE AS event_lat,
         -79.50::DOUBLE + CAST(l_suppkey % 100 AS DOUBLE) * 0.001::DOUBLE AS event_lon
  FROM lineitem)"""

WEATHER = """
weather AS (
  SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey % 5 AS station,
         sum(l_quantity) / count(l_quantity) - 20.0::DOUBLE AS mean_temp, max(l_quantity) AS max_temp
  FROM lineitem GROUP BY 1, 2)"""

HOLIDAYS = """
holidays AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE day(o_orderdate) = 1)"""


def km(lat1: str, lon1: str, lat2: str, lon2: str, digits: int = 2) -> str:
    return rd(
        f"12742.0 * asin(sqrt(power(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon2}) - radians({lon1})) / 2), 2)))",
        digits,
    )


def miles(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(power(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"7918.0 * atan2(sqrt({a}), sqrt(1.0 - {a}))"


# pairs of stays and events, and the features built from them pair by pair
STAY_EVENTS = STAYS + "," + CITY_EVENTS + f""",
pairs AS (
  SELECT s.stay_id, s.checkin, e.*, CAST(e.day - s.checkin AS BIGINT) AS days_from_checkin,
         {km('s.lat', 's.lon', 'e.event_lat', 'e.event_lon')} AS km
  FROM stays s JOIN city_events e ON e.day >= s.checkin AND e.day < s.checkout)"""


def stay_features_sql(spatial: bool) -> str:
    """CTEs ``basic`` and, when spatial, ``feat``; per stay, straight from the pairs."""
    src = "located" if spatial else "pairs"
    sql = STAY_EVENTS
    if spatial:
        sql += ", located AS (SELECT * FROM pairs WHERE km IS NOT NULL)"
    sql += f""",
seg AS (
  SELECT stay_id, segment FROM (
    SELECT stay_id, segment, row_number() OVER (PARTITION BY stay_id ORDER BY count(*) DESC, segment) AS rn
    FROM {src} WHERE segment IS NOT NULL GROUP BY stay_id, segment) WHERE rn = 1),
raw AS (
  SELECT stay_id, sum(score) AS total, max(score) AS mx, count(score) AS n,
         min(days_from_checkin) AS first_day, max(days_from_checkin) AS last_day,
         CAST(sum(days_from_checkin) AS DOUBLE) / count(*) AS avg_day
  FROM {src} GROUP BY stay_id),
basic AS (
  SELECT stay_id, {rd('total', 2)} AS events_total_score, {rd('mx', 2)} AS events_max_score,
         {rd('total / n', 2)} AS events_avg_score, n AS events_count,
         first_day AS events_earliest_day, last_day AS events_latest_day,
         {rd('avg_day', 2)} AS events_avg_day, coalesce(segment, 'Unknown') AS events_primary_segment,
         last_day - first_day AS events_span_days,
         {rd('CAST(n AS DOUBLE) / (last_day - first_day + 1)', 4)} AS events_density,
         CAST(mx >= 10 AS BIGINT) AS has_major_event, CAST(n >= 2 AS BIGINT) AS has_multiple_events
  FROM raw LEFT JOIN seg USING (stay_id))"""
    if spatial:
        sql += f""",
dist AS (
  SELECT stay_id, min(km) AS lo, max(km) AS hi,
         {rd('CAST(sum(CAST(round(km * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100.0::DOUBLE)', 2)} AS av,
         {rd('CAST(quantile_cont(CAST(round(km * 100) AS DOUBLE), 0.5) AS DOUBLE) / 100.0::DOUBLE', 2)} AS med,
         {rd('sum(score / (km + 0.1::DOUBLE))', 2)} AS weighted,
         min(CASE WHEN score >= 10 THEN km END) AS major_km
  FROM located GROUP BY stay_id),
feat AS (
  SELECT stay_id, events_total_score, events_max_score, events_avg_score, events_count,
         lo AS min_distance_to_event, hi AS max_distance_to_event, av AS avg_distance_to_events,
         med AS median_distance_to_events, events_earliest_day, events_latest_day, events_avg_day,
         events_primary_segment, events_span_days, events_density,
         weighted AS distance_weighted_event_score, major_km AS distance_to_closest_major_event,
         CAST(lo <= 1.0 AS BIGINT) AS has_nearby_event_1km, CAST(lo <= 5.0 AS BIGINT) AS has_nearby_event_5km,
         has_major_event, {rd('weighted * CAST(lo <= 5.0 AS BIGINT)', 2)} AS event_accessibility_score
  FROM basic JOIN dist USING (stay_id))"""
    return sql


def case_sql(column: str, rules, default: str | None = None) -> str:
    """CASE over keyword rules: (label, words) or (label, words, words of which one more must occur)."""
    def quote(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def has(words) -> str:
        return "(" + " OR ".join(f"contains(lower({column}), {quote(w)})" for w in words) + ")"

    arms = []
    for label, words, *also in rules:
        test = has(words) + (f" AND {has(also[0])}" if also and also[0] else "")
        arms.append(f"WHEN {test} THEN {quote(label)}")
    return "CASE " + " ".join(arms) + (f" ELSE {quote(default)}" if default else "") + " END"


def bucket_sql(column: str, edges, labels) -> str:
    arms = []
    for low, high, label in zip(edges, edges[1:], labels):
        top = "" if high == float("inf") else f" AND {column} <= {high}"
        arms.append(f"WHEN {column} > {low}{top} THEN '{label}'")
    return "CASE " + " ".join(arms) + " END"
