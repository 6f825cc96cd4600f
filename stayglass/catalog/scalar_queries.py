"""Column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.catalog.registry import (
    STAYS, bucket_sql, case_sql, km, miles, rd, register, tidy,
)
from stayglass.functions import buckets, dates, geo, rules, text
from stayglass.operators import profile
from stayglass.operators.rows import collapse_to_top, in_top_categories, top_k
from stayglass.sources import tables as t

# texts put next to table rows by key, so that every rule meets rows of the tables
ROOM_TEXTS = [
    "Standard Double Room with Two Double Beds", "Superior Double Room", "Queen Room", "Twin Room",
    "One-Bedroom Apartment with Double Bed", "Studio Apartment", "Studio", "Penthouse Suite", "Bungalow 4",
    "Two-Bedroom House", "Junior Suite", "Presidential Suite", "Family Quad", "Accessible King", "Budget Single",
    "King Room", "Single Bed", "Room", "Loft", "Corner Suite",
]
ADDRESS_TEXTS = [
    "Yonge - Dundas, Toronto", "King Street West", "East York", "Toronto", "12 Front Street", "Pearson Airport",
    "Old Town", "CityPlace", "Queen East 4", "Woodbine Beach", "Spadina 9", "North York Centre", "Islington 7",
    "Liberty Village", "Weston Road",
]
NAME_TEXTS = ["Airport Inn", "Theatre Hotel", "Beach House", "Bay Street Lodge", "Harbour Castle", "Plain Hotel"]
DISTRICT_TEXTS = ["Harbourfront", "cityplace", "Airport", "Nowhere", " Old Town ", "york", "the annex hotel"]


def pick(texts, key):
    return F.element_at(F.array(*[F.lit(x) for x in texts]), (key % len(texts) + 1).cast("int"))


def pick_sql(texts, key: str) -> str:
    listed = ", ".join("'" + x.replace("'", "''") + "'" for x in texts)
    return f"([{listed}])[CAST(({key}) % {len(texts)} AS INTEGER) + 1]"


@register("parse_price_strict", f"""
WITH {STAYS}
SELECT stay_id, CASE stay_id % 6 WHEN 0 THEN NULL WHEN 1 THEN floor(price) WHEN 2 THEN NULL
                     WHEN 3 THEN price WHEN 4 THEN NULL ELSE floor(price) END AS price
FROM stays""")
def parse_price_strict(spark, folder):
    key, price = F.col("stay_id"), F.col("price")
    whole = F.floor(price).cast("string")
    texts = [F.lit("N/A"), F.concat(F.lit("$"), whole), F.concat(F.lit("US$ "), whole),
             F.concat(F.lit("$"), F.format_number(price, 2)), F.lit("Free airport taxi"), F.concat(whole, F.lit("."))]
    shown = F.element_at(F.array(*texts), (key % 6 + 1).cast("int"))
    return t.stays(spark, folder).select("stay_id", text.parse_price_strict(shown).alias("price"))


@register("parse_distance_text", """
SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_size / 10.0::DOUBLE END AS miles FROM part""")
def parse_distance_text(spark, folder):
    shown = F.when(F.col("p_partkey") % 17 == 0, "N/A").otherwise(
        F.concat((F.col("p_size") / 10.0).cast("string"), F.lit(" miles from downtown"))
    )
    return t.table(spark, folder, "part").select("p_partkey", text.parse_first_number(shown).alias("miles"))


@register("convert_currency", f"SELECT o_orderkey AS stay_id, {rd('o_totalprice * 1.35::DOUBLE', 2)} AS price_cad FROM orders")
def convert_currency(spark, folder):
    return t.stays(spark, folder).select("stay_id", text.convert_currency(F.col("price")).alias("price_cad"))


@register("parse_dates", f"""
WITH {STAYS}
SELECT stay_id, CASE stay_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE checkin END AS day FROM stays""")
def parse_dates(spark, folder):
    shown = F.when(F.col("stay_id") % 4 == 0, "soon").when(F.col("stay_id") % 4 == 1, "2025-13-01").otherwise(
        F.date_format("checkin", "yyyy-MM-dd")
    )
    return t.stays(spark, folder).select("stay_id", text.parse_date(shown).alias("day"))


@register("stay_durations", f"""
WITH {STAYS}
SELECT stay_id, CAST(checkout - checkin AS BIGINT) AS nights,
       CASE WHEN stay_id % 7 = 0 THEN NULL
            ELSE greatest(CAST(checkin - snapshot AS BIGINT) - 10, 0) END AS lead FROM stays""")
def stay_durations(spark, folder):
    snapshot = F.when(F.col("stay_id") % 7 != 0, F.date_add("snapshot", 10))
    return t.stays(spark, folder).select(
        "stay_id",
        dates.stay_nights(F.col("checkin"), F.col("checkout")).alias("nights"),
        dates.lead_days(F.col("checkin"), snapshot).alias("lead"),
    )


@register("calendar_parts", f"""
WITH {STAYS}
SELECT stay_id, CAST(week(checkin) AS BIGINT) AS week_of_year, CAST(month(checkin) AS BIGINT) AS checkin_month,
       CAST(isodow(checkin) - 1 AS BIGINT) AS checkin_day_of_week, CAST(quarter(checkin) AS BIGINT) AS checkin_quarter
FROM stays""")
def calendar_parts(spark, folder):
    parts = dates.calendar_parts(F.col("checkin"))
    return t.stays(spark, folder).select("stay_id", *[c.alias(k) for k, c in parts.items()])


@register("weekend_overlap", f"""
WITH {STAYS}, r AS (
  SELECT stay_id, CASE WHEN stay_id % 13 = 0 THEN NULL ELSE checkin END AS ci,
         CASE WHEN stay_id % 11 = 0 THEN checkin - 2 ELSE checkout END AS co FROM stays),
days AS (SELECT stay_id, unnest(generate_series(ci, co, INTERVAL 1 DAY)) AS d FROM r WHERE ci <= co),
hit AS (SELECT DISTINCT stay_id FROM days WHERE isodow(d) >= 6)
SELECT stay_id, hit.stay_id IS NOT NULL AS is_weekend FROM r LEFT JOIN hit USING (stay_id)""")
def weekend_overlap(spark, folder):
    ci = F.when(F.col("stay_id") % 13 != 0, F.col("checkin"))
    co = F.when(F.col("stay_id") % 11 == 0, F.date_sub("checkin", 2)).otherwise(F.col("checkout"))
    return t.stays(spark, folder).select("stay_id", dates.weekend_overlap(ci, co).alias("is_weekend"))


@register("month_bounds", f"""
WITH {STAYS}
SELECT DISTINCT CAST(date_trunc('month', checkin) AS DATE) AS month_start, last_day(checkin) AS month_end,
       CAST(day(last_day(checkin)) AS BIGINT) AS days_in_month FROM stays""")
def month_bounds(spark, folder):
    return t.stays(spark, folder).select(
        *[c.alias(k) for k, c in dates.month_bounds(F.col("checkin")).items()]
    ).distinct()


@register("haversine_km", f"""
WITH {STAYS} SELECT stay_id, {km('lat', 'lon', '43.6426::DOUBLE', '-79.3871::DOUBLE', 4)} AS km FROM stays""")
def haversine_km(spark, folder):
    d = geo.haversine_km(F.col("lat"), F.col("lon"), F.lit(43.6426), F.lit(-79.3871))
    return tidy(t.stays(spark, folder).select("stay_id", d.alias("km")))


@register("haversine_miles", f"""
WITH {STAYS} SELECT stay_id, {rd(miles('lat', 'lon', '43.6414::DOUBLE', '-79.3894::DOUBLE'))} AS miles FROM stays""")
def haversine_miles(spark, folder):
    d = geo.haversine_miles(F.col("lat"), F.col("lon"), F.lit(43.6414), F.lit(-79.3894))
    return tidy(t.stays(spark, folder).select("stay_id", d.alias("miles")))


BUCKET_INPUTS = {
    "distance_category": ("(stay_id % 80) / 10.0 - 1.0", fv.DISTANCE_BINS),
    "lead_time_category": ("stay_id % 120", fv.LEAD_BINS),
    "stay_category": ("stay_id % 20", fv.STAY_BINS),
    "event_intensity": ("(stay_id % 500) / 2.0", fv.EVENT_BINS),
    "temp_category": ("(stay_id % 1100) / 10.0 - 55.0", fv.TEMPERATURE_BINS),
}


@register("bucketize_right_closed", f"WITH {STAYS} SELECT stay_id, " + ", ".join(
    f"{bucket_sql('(' + expr + ')', *bins)} AS {name}" for name, (expr, bins) in BUCKET_INPUTS.items()) + " FROM stays")
def bucketize_right_closed(spark, folder):
    key = F.col("stay_id")
    inputs = {
        "distance_category": (key % 80) / 10.0 - 1.0,
        "lead_time_category": key % 120,
        "stay_category": key % 20,
        "event_intensity": (key % 500) / 2.0,
        "temp_category": (key % 1100) / 10.0 - 55.0,
    }
    return t.stays(spark, folder).select("stay_id", *[
        buckets.bucket_right_closed(c, *BUCKET_INPUTS[name][1]).alias(name) for name, c in inputs.items()
    ])


@register("interaction_keys", f"""
WITH {STAYS}
SELECT stay_id, CASE WHEN stay_id % 7 <> 0 THEN (CASE WHEN isodow(checkin) >= 6 THEN 'True' ELSE 'False' END)
       || '_' || (CASE WHEN price > 200000 THEN 'True' ELSE 'False' END) END AS weekend_dear,
       district || '_' || room AS district_room FROM stays""")
def interaction_keys(spark, folder):
    weekend = F.when(F.col("stay_id") % 7 != 0, F.weekday("checkin") >= 5)
    return t.stays(spark, folder, district=True).select(
        "stay_id",
        text.interaction(text.python_bool(weekend), text.python_bool(F.col("price") > 200000)).alias("weekend_dear"),
        text.interaction(F.col("district"), F.col("room")).alias("district_room"),
    )


TOP_HOTELS = "top AS (SELECT hotel FROM stays GROUP BY hotel ORDER BY count(*) DESC, hotel LIMIT 5)"


@register("collapse_rare", f"""
WITH {STAYS}, t AS (SELECT stay_id, CASE WHEN stay_id % 9 <> 0 THEN district || '-' || (hotel % 30) END AS kind FROM stays),
top AS (SELECT kind FROM t WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 5)
SELECT stay_id, CASE WHEN kind IN (SELECT kind FROM top) THEN kind ELSE 'other' END AS kind_simple FROM t""")
def collapse_rare(spark, folder):
    kinds = t.stays(spark, folder, district=True).select("stay_id", F.when(
        F.col("stay_id") % 9 != 0, F.concat("district", F.lit("-"), F.col("hotel") % 30)
    ).alias("kind"))
    return collapse_to_top(kinds, "kind", 5, "kind_simple").select("stay_id", "kind_simple")


@register("semi_join_topk", f"WITH {STAYS}, {TOP_HOTELS} SELECT stay_id, hotel FROM stays WHERE hotel IN (SELECT hotel FROM top)")
def semi_join_topk(spark, folder):
    return in_top_categories(t.stays(spark, folder).select("stay_id", "hotel"), "hotel", 5).select("stay_id", "hotel")


@register("log_target", f"""
SELECT o_orderkey AS stay_id, {rd('ln(1 + o_totalprice)', 6)} AS log_price,
       {rd('exp(ln(1 + o_totalprice)) - 1', 2)} AS price FROM orders""")
def log_target(spark, folder):
    log_price = buckets.log_target(F.col("price"))
    return t.stays(spark, folder).select(
        "stay_id", F.round(log_price, 6).alias("log_price"),
        F.round(buckets.inverse_log_target(log_price), 2).alias("price"),
    )


@register("classify_room", f"""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 23 <> 0
             THEN {pick_sql(ROOM_TEXTS, 'o_orderkey')} || ' ' || o_orderpriority END AS room FROM orders)
SELECT o_orderkey AS stay_id, room, {case_sql('room', fv.ROOM_RULES, fv.DEFAULT_ROOM)} AS room_category FROM r""")
def classify_room(spark, folder):
    key = F.col("stay_id")
    room = F.when(key % 23 != 0, F.concat(pick(ROOM_TEXTS, key), F.lit(" "), F.col("room")))
    return t.stays(spark, folder).select("stay_id", room.alias("room")).withColumn(
        "room_category", rules.classify_room(F.col("room"))
    )


@register("classify_district", f"""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 23 <> 0 THEN {pick_sql(ADDRESS_TEXTS, 'o_orderkey')} END AS address,
             {pick_sql(NAME_TEXTS, 'o_custkey')} AS name,
             CASE WHEN o_orderkey % 29 = 0 THEN 'Given' END AS given FROM orders)
SELECT o_orderkey AS stay_id, coalesce(given, {case_sql('address', fv.ADDRESS_RULES)},
       {case_sql('name', fv.HOTEL_NAME_RULES)}) AS district FROM r""")
def classify_district(spark, folder):
    key = F.col("stay_id")
    address = F.when(key % 23 != 0, pick(ADDRESS_TEXTS, key))
    given = F.when(key % 29 == 0, F.lit("Given"))
    return t.stays(spark, folder).select(
        "stay_id", rules.classify_district(address, pick(NAME_TEXTS, F.col("hotel")), given).alias("district")
    )


@register("keyword_rule_join", f"""
SELECT doc_id, {case_sql('text', [('license', ['license', 'copyright']), ('contact', ['@', 'tel']), ('web', ['http'])], 'none')} AS kind
FROM documents""")
def keyword_rule_join(spark, folder):
    kinds = [("license", ["license", "copyright"]), ("contact", ["@", "tel"]), ("web", ["http"])]
    return t.table(spark, folder, "documents").select(
        "doc_id", F.coalesce(rules.first_match(F.col("text"), kinds), F.lit("none")).alias("kind")
    )


def _tier_sql() -> str:
    rows = ", ".join(
        f"({i}, '{n}', {lat}::DOUBLE, {lon}::DOUBLE)" for i, (n, lat, lon) in enumerate(fv.DISTRICTS)
    )
    return f"""
WITH d(ord, name, lat, lon) AS (VALUES {rows}),
k AS (SELECT o_orderkey, CASE WHEN o_orderkey % 23 <> 0 THEN {pick_sql(DISTRICT_TEXTS, 'o_orderkey')} END AS raw FROM orders),
u AS (SELECT DISTINCT raw, trim(raw) AS key FROM k),
c AS (
  SELECT raw, d.*, CASE WHEN key = name THEN 1 WHEN lower(key) = lower(name) THEN 2
    WHEN contains(lower(name), lower(key)) OR contains(lower(key), lower(name)) THEN 3
    WHEN name = '{fv.DEFAULT_DISTRICT}' THEN 4 END AS tier FROM u, d),
b AS (SELECT * FROM c WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY raw ORDER BY tier, ord) = 1)
SELECT o_orderkey AS stay_id, b.name, b.lat, b.lon, CAST(b.tier AS BIGINT) AS tier
FROM k JOIN b ON k.raw IS NOT DISTINCT FROM b.raw"""


@register("tiered_lookup", _tier_sql())
def tiered_lookup(spark, folder):
    key = F.col("stay_id")
    raw = F.when(key % 23 != 0, pick(DISTRICT_TEXTS, key))
    return tidy(
        t.stays(spark, folder)
        .select("stay_id", rules.tiered_lookup(raw, fv.DISTRICTS, fv.DEFAULT_DISTRICT).alias("p"))
        .select("stay_id", "p.name", "p.lat", "p.lon", "p.tier"), keep=("lat", "lon"),
    )


def _nearest_sql() -> str:
    rows = ", ".join(
        f"({i}, '{n}', {lat}::DOUBLE, {lon}::DOUBLE)" for i, (n, lat, lon) in enumerate(fv.DISTRICTS[:-1])
    )
    return f"""
WITH {STAYS}, d(ord, name, dlat, dlon) AS (VALUES {rows}),
p AS (SELECT DISTINCT lat, lon FROM stays WHERE lat IS NOT NULL),
c AS (SELECT p.lat, p.lon, name, {km('p.lat', 'p.lon', 'dlat', 'dlon', 15)} AS km, ord FROM p, d),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY km, ord) = 1)
SELECT stay_id, b.name AS district, {rd('b.km')} AS km FROM stays s LEFT JOIN b ON s.lat = b.lat AND s.lon = b.lon"""


@register("nearest_neighbour", _nearest_sql())
def nearest_neighbour(spark, folder):
    return tidy(
        t.stays(spark, folder)
        .select("stay_id", geo.nearest_point(F.col("lat"), F.col("lon"), fv.DISTRICTS[:-1]).alias("p"))
        .select("stay_id", F.col("p.name").alias("district"), "p.km")
    )


SEGMENTS = ["Sports", "Music", "Arts & Theatre", "Miscellaneous", "Undefined", "Film"]
GENRES = ["Hockey", "Rock", "Comedy", "Pop", "Jazz"]
SUBGENRES = ["NHL", "Rock", "Musical", "Alternative", "Other"]
VENUES = ["Scotiabank Arena", "Massey Hall", "Comedy Bar - Danforth", "NOVENUE", "Somewhere", "Rogers Centre"]
EVENT_NAMES = ["Big Game", "Pride Walk", "Tiffany Live", "Cindy Lee", "Fan Expo 25", "Concert", "Evening", "Marathon"]


def _score_sql() -> str:
    def table(column, values, default):
        arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items())
        return f"(CASE {column} {arms} ELSE {default} END)"

    special = " ".join(f"WHEN contains(lower(name), '{w}') THEN {s}" for w, s in fv.SPECIAL_EVENTS)
    parts = " + ".join([
        table("segment", fv.SEGMENT_SCORES, 2), table("genre", fv.GENRE_SCORES, 2), table("subgenre", fv.SUBGENRE_SCORES, 2),
    ])
    return f"""
scored AS (
  SELECT *, CASE {special} ELSE {rd(f"CAST({parts} AS DOUBLE) / 3 * CAST({table('venue', fv.VENUE_MULTIPLIERS, 0.9)} AS DOUBLE)", 2)} END AS score
  FROM (SELECT event_id, {pick_sql(EVENT_NAMES, 'event_id')} AS name,
          CASE WHEN event_id % 19 <> 0 THEN {pick_sql(SEGMENTS, 'user_id')} END AS segment,
          {pick_sql(GENRES, 'event_id + user_id')} AS genre, {pick_sql(SUBGENRES, 'user_id + 3')} AS subgenre,
          {pick_sql(VENUES, 'event_id + 1')} AS venue FROM events))"""


def scored_events(spark, folder):
    e, u = F.col("event_id"), F.col("user_id")
    named = t.table(spark, folder, "events").select(
        "event_id", pick(EVENT_NAMES, e).alias("name"), F.when(e % 19 != 0, pick(SEGMENTS, u)).alias("segment"),
        pick(GENRES, e + u).alias("genre"), pick(SUBGENRES, u + 3).alias("subgenre"), pick(VENUES, e + 1).alias("venue"),
    )
    return named.withColumn("score", rules.event_score(*[F.col(c) for c in ("name", "segment", "genre", "subgenre", "venue")]))


@register("event_score", f"WITH {_score_sql()} SELECT event_id, name, CAST(score AS DOUBLE) AS score FROM scored")
def event_score(spark, folder):
    return scored_events(spark, folder).select("event_id", "name", "score")


@register("topk_events", f"""
WITH {_score_sql()} SELECT event_id, name, venue, CAST(score AS DOUBLE) AS score FROM scored ORDER BY score DESC, event_id LIMIT 10""")
def topk_events(spark, folder):
    return top_k(scored_events(spark, folder), 10, F.desc("score"), F.asc("event_id")).select(
        "event_id", "name", "venue", "score"
    )


def _labels_sql() -> str:
    return f"""
WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders),
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(o_totalprice) AS mu, avg(ln(1 + o_totalprice)) AS lmu FROM orders),
f AS (
  SELECT any_value(n) AS n,
         avg(power(o_totalprice - mu, 3)) / power(avg(power(o_totalprice - mu, 2)), 1.5) AS skew,
         avg(power(o_totalprice - mu, 4)) / power(avg(power(o_totalprice - mu, 2)), 2) - 3 AS kurt,
         avg(power(ln(1 + o_totalprice) - lmu, 3)) / power(avg(power(ln(1 + o_totalprice) - lmu, 2)), 1.5) AS lskew,
         count(*) FILTER (o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) * 100.0::DOUBLE
           / count(*) AS outlier_pct
  FROM orders, q, m)
SELECT CAST(n AS BIGINT) AS n,
  CASE WHEN skew > 1 THEN 'highly right-skewed' WHEN skew > 0.5 THEN 'moderately right-skewed'
       WHEN skew > -0.5 THEN 'approximately symmetric' ELSE 'left-skewed' END AS skew_label,
  CASE WHEN kurt > 3 THEN 'heavy-tailed' WHEN kurt < -1 THEN 'light-tailed' ELSE 'normal tails' END AS kurtosis_label,
  'not normal' AS normality_label,
  CASE WHEN abs(skew) > 1 THEN 'log recommended' WHEN abs(skew) > 0.5 THEN 'consider log' ELSE 'original scale' END AS transform_label,
  CASE WHEN abs(lskew) < abs(skew) AND abs(lskew) < 0.5 THEN 'use log1p' ELSE 'minimal improvement' END AS log_label,
  {rd('outlier_pct')} AS outlier_pct, CASE WHEN outlier_pct > 5 THEN 'high' ELSE 'manageable' END AS outlier_label
FROM f"""


@register("profile_labels", _labels_sql())
def profile_labels(spark, folder):
    return profile.profile_labels(t.stays(spark, folder), "price")
