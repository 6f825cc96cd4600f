"""Scans and sinks, run over files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayglass.catalog.registry import STAYS, rd, register, tidy
from stayglass.functions import text
from stayglass.operators import columns as cols
from stayglass.operators import splits
from stayglass.plans.combine import combine_snapshots
from stayglass.session import work_path
from stayglass.sources import captured, files
from stayglass.sources import tables as t


def snapshot_files(spark, folder) -> str:
    """Every order as a listing row, in three CSV layouts below one folder; returns the glob.

    Late copies of each listing of the last layout go to an extra file of their own.
    """
    stays = t.stays(spark, folder)
    out = work_path(spark, "listings")
    base = [
        F.date_format("snapshot", "yyyy-MM-dd").alias("Date"),
        F.lit("booking").alias("Source"),
        F.date_format("checkin", "yyyy-MM-dd").alias("Check-in Date"),
        F.date_format("checkout", "yyyy-MM-dd").alias("Check-out Date"),
    ]
    hotel = F.concat(F.lit("Hotel, "), F.col("hotel").cast("string"))
    price = F.when(F.col("stay_id") % 17 == 0, F.lit("N/A")).otherwise(
        F.concat(F.lit("$"), F.format_number("price", 2))
    )
    key = F.col("stay_id").cast("string").alias("Listing")
    layouts = {
        0: [*base, hotel.alias("Hotel name"), key, price.alias("price")],
        1: [*base[:2], F.lit("2").alias("Number of People"), *base[2:], hotel.alias("Hotel name"),
            F.col("room").alias("Room Type"), key, price.alias("price")],
        2: [*base[:2], F.lit("2").alias("Number of People"), *base[2:], hotel.alias("Hotel name"),
            F.lit("4").alias("Star Rating"), F.col("room").alias("Room Type"), key, price.alias("price")],
    }
    for i, columns in layouts.items():
        files.write_csv(stays.where(F.col("stay_id") % 3 == i).select(*columns), f"{out}/{i}")
    late = stays.where(F.col("stay_id") % 3 == 2).select(*layouts[2])
    files.write_csv(late.withColumn("Listing", F.concat(F.lit("copy of "), "Listing")), f"{out}/9")
    return f"{out}/*/*.csv"


@register("scan_drift_union", f"""
WITH {STAYS}, u AS (
  SELECT *, stay_id % 3 AS layout, CAST(stay_id AS VARCHAR) AS listing FROM stays
  UNION ALL SELECT *, 2 AS layout, 'copy of ' || stay_id AS listing FROM stays WHERE stay_id % 3 = 2)
SELECT strftime(snapshot, '%Y-%m-%d') AS "Date", 'booking' AS "Source",
       strftime(checkin, '%Y-%m-%d') AS "Check-in Date", strftime(checkout, '%Y-%m-%d') AS "Check-out Date",
       CASE WHEN layout > 0 THEN '2' END AS "Number of People", 'Hotel, ' || hotel AS "Hotel name",
       CASE WHEN layout > 0 THEN room END AS "Room Type", CASE WHEN layout = 2 THEN '4' END AS "Star Rating",
       listing AS "Listing", CASE WHEN stay_id % 17 <> 0 THEN price END AS price
FROM u""")
def scan_drift_union(spark, folder):
    raw = files.scan_drifting_csv(spark, snapshot_files(spark, folder))
    return files.normalise_na(raw).withColumn("price", text.parse_price_strict(F.col("price")))


@register("scan_na_tokens", f"""
WITH {STAYS}
SELECT stay_id, CASE WHEN stay_id % 17 <> 0 THEN room END AS room,
       CASE WHEN stay_id % 17 <> 0 AND stay_id % 5 <> 0 THEN price END AS price
FROM stays""")
def scan_na_tokens(spark, folder):
    key = F.col("stay_id")
    junk = F.element_at(F.array(*[F.lit(x) for x in ("N/A", "nan", "None", "null", " NA ")]), (key % 5 + 1).cast("int"))
    listed = t.stays(spark, folder).select(
        "stay_id",
        F.when(key % 17 == 0, junk).otherwise(F.col("room")).alias("room"),
        F.when((key % 17 == 0) | (key % 5 == 0), junk).otherwise(F.col("price").cast("string")).alias("price"),
    )
    path = files.write_csv(listed, work_path(spark, "na"))
    return cols.coerce(files.scan_csv(spark, path), {"stay_id": "bigint", "price": "double"})


@register("scan_prefer_source", "SELECT o_orderkey AS stay_id, o_totalprice AS price FROM orders")
def scan_prefer_source(spark, folder):
    stored = files.write_table(
        t.stays(spark, folder).select("stay_id", "price"), work_path(spark, "preferred")
    )
    return files.scan_preferred(spark, f"{stored}-cleaned", stored)


@register("json_flatten_events", """
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS d FROM events),
both_ AS (SELECT *, event_type || ' A' AS nm FROM e UNION ALL SELECT *, event_type || ' B' AS nm FROM e)
SELECT event_id, nm AS "Event Name", CASE WHEN event_id % 11 = 0 THEN 'N/A' ELSE d END AS "Date",
       CASE WHEN user_id % 7 = 0 THEN 'N/A' ELSE 'Venue ' || (user_id % 10) END AS "Venue",
       CASE WHEN user_id % 7 = 0 THEN 'N/A' ELSE user_id || ' Main Street' END AS "Address",
       CASE WHEN user_id % 7 = 0 OR user_id % 5 = 0 THEN 'N/A' ELSE '43.6' || (user_id % 10) END AS "Latitude",
       CASE WHEN user_id % 7 = 0 OR user_id % 5 = 0 THEN 'N/A' ELSE '-79.4' || (user_id % 10) END AS "Longitude",
       CASE WHEN event_id % 13 = 0 THEN 'N/A' ELSE event_type END AS "Segment",
       CASE WHEN event_id % 13 = 0 THEN 'N/A' ELSE 'G' || (event_id % 3) END AS "Genre",
       'N/A' AS "SubGenre"
FROM both_""")
def json_flatten_events(spark, folder):
    e, user = F.col("event_id"), F.col("user_id")
    place = F.when(user % 5 != 0, F.struct(
        F.concat(F.lit("43.6"), user % 10).alias("latitude"),
        F.concat(F.lit("-79.4"), user % 10).alias("longitude"),
    ))
    venue = F.struct(
        F.concat(F.lit("Venue "), user % 10).alias("name"),
        F.struct(F.concat(user, F.lit(" Main Street")).alias("line1")).alias("address"),
        place.alias("location"),
    )
    kind = F.struct(
        F.struct(F.col("event_type").alias("name")).alias("segment"),
        F.struct(F.concat(F.lit("G"), e % 3).alias("name")).alias("genre"),
    )
    no_venues = F.when(user % 7 != 0, F.array(venue))

    def event(suffix):
        return F.struct(
            F.concat("event_type", F.lit(suffix)).alias("name"),
            F.struct(F.struct(F.when(e % 11 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("localDate")).alias("start")).alias("dates"),
            F.struct(no_venues.alias("venues")).alias("_embedded"),
            F.when(e % 13 != 0, F.array(kind)).alias("classifications"),
        )

    pages = t.table(spark, folder, "events").select("event_id", F.to_json(F.struct(
        F.struct(F.array(event(" A"), event(" B")).alias("events")).alias("_embedded"),
        F.struct(F.lit(1).alias("totalPages")).alias("page"),
    )).alias("body"))
    stored = work_path(spark, "event-pages")
    files.write_table(pages, stored)
    return captured.flatten_event_pages(spark.read.parquet(stored), "body", ["event_id"])


@register("json_unwrap_properties", """
SELECT CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1""")
def json_unwrap_properties(spark, folder):
    pages = t.table(spark, folder, "events").select(
        F.concat(F.lit('{"features": [{"properties": '), "props", F.lit("}]}")).alias("body")
    )
    return captured.unwrap_properties(pages, "body", "k: BIGINT").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@register("clean_weather", """
SELECT CAST(event_id AS VARCHAR) AS "ID", CAST(ts AS DATE) AS "LOCAL_DATE", value AS "MEAN_TEMPERATURE" FROM events""")
def clean_weather(spark, folder):
    raw = t.table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("ID"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("LOCAL_DATE"),
        F.col("value").alias("MEAN_TEMPERATURE"),
        F.col("props").alias("MIN_REL_HUMIDITY_FLAG"),
    )
    return captured.clean_weather(raw)


@register("union_partitions", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS local_year, count(*) AS n, """ + rd("sum(o_totalprice)", 2) + """ AS total
FROM orders GROUP BY 1""")
def union_partitions(spark, folder):
    yearly = t.stays(spark, folder).select("price", F.year("checkin").alias("local_year"))
    stored = files.write_table(yearly, work_path(spark, "yearly"), ["local_year"])
    early = spark.read.parquet(stored).where("local_year < 1998")
    late = spark.read.parquet(stored).where("local_year >= 1998")
    return tidy(
        captured.union_partials([early, late]).groupBy("local_year").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total")
        ), 2,
    )


@register("html_field_extract", r"""
SELECT page_id,
  coalesce(nullif(trim(regexp_extract(html, '<html[^>]*lang="([^"]+)"', 1)), ''), 'N/A') AS lang,
  coalesce(nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), ''), 'N/A') AS title,
  coalesce(nullif(trim(regexp_extract(html, '<h1[^>]*>([^<]+)<', 1)), ''),
           nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), ''), 'N/A') AS heading,
  coalesce(nullif(trim(regexp_extract(html, 'data-testid="price"[^>]*>([^<]+)<', 1)), ''), 'N/A') AS price
FROM pages""")
def html_field_extract(spark, folder):
    html = F.col("html")
    title = r"<title>([^<]*)</title>"
    return t.table(spark, folder, "pages").select(
        "page_id",
        captured.extract_field(html, [r'<html[^>]*lang="([^"]+)"']).alias("lang"),
        captured.extract_field(html, [title]).alias("title"),
        captured.extract_field(html, [r"<h1[^>]*>([^<]+)<", title]).alias("heading"),
        captured.extract_field(html, [r'data-testid="price"[^>]*>([^<]+)<']).alias("price"),
    )


@register("listing_cards", f"""
WITH {STAYS}, c AS (SELECT *, 1 AS slot FROM stays UNION ALL SELECT *, 2 AS slot FROM stays)
SELECT stay_id AS page_id, 'Hotel ' || hotel || ' ' || slot AS "Hotel name",
       CASE WHEN slot = 1 THEN 'Downtown' ELSE 'N/A' END AS "Address", room AS "Room Type",
       CASE WHEN stay_id % 3 = 0 THEN 'N/A' ELSE (stay_id % 9) || ' miles from downtown' END AS "Distance from attraction",
       'N/A' AS "Deal Info", 'US$ ' || (stay_id % 900) AS price
FROM c""")
def listing_cards(spark, folder):
    def card(slot):
        place = ' data-testid="address" class="x">Downtown<' if slot == 1 else ' class="x">Downtown<'
        room = (
            '<div data-testid="availability-single"><h4>' if slot == 1 else '<div class="room-type"><b></b></div><div class="room-type">'
        )
        return F.concat(
            F.lit('<div data-testid="property-card"><div data-testid="title">Hotel '), F.col("hotel"),
            F.lit(f" {slot}</div><span{place}/span>"), F.lit(room), F.col("room"), F.lit("</h4></div>"),
            F.when(F.col("stay_id") % 3 != 0, F.concat(
                F.lit('<span data-testid="distance">'), F.col("stay_id") % 9, F.lit(" miles from downtown</span>")
            )).otherwise(""),
            F.lit('<span data-testid="price-and-discounted-price">US$\n'), F.col("stay_id") % 900, F.lit("</span></div>"),
        )

    pages = t.stays(spark, folder).select(
        F.col("stay_id").alias("page_id"), F.concat(F.lit("<html>"), card(1), card(2), F.lit("</html>")).alias("html")
    )
    return captured.listing_cards(pages, "html", ["page_id"])


@register("stamp_metadata", """
SELECT DATE '2025-09-24' AS "Date", 'booking' AS "Source", CAST(2 AS BIGINT) AS "Number of People",
       DATE '2025-10-10' AS "Check-in Date", o_orderkey AS stay_id, o_totalprice AS price FROM orders""")
def stamp_metadata(spark, folder):
    import datetime as dt

    return tidy(files.stamp_metadata(
        t.stays(spark, folder).select("stay_id", "price"),
        {"Date": dt.date(2025, 9, 24), "Source": "booking", "Number of People": 2, "Check-in Date": dt.date(2025, 10, 10)},
    ), keep=("price",))


@register("sink_roundtrip", f"WITH {STAYS} SELECT stay_id, checkin, price, room, lat FROM stays")
def sink_roundtrip(spark, folder):
    stays = t.stays(spark, folder).select("stay_id", "checkin", "price", "room", "lat")
    as_csv = files.write_csv(stays, work_path(spark, "sink-csv"))
    typed = cols.coerce(
        files.scan_csv(spark, as_csv), {"stay_id": "bigint", "checkin": "date", "price": "double", "lat": "double"}
    )
    stored = files.write_table(typed, work_path(spark, "sink"))
    # replace the table by rows read from itself
    files.replace_table(spark.read.parquet(stored), stored)
    return spark.read.parquet(stored)


RANDOM_SPLIT = f"""
WITH {STAYS}, r AS (
  SELECT *, row_number() OVER (ORDER BY md5('42|' || stay_id)) AS rn, count(*) OVER () AS n FROM stays),
h AS (SELECT *, rn > n - CAST(ceil(0.4::DOUBLE * n) AS BIGINT) AS held FROM r),
v AS (SELECT *, row_number() OVER (PARTITION BY held ORDER BY md5('43|' || stay_id)) AS rn2,
             count(*) OVER (PARTITION BY held) AS n2 FROM h),
split AS (SELECT *, CASE WHEN NOT held THEN 'train'
                         WHEN rn2 <= n2 - CAST(ceil(0.5::DOUBLE * n2) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM v)
"""


@register("split_metadata", RANDOM_SPLIT + """
SELECT 'random' AS split_type, CAST(42 AS BIGINT) AS random_state, count(*) AS total_samples,
       count(*) FILTER (split = 'train') AS train_samples, count(*) FILTER (split = 'val') AS val_samples,
       count(*) FILTER (split = 'test') AS test_samples,
       """ + ", ".join(f"{rd(f'CAST(count(*) FILTER (split = {s!r}) AS DOUBLE) / count(*)')} AS {s}_ratio" for s in ("train", "val", "test")) + """,
       'room,price' AS features
FROM split""")
def split_metadata(spark, folder):
    parts = splits.random_split(t.stays(spark, folder), "stay_id")
    meta = splits.split_metadata(parts, "random", 42, ["room", "price"])
    return meta.withColumn("features", F.concat_ws(",", "feature_columns")).drop("feature_columns")


@register("load_split_projection", RANDOM_SPLIT + "SELECT room, lat, price FROM split WHERE split = 'val'")
def load_split_projection(spark, folder):
    parts = splits.random_split(t.stays(spark, folder), "stay_id")
    stored = files.write_splits(
        parts, splits.split_metadata(parts, "random", 42, ["room", "lat"]), work_path(spark, "splits")
    )
    return files.load_split(spark, stored, "val", ["price"])


@register("job_combine", f"""
WITH {STAYS}, u AS (
  SELECT *, stay_id % 3 AS layout, CAST(stay_id AS VARCHAR) AS listing, 0 AS late FROM stays
  UNION ALL SELECT *, 2, 'copy of ' || stay_id, 1 FROM stays WHERE stay_id % 3 = 2),
k AS (SELECT DISTINCT hotel, checkin, checkout, snapshot, CASE WHEN layout > 0 THEN room END AS room FROM u)
SELECT count(*) AS listings, CAST(count(room) AS BIGINT) AS with_room, CAST(0 AS BIGINT) AS late_copies FROM k""")
def job_combine(spark, folder):
    combined = combine_snapshots(spark, snapshot_files(spark, folder))
    return combined.agg(
        F.count(F.lit(1)).alias("listings"),
        F.count("Room Type").alias("with_room"),
        F.count_if(F.col("Listing").startswith("copy of")).alias("late_copies"),
    )
