"""Files, captured pages, jobs over files, streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stayglass.plans import combine, fix_distances
from stayglass.plans import transform as tp
from stayglass.session import work_path
from stayglass.sources import captured, files
from stayglass.streaming import ingest

HEADERS = {
    "a.csv": "Date,Source,Check-in Date,Check-out Date,name,score,price",
    "b.csv": "Date,Source,Number of People,Check-in Date,Check-out Date,Hotel name,Address,Room Type,price",
    "c.csv": "Date,Source,Number of People,Check-in Date,Check-out Date,Hotel name,Address,Star Rating,Room Type,price",
}


@pytest.fixture()
def drop(tmp_path):
    rows = {
        "a.csv": ["2025-09-19,s,2025-10-03,2025-10-06,Old One,N/A,$261", "2025-09-19,s,2025-10-03,2025-10-06,Old Two,N/A,$205"],
        "b.csv": ['2025-09-20,s,2,2025-10-03,2025-10-06,Inn,"Old Town, City",King Room,"$1,200"'],
        "c.csv": ['2025-09-20,s,2,2025-10-03,2025-10-06,Inn,"Old Town, City",4,King Room,$99', "2025-09-21,s,2,2025-10-03,2025-10-06,Inn,x,4,N/A,N/A"],
    }
    for name, header in HEADERS.items():
        (tmp_path / name).write_text("\n".join([header, *rows[name]]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    return str(tmp_path / "*.csv")


def test_drifting_headers_map_by_name(spark, drop):
    df = files.scan_drifting_csv(spark, drop)
    assert df.count() == 5 and len(df.columns) == 12
    got = {(r["name"], r["Hotel name"], r["Address"], r["price"]) for r in df.collect()}
    assert ("Old One", None, None, "$261") in got and (None, "Inn", "Old Town, City", "$1,200") in got
    assert files.header_of(spark, drop.replace("*", "absent")) is None


def test_combine_keeps_first_and_collapses_keyless_rows(spark, drop):
    got = combine.combine_snapshots(spark, drop).collect()
    assert len(got) == 3
    assert {r["price"] for r in got if r["Hotel name"]} == {"$1,200", None}
    assert [r["name"] for r in got if not r["Hotel name"]] == ["Old One"]
    renamed = combine.combine_snapshots(spark, drop, {"name": "Hotel name"})
    assert renamed.count() == 4 and "name" not in renamed.columns


def test_preferred_source(spark):
    second = files.write_table(spark.range(3).toDF("i"), work_path(spark, "second"))
    assert files.scan_preferred(spark, second + "-first", second).count() == 3
    with pytest.raises(FileNotFoundError):
        files.scan_preferred(spark, second + "-first")


def test_replace_table_read_from_itself(spark):
    path = files.write_table(spark.range(5).toDF("i"), work_path(spark, "table"))
    copy = work_path(spark, "copy")
    files.replace_table(spark.read.parquet(path).withColumn("i", F.col("i") + 10), path, copy)
    files.replace_table(spark.read.parquet(path).withColumn("i", F.col("i") + 10), path)
    assert sorted(r["i"] for r in spark.read.parquet(path).collect()) == [20, 21, 22, 23, 24]
    assert sorted(r["i"] for r in spark.read.parquet(copy).collect()) == [10, 11, 12, 13, 14]


def test_event_pages(spark):
    page = {"_embedded": {"events": [
        {"name": "Game", "dates": {"start": {"localDate": "2025-10-10"}}, "_embedded": {"venues": [
            {"name": "Arena", "address": {"line1": "1 St"}, "location": {"latitude": "43.6", "longitude": "-79.3"}}, {"name": "Other"}]},
         "classifications": [{"segment": {"name": "Sports"}, "genre": {"name": "Hockey"}}]},
        {"name": "Bare"}]}, "page": {"totalPages": 1}}
    df = spark.createDataFrame([(json.dumps(page),), (json.dumps({"page": {"totalPages": 0}}),), ("broken",)], "body string")
    got = [tuple(r) for r in captured.flatten_event_pages(df, "body").orderBy(F.desc("Event Name")).collect()]
    assert got[0] == ("Game", "2025-10-10", "Arena", "1 St", "43.6", "-79.3", "Sports", "Hockey", "N/A")
    assert got[1] == ("Bare", *["N/A"] * 8)


def test_weather_pages(spark):
    page = {"features": [{"properties": {"STATION_NAME": "A", "LOCAL_DATE": "2025-10-10 00:00:00", "MEAN_TEMPERATURE": 9.5, "OTHER": 1}}]}
    raw = captured.unwrap_properties(spark.createDataFrame([(json.dumps(page),)], "b string"), "b",
                                     "STATION_NAME STRING, LOCAL_DATE STRING, MEAN_TEMPERATURE DOUBLE, OTHER INT")
    assert captured.clean_weather(raw).first().asDict() == {
        "STATION_NAME": "A", "LOCAL_DATE": dt.date(2025, 10, 10), "MEAN_TEMPERATURE": 9.5}


def test_listing_cards(spark):
    html = ('<div data-testid="property-card"><div data-testid="title">Inn</div><span data-testid="address">Here</span>'
            '<div data-testid="availability-single"><div><h4 class="q">King Room</h4></div></div>'
            '<span class="sr-hotel__distance">1 mile</span><span data-testid="price-and-discounted-price">$\n99</span></div>'
            '<div data-testid="property-card">nothing</div>')
    got = [tuple(r) for r in captured.listing_cards(spark.createDataFrame([(html,), ("<html/>",)], "h string"), "h").collect()]
    assert got == [("Inn", "Here", "King Room", "1 mile", "N/A", "$ 99"), ("N/A",) * 6]


def test_stamp_puts_metadata_first(spark):
    df = files.stamp_metadata(spark.createDataFrame([("Inn",)], "`Hotel name` string"), {"Source": "s", "Date": "2025-10-10"})
    assert df.columns == ["Date", "Source", "Hotel name"]


def test_transform_small(spark):
    rows = [
        ("2025-09-24", "2025-10-10", "2025-10-13", "Airport Inn", None, " King Room ", "0.6 miles from downtown", "$100"),
        ("2025-10-11", "2025-10-10", "2025-10-13", "Plain", "Nowhere", None, None, "N/A"),
        ("2025-09-24", "2025-10-14", "2025-10-16", "Scarborough Home", None, "x", None, "$1,574"),
        ("2025-09-24", "2025-10-14", "2025-10-16", "Cheap", "Church Street", "Studio", None, "$24"),
        ("2025-09-24", "2025-10-14", "2025-10-16", "Fair", "Church Street", "Studio", None, "$25"),
    ]
    df = spark.createDataFrame(rows, "Date string, `Check-in Date` string, `Check-out Date` string, `Hotel name` string, Address string, "
                                     "`Room Type` string, `Distance from attraction` string, price string")
    days = spark.createDataFrame([(dt.date(2025, 10, 13),)], "day date")
    out = tp.transform(df, days)
    got = {r["Hotel name"]: r for r in out.collect()}
    assert got.keys() == {"Airport Inn", "Plain", "Fair"}
    a, p, f = got["Airport Inn"], got["Plain"], got["Fair"]
    assert (a["price_usd"], a["price_cad"], a["Distance from attraction"], a["Room Type"]) == (100.0, 135.0, 0.6, "King Room")
    assert (a["district"], a["latitude"], a["is_holiday"], a["is_weekend"], a["booking_lead_time"]) == ("Airport Area", 43.6777, True, True, 16)
    assert (p["district"], p["price_usd"], p["booking_lead_time"], p["room_category"]) == ("Yonge - Dundas", None, 0, "Standard")
    assert (f["district"], f["is_holiday"], f["is_weekend"], f["length_of_stay"]) == ("Church-Wellesley Village", False, False, 2)
    assert f["MEAN_TEMPERATURE"] == 10.5
    open_ended = {r["Hotel name"]: r["district"] for r in tp.transform(df, days, unknown_at_centre=False).collect()}
    assert open_ended["Plain"] is None


def test_fix_distances_job(spark):
    rows = [(i, 43.60 + i % 7 / 50, -79.5 + i % 5 / 40, 1.0 * i if i % 2 else None) for i in range(40)]
    path = files.write_table(spark.createDataFrame(rows, "i int, latitude double, longitude double, `Distance from attraction` double"),
                             work_path(spark, "fix"))
    check = fix_distances.run(spark.read.parquet(path), path, bounds=(0.0, 3.0)).first()
    assert check["with_value"] == 40 and check["plausible"] + check["implausible"] == 40 and check["min_value"] <= 3.0
    got = {r["i"]: r["Distance from attraction"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 40 and got[3] == 3.0 and all(v is not None for v in got.values())


def test_stream_dedupe_over_several_drops(spark):
    ts = dt.datetime(2025, 10, 10)
    folder = work_path(spark, "drops")
    schema = "k int, ts timestamp, n int"
    for n in range(3):
        data = [(k, ts + dt.timedelta(hours=n), n) for k in range(n + 2)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = ingest.file_stream(spark, folder, spark.read.parquet(folder).schema, files_per_trigger=1)
    state, out = work_path(spark, "state"), work_path(spark, "out")
    ingest.run_available(ingest.dedupe_stream(stream, ["k"], "ts", "5 days"), out, state)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]
    spark.createDataFrame([(0, ts, 9), (7, ts + dt.timedelta(hours=9), 9)], schema).coalesce(1).write.mode("append").parquet(folder)
    ingest.run_available(ingest.dedupe_stream(stream, ["k"], "ts", "5 days"), out, state)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 7]


def test_stream_daily_counts_equal_batch(spark):
    data = [(dt.datetime(2025, 10, 1) + dt.timedelta(hours=7 * i),) for i in range(30)]
    folder = files.write_table(spark.createDataFrame(data, "ts timestamp"), work_path(spark, "daily"))
    stream = ingest.file_stream(spark, folder, spark.read.parquet(folder).schema)
    out = ingest.run_available(ingest.daily_counts_stream(stream, "ts", "1 hour"), work_path(spark, "o"), work_path(spark, "s"))
    got = {r["day"]: r["n"] for r in spark.read.parquet(out).collect()}
    batch = {}
    for (t,) in data:
        batch[t.date()] = batch.get(t.date(), 0) + 1
    last = data[-1][0].date()
    assert got == {d: n for d, n in batch.items() if d < last}


def test_maintained_counts_follow_late_rows_and_survive_a_repeated_batch(spark):
    folder, table, state = (work_path(spark, x) for x in ("late", "late-counts", "late-state"))
    day, schema, seen = dt.datetime(2025, 10, 1), "ts timestamp, `a.b` string", []
    drops = [
        [(day + dt.timedelta(hours=9 * i), "xy"[i % 2]) for i in range(20)],
        [(day + dt.timedelta(days=30), "x")] * 3 + [(None, "y"), (day, None)],
        [(day + dt.timedelta(hours=1), "x")] * 2 + [(day - dt.timedelta(days=400), "y")],  # very late
        [(day, "x")],
    ]
    for number, drop in enumerate(drops):
        rows = spark.createDataFrame(drop, schema).coalesce(1)
        rows.write.mode("append").parquet(folder)
        stream = ingest.file_stream(spark, folder, rows.schema, files_per_trigger=1)
        ingest.maintain_daily_counts(stream, "ts", table, state, ["a.b"])
        seen += drop
        want = {}
        for ts, kind in seen:
            key = (ts and ts.date(), kind)
            want[key] = want.get(key, 0) + 1
        for repeat in range(2):
            assert {(r[0], r[1]): r[2] for r in ingest.daily_counts(spark, table).select("day", "`a.b`", "n").collect()} == want
            ingest.merge_daily_counts(rows, number, "ts", table, ["a.b"])  # as after a lost driver
    assert len(files.list_files(spark, f"{table}/v*/_SUCCESS")) == ingest.KEPT_VERSIONS
    with pytest.raises(FileNotFoundError):
        ingest.daily_counts(spark, work_path(spark, "nothing"))


def test_header_with_quoted_comma_and_a_name_twice(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('name,"price, usd",city\nInn,12,Rome\n')
    row = files.scan_drifting_csv(spark, str(path)).first()
    assert row.asDict() == {"name": "Inn", "price, usd": "12", "city": "Rome"}
    path.write_text("a,a\n1,2\n")
    with pytest.raises(ValueError):
        files.header_of(spark, str(path))


def test_files_left_out_are_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("")
    skipped = []
    assert files.scan_drifting_csv(spark, f"{tmp_path}/*.csv", skipped=skipped).count() == 1
    assert [s.rpartition("/")[2] for s in skipped] == ["b.csv"]
