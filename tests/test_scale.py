"""Joins whose work follows the distinct sides, not the pairs: right rows, and few of them on the way."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stayglass.catalog import join_queries as q
from stayglass.operators import joins as j

DAY0 = dt.datetime(2024, 5, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Orders and line items with hot days, doubled rows and nulls."""
    draw, path = random.Random(5), str(tmp_path_factory.mktemp("tables"))
    orders, lines = [], []
    for i in range(400):
        day = DAY0 + dt.timedelta(days=draw.randint(0, 40) if i % 2 else 20)
        orders.append((None if i % 41 == 3 else i % 390, None if i % 37 == 5 else draw.randint(1, 60), "F", 100.0 + i, None if i % 53 == 7 else day, "1-URGENT"))
    for i in range(900):
        day = DAY0 + dt.timedelta(days=draw.randint(0, 42) if i % 3 else 21)
        lines.append((i % 850, draw.randint(1, 30), None if i % 61 == 4 else draw.randint(1, 20), i % 4, None if i % 29 == 2 else float(draw.randint(1, 50)),
                      None if i % 31 == 6 else "ANR"[i % 3], None if i % 47 == 9 else day))
    lines += lines[:40]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_interval_join_meets_reduced_sides(spark, folder, monkeypatch):
    from stayglass.sources import tables as t

    stays, events = t.stays(spark, folder), t.city_events(spark, folder)
    during = (events["day"] >= stays["checkin"]) & (events["day"] < stays["checkout"])
    plain = stays.join(events, during).groupBy("checkin", F.datediff("day", "checkin").cast("bigint").alias("d"), "segment").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("event_id"), F.round(F.sum("score"), 2))
    met, real = [], j.interval_join
    monkeypatch.setattr(j, "interval_join", lambda left, right, *more: met.append((left.count(), right.count())) or real(left, right, *more))
    got = q.interval_join(spark, folder)
    assert rows(got) == rows(plain) and got.agg(F.sum("pairs")).first()[0] > 3000
    assert met[0][0] <= stays.select("checkin", "checkout").distinct().count() < 300
    assert met[0][1] <= events.select("day", "segment").distinct().count() < 300


@pytest.mark.parametrize(("days", "events_per_task", "pairs_per_task", "matrix"), [(16, 10**6, 10**9, 10**6), (4, 40, 500, 30), (1, 7, 50, 1), (2, 10**6, 10**9, 10**6)])
def test_distances_of_a_spell_are_reduced_where_they_are_made(spark, monkeypatch, days, events_per_task, pairs_per_task, matrix):
    """Long and short ranges, hot days, points near and far; two rows a spell, unless a chunk's events go over several tasks."""
    from stayglass.operators import spell_distances as sd

    monkeypatch.setattr(sd, "MATRIX", matrix)
    draw = random.Random(days)
    spells, points = [], {}
    for i in range(150):
        first = DAY0.date() + dt.timedelta(days=draw.randint(-5, 60) if i % 3 else 20)
        last = dt.date(9999, 12, 31) if i == 7 else first + dt.timedelta(days=draw.choice([1, 1, 2, 3, 5, 17, 40]))
        spells.append((i, first, last, 43.6 + draw.randint(0, 4) / 100, -79.4 + draw.randint(0, 2) / 100))
    for i in range(400):
        day = DAY0.date() + dt.timedelta(days=draw.randint(0, 55) if i % 3 else 21)
        at = (day, 43.6 + draw.randint(0, 9) / 100, -79.5 + draw.randint(0, 9) / 100) if i % 50 else (day, float("nan"), 10.0 + i)
        points[at] = (*at, draw.randint(1, 5), draw.choice([None, 1.0, 2.5, 7.25]), draw.random() < 0.1)
    s = spark.createDataFrame(spells, "_spell long, a date, b date, lat double, lon double")
    e = spark.createDataFrame(list(points.values()), "_event_day date, _event_lat double, _event_lon double, _n long, _sum double, _is_major boolean")
    got = sd.spell_distances(s, e, ["a", "b", "lat", "lon"], days, events_per_task, pairs_per_task).cache()
    figures = got.groupBy("_spell").agg(
        F.min("_least"), F.max("_most"), F.sum("_total").cast("long"), F.sum("_events"), F.percentile("_h", F.lit(0.5), F.col("_n")),
        F.round(F.sum("_weight"), 6), F.min("_major"))
    pairs = s.crossJoin(F.broadcast(e)).where("_event_day >= a AND _event_day < b").withColumn(
        "h", F.floor(j.rounded_km(F.col("lat"), F.col("lon"), F.col("_event_lat"), F.col("_event_lon")) * 100 + 0.5))
    plain = pairs.groupBy("_spell").agg(
        F.min("h"), F.max("h"), F.sum(F.col("h") * F.col("_n")), F.sum("_n"), F.percentile("h", F.lit(0.5), F.col("_n")),
        F.round(F.coalesce(F.sum(F.col("_sum") / (F.col("h") / 100 + 0.1)), F.lit(0.0)), 6), F.min(F.when(F.col("_is_major"), F.col("h"))))
    assert rows(figures) == rows(plain)
    if events_per_task > 400:
        assert got.count() == 2 * figures.count()  # not one per pair


def test_spatial_features_exchange_no_pairs(spark):
    """400 ranges of one day meet 400 event points: 160,000 pairs, of which the exchange by spell sees two rows each at most."""
    from stayglass.operators import stay_features as sf

    stays = spark.range(400).selectExpr("43.6 + id / 1000 as lat", "-79.4D as lon", "date'2024-05-01' as checkin", "date'2024-05-02' as checkout")
    events = spark.range(400).selectExpr("cast(id as double) as score", "'A' as segment", "43.7 + id / 1000 as event_lat", "-79.5D as event_lon", "date'2024-05-01' as day")
    out = sf.distance_features(stays, events)
    assert out.count() == 400
    plan = sf.distance_features(stays, events)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "explode(_day)" not in plan


@pytest.mark.parametrize(("days", "places", "per_task"), [(4, 3, 10), (4, 3, 10**6), (60, 40, 10**6)])
def test_point_pairs_come_once(spark, monkeypatch, days, places, per_task):
    """Dense points meet in a grid, scattered ones by day; either way no pair of a range and an event is made."""
    draw = random.Random(days)
    day = lambda: DAY0.date() + dt.timedelta(days=draw.randint(0, days))
    stays = [(a := day(), a + dt.timedelta(days=draw.randint(-1, 3)), None if i % 19 == 2 else float(draw.randint(0, places)), 1.0) for i in range(120)]
    events = [(None if i % 23 == 4 else day(), float(draw.randint(0, places)), float(draw.randint(0, places))) for i in range(150)]
    s = spark.createDataFrame(stays, "ci date, co date, lat double, lon double")
    e = spark.createDataFrame(events, "day date, event_lat double, event_lon double")
    met, real = [], j.interval_join
    monkeypatch.setattr(j, "interval_join", lambda left, *more: met.append(1) or real(left, *more))
    got = j.day_pairs(s, e, "ci", "co", "lat", "lon", "day", "event_lat", "event_lon", per_task)
    plain = {(x[2], x[3], y[1], y[2]) for x in stays for y in events if x[2] is not None and y[0] and x[0] <= y[0] < x[1]}
    assert rows(got) == sorted(plain, key=str)
    assert bool(met) == (days == 60)


def test_pair_distances_are_counted_by_hotel_point_and_day(spark, folder):
    from stayglass.sources import tables as t

    s = t.stays(spark, folder).select("checkin", "checkout", "lat", "lon").na.drop().distinct()
    e = t.city_events(spark, folder).select("day", "event_lat", "event_lon").na.drop().distinct()
    km = j.rounded_km(F.col("lat"), F.col("lon"), F.col("event_lat"), F.col("event_lon"))
    pairs = s.join(e, (e["day"] >= s["checkin"]) & (e["day"] < s["checkout"])).withColumn("km", km)
    far = F.when(F.col("km") > 5, F.col("km"))
    plain = pairs.groupBy("checkin", "checkout", "lat", "lon").agg(F.count(F.lit(1)), F.count(far), F.min(far))
    out = q.join_pair_distance(spark, folder)
    assert rows(out) == rows(plain) and out.where("with_distance BETWEEN 1 AND pairs - 1").count() > 20
    nearest = pairs.groupBy("lat", "lon").agg(F.count_distinct("event_lat", "event_lon"), F.min("km"), F.max("km"))
    assert rows(q.distance_pairs(spark, folder).drop("mean_km")) == rows(nearest)
