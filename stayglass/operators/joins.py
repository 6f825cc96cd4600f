"""Weather, interval, calendar and distance joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass.functions import geo
from stayglass.functions.dates import days_within
from stayglass.operators.columns import quoted
from stayglass.operators.profile import pearson
from stayglass.session import work_path

# pairs one task may produce for one day before the day is split further
PAIRS_PER_TASK = 4_000_000
MOST_TASKS = 100_000
POINT_PAIRS_PER_TASK = 500_000


def one_row_per_day(weather: DataFrame, day: str, measures: Sequence[str]) -> DataFrame:
    """Station mean per day."""
    return weather.where(F.col(day).isNotNull()).groupBy(day).agg(
        *[F.avg(m).alias(m) for m in measures]
    )


def join_weather(stays: DataFrame, weather: DataFrame, checkin: str, day: str,
                 measures: Sequence[str], fanout: bool = False) -> DataFrame:
    """Left join on the check-in date.

    By default the weather is first reduced to one row per day. ``fanout=True`` keeps one row per
    station, so a stay repeats once per station of its day.
    """
    if not fanout:
        # one row per calendar day, so the stays need no shuffle by check-in date
        weather = F.broadcast(one_row_per_day(weather, day, measures))
    clashing = {c: f"{c}_weather" for c in weather.columns if c in stays.columns and c != day}
    weather = weather.withColumnsRenamed({**clashing, day: "_weather_day"})
    return stays.join(weather, F.col(checkin) == F.col("_weather_day"), "left").drop("_weather_day")


def day_bounds(df: DataFrame, day: str) -> Column:
    """Scalar: first (lo) and last (hi) day of the rows."""
    return df.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()


def interval_join(left: DataFrame, right: DataFrame, start: str, end: str, day: str,
                  spread: Sequence[str], pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Rows of both sides with ``start <= day < end``, plus ``days_from_checkin``.

    ``start``, ``end`` and ``day`` are dates. Each left row is listed under the days it covers, so
    the match is an equi-join on the day. A day with more than ``pairs_per_task`` matches becomes
    a grid of ``a`` times ``b`` cells: a hash of the ``spread`` columns puts a left row in one of
    ``a`` rows of the grid, where it stands in all ``b`` cells; a hash of all its columns puts a
    right row in one of ``b`` columns, where it stands in all ``a`` cells. Both come from the
    counts of both sides, so the smaller side is copied more and neither has to fit in one task.
    """
    dated = right.where(F.col(day).isNotNull())
    by_day = (
        left.withColumn("_bounds", day_bounds(dated, day))
        .withColumn("_day", F.explode(days_within(F.col(start), F.col(end), F.col("_bounds"))))
        .drop("_bounds")
        .withColumn("days_from_checkin", F.datediff("_day", start).cast("bigint"))
    )
    # one row per calendar day, written once: it shapes the grid and tells how many tasks the pairs need
    sizes = by_day.groupBy("_day").agg(F.count(F.lit(1)).alias("_l")).join(
        dated.groupBy(F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("_r")), "_day"
    )
    path = work_path(left.sparkSession, "pairs-per-day")
    sizes.write.parquet(path)
    sizes = left.sparkSession.read.parquet(path)
    per_day = F.col("_l") * F.col("_r").cast("double")
    total = sizes.agg(F.sum(per_day)).first()[0] or 0
    # a date column bounds this to a few MB at the very worst
    hot = F.broadcast(sizes.where(per_day > pairs_per_task).select("_day", *grid(F.col("_l"), F.col("_r"), pairs_per_task)))
    a, b = (F.coalesce(F.col(c), F.lit(1).cast("bigint")) for c in ("_a", "_b"))
    zero = F.lit(0).cast("bigint")
    left_cut = by_day.join(hot, "_day", "left").withColumns({
        "_row": F.pmod(F.xxhash64(*spread), a), "_column": F.sequence(zero, b - 1),
    }).drop("_a", "_b").withColumn("_column", F.explode("_column"))
    right_cut = dated.withColumn("_day", F.col(day)).join(hot, "_day", "left").withColumns({
        "_row": F.sequence(zero, a - 1), "_column": F.pmod(F.xxhash64(*[quoted(c) for c in right.columns]), b),
    }).drop("_a", "_b").withColumn("_row", F.explode("_row"))
    # few rows make many pairs, so the number of tasks follows the pairs, not the size of the rows
    cell, tasks = ["_day", "_row", "_column"], int(min(MOST_TASKS, max(1, -(-2 * total // pairs_per_task))))
    return left_cut.repartition(tasks, *cell).join(right_cut.repartition(tasks, *cell), cell).drop(*cell)


def grid(left: Column, right: Column, pairs_per_task: int) -> list[Column]:
    """Rows ``_a`` and columns ``_b`` of the grid for two counts. Cells are planned for half of
    ``pairs_per_task``, since a hash fills them unevenly."""
    cells = F.ceil(left * right.cast("double") * 2 / F.lit(pairs_per_task))
    across = F.least(left, F.greatest(F.lit(1).cast("bigint"), F.ceil(F.sqrt(cells * left / right))))
    down = F.least(right, F.ceil(cells / across))
    # where the right side is too short for that, the left one is cut further
    return [F.least(left, F.greatest(across, F.ceil(cells / down))).alias("_a"), down.alias("_b")]


def calendar_flag(df: DataFrame, start: str, end: str, calendar: DataFrame, day: str,
                  name: str) -> DataFrame:
    """Does a calendar day fall in the closed range? Null or reversed ranges do not.

    Every date of the calendar's span is listed with the next calendar day from it on, so a row takes one lookup by its
    start. That table has one row per date: Spark broadcasts it if it is small and copes with hot starts if it isn't.
    """
    days = calendar.select(F.col(day).cast("date").alias("_next")).where("_next IS NOT NULL")
    days = days.agg(F.sort_array(F.collect_set("_next")).alias("_next")).where(F.size("_next") > 0)
    before = F.concat(F.array(F.date_sub(F.get("_next", F.lit(0)), 1)), F.slice("_next", 1, F.size("_next") - 1))
    gaps = days.withColumn("_before", before).select(F.inline(F.arrays_zip("_before", "_next")))
    ahead = gaps.select(F.explode(F.sequence(F.date_add("_before", 1), F.col("_next"))).alias("_day"), "_next")
    first = calendar.agg(F.min(F.col(day).cast("date"))).scalar()
    begin = F.col(start).cast("date")
    begin = F.when(F.col(start) > begin, F.date_add(begin, 1)).otherwise(begin)  # a time of day is past its date
    keyed = df.withColumn("_day", F.when(begin.isNotNull(), F.greatest(begin, first)))
    hit = F.coalesce(F.col("_next") <= F.col(end), F.lit(False))
    return keyed.join(ahead, "_day", "left").withColumn(name, hit).drop("_day", "_next")


def day_pairs(stays: DataFrame, events: DataFrame, checkin: str, checkout: str, lat: str, lon: str,
              day: str, event_lat: str, event_lon: str, pairs_per_task: int = POINT_PAIRS_PER_TASK) -> DataFrame:
    """Hotel points x event points that share a day, each pair once.

    Both sides become one row per point with its days, written once. Where points are few against the matches of their
    days, the points meet in a grid and the days are compared; otherwise they meet by day.
    """
    spark = stays.sparkSession
    spells = stays.select(checkin, checkout, lat, lon).na.drop().where(F.col(checkout) > F.col(checkin)).distinct()
    points = events.select(day, event_lat, event_lon).na.drop()
    listed = spells.withColumn("_bounds", day_bounds(points, day)).withColumn(
        "_day", F.explode(days_within(F.col(checkin), F.col(checkout), F.col("_bounds")))
    )
    left = _days_of(listed.select(lat, lon, "_day"), lat, lon, "_days")
    right = _days_of(points.select(event_lat, event_lon, F.col(day).alias("_day")), event_lat, event_lon, "_event_days")
    by_day = left.select(F.explode("_days").alias("_day")).groupBy("_day").agg(F.count(F.lit(1)).alias("_l")).join(
        right.select(F.explode("_event_days").alias("_day")).groupBy("_day").agg(F.count(F.lit(1)).alias("_r")), "_day"
    ).agg(F.sum(F.col("_l") * F.col("_r").cast("double"))).first()[0] or 0
    hotels, venues = left.count(), right.count()
    if by_day < hotels * venues:
        spread = left.select(lat, lon, F.explode("_days").alias("_from")).withColumn("_to", F.date_add("_from", 1))
        met = interval_join(spread, right.select(event_lat, event_lon, F.explode("_event_days").alias("_on")), "_from", "_to", "_on", [lat, lon, "_from"])
        return met.select(lat, lon, event_lat, event_lon).distinct()
    cells = max(1, -(-2 * hotels * venues // pairs_per_task))
    a = max(1, min(hotels, round((cells * hotels / max(1, venues)) ** 0.5)))
    b = max(1, min(venues, -(-cells // a)))
    row, column = F.pmod(F.xxhash64(lat, lon), F.lit(a)), F.pmod(F.xxhash64(event_lat, event_lon), F.lit(b))
    cell, tasks = ["_row", "_column"], int(min(MOST_TASKS, a * b))
    left = left.withColumns({"_row": row.cast("int"), "_column": F.explode(F.sequence(F.lit(0), F.lit(b - 1)))})
    right = right.withColumns({"_row": F.explode(F.sequence(F.lit(0), F.lit(a - 1))), "_column": column.cast("int")})
    met = left.repartition(tasks, *cell).join(right.repartition(tasks, *cell), cell)
    return met.where(F.arrays_overlap("_days", "_event_days")).select(lat, lon, event_lat, event_lon)


def _days_of(df: DataFrame, lat: str, lon: str, name: str) -> DataFrame:
    """One row per point with the set of its ``_day``, written once."""
    path = work_path(df.sparkSession, "days-of-points")
    df.groupBy(lat, lon).agg(F.collect_set("_day").alias(name)).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def distance_table(pairs: DataFrame, lat: str, lon: str, event_lat: str, event_lon: str) -> DataFrame:
    """Kilometres, two decimals, for each distinct pair of a hotel and an event point."""
    return pairs.select(lat, lon, event_lat, event_lon).distinct().withColumn(
        "distance_km", rounded_km(F.col(lat), F.col(lon), F.col(event_lat), F.col(event_lon))
    )


def join_pair_distance(pairs: DataFrame, distances: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach precomputed pair distances; pairs without one keep a null."""
    return pairs.join(distances, list(on), "left")


def rounded_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.round(geo.haversine_km(lat1, lon1, lat2, lon2), 2)


def infer_reference_point(df: DataFrame, lat: str, lon: str, distance: str,
                          points: Sequence[tuple[str, float, float]], min_rows: int = 10) -> DataFrame:
    """Per candidate point: correlation of its computed miles with the recorded distance.

    Columns ord, name, lat, lon, n, correlation. One pass with two aggregates per candidate. All
    rows count; the candidates are a short fixed list.
    """
    known = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(f"`{distance}`").isNotNull())
    facts = known.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            pearson(geo.haversine_miles(F.col(lat), F.col(lon), F.lit(p_lat), F.lit(p_lon)),
                    F.col(f"`{distance}`")).alias(f"r{i}")
            for i, (_, p_lat, p_lon) in enumerate(points)
        ],
    )
    rows = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("ord"), F.lit(name).alias("name"), F.lit(p_lat).alias("lat"),
                 F.lit(p_lon).alias("lon"), F.col("n"),
                 F.when(F.col("n") > min_rows, F.col(f"r{i}")).alias("correlation"))
        for i, (name, p_lat, p_lon) in enumerate(points)
    ])
    return facts.select(F.inline(rows))


def best_reference_point(candidates: DataFrame) -> tuple[str, float, float]:
    """The best correlated candidate, the first in list order as default. Reads a few rows."""
    best = candidates.orderBy(F.desc_nulls_last("correlation"), "ord").first()
    return best["name"], best["lat"], best["lon"]
