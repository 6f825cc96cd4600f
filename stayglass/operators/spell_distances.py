"""Distances between the hotel point of a date range and the event points of its days, reduced where they are made.

A range meets thousands of event points, and neighbouring ranges meet the same ones. So a task takes all ranges that start
within a few days, with the events of those days and of the nights beyond: it sorts the distances of a hotel point once,
and reduces every range by one running sum in that order. Pairs are never written or exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.operators.joins import MOST_TASKS, day_bounds
from stayglass.session import work_path

FIGURES = "_spell bigint, _h bigint, _n bigint, _least bigint, _most bigint, _total double, _events bigint, _weight double, _major bigint"
CELL = ["_long", "_chunk", "_row", "_column"]

DAYS = 16  # most days in which the ranges of a task start, unless a single one is longer
EVENTS_PER_TASK = 1_000_000
PAIRS_PER_TASK = 2_000_000_000
MATRIX = 2_000_000  # distances that a task holds at a time


def spell_distances(spells: DataFrame, points: DataFrame, spell: Sequence[str], days: int = DAYS,
                    events_per_task: int = EVENTS_PER_TASK, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Partial figures per ``_spell``, to be added up; distances are whole hundredths of a kilometre.

    ``spells``: _spell and the columns ``spell`` (start, end, latitude, longitude). ``points``: _event_day, _event_lat,
    _event_lon, each once, with _n, _sum and _is_major. Ranges longer than ``days`` get a chunk of their own length, a
    power of two, so an event is in two chunks per length at most. A chunk of many events deals them over ``_column``
    tasks by a hash of the point, one of many pairs deals its ranges over ``_row`` tasks.
    """
    spark = spells.sparkSession
    start, end, lat, lon = (F.col(c) for c in spell)
    ranges = (
        spells.withColumn("_bounds", day_bounds(points, "_event_day"))
        .select(
            "_spell",
            F.unix_date(F.greatest(start, F.col("_bounds.lo"))).alias("_first"),
            F.unix_date(F.least(end, F.date_add("_bounds.hi", 1))).alias("_end"),
            lat.alias("_lat"), lon.alias("_lon"),
        ).where("_end > _first")
    )
    per_day = points.groupBy(F.unix_date("_event_day").alias("_day")).agg(F.count(F.lit(1)).alias("_r"))
    path = work_path(spark, "points-per-day")
    per_day.write.parquet(path)
    per_day = spark.read.parquet(path)
    fullest = per_day.agg(F.max("_r")).first()[0] or 1
    while days > 1 and days * fullest > events_per_task:
        days //= 2
    # lengths are powers of two from ``days`` up
    power = F.ceil(F.log2((F.col("_end") - F.col("_first")).cast("double"))).cast("int")
    ranges = ranges.withColumn("_power", power).withColumn("_long", F.greatest(F.lit(days), F.expr("shiftleft(1, _power)")))
    ranges = ranges.withColumn("_chunk", F.expr("cast(floor(_first / _long) as int)"))
    # one row per length and chunk, written once: which days it needs, and over how many tasks it goes
    met = ranges.groupBy("_long", "_chunk").agg(
        F.min("_first").alias("_from"), F.max("_end").alias("_to"), F.count(F.lit(1)).alias("_l")
    )
    sized = met.withColumn("_day", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1))).join(per_day, "_day")
    sized = sized.groupBy("_long", "_chunk", "_from", "_to", "_l").agg(F.sum("_r").alias("_r"))
    down = F.ceil(F.col("_r") / F.lit(events_per_task))
    across = F.least(F.col("_l"), F.ceil(F.col("_l") * F.col("_r").cast("double") / down / F.lit(pairs_per_task)))
    path = work_path(spark, "chunks")
    sized.select(
        "_long", "_chunk", "_from", "_to", across.cast("int").alias("_a"), down.cast("int").alias("_b"),
        (F.col("_l") * F.col("_r").cast("double")).alias("_pairs"),
    ).write.parquet(path)
    sized = spark.read.parquet(path)
    lengths = [r[0] for r in sized.select("_long").distinct().orderBy("_long").collect()]  # 32 at most
    cells, pairs = sized.agg(F.sum(F.col("_a") * F.col("_b")), F.sum("_pairs")).first()
    tasks = int(min(MOST_TASKS, cells or 1, 1 + (pairs or 0) * 16 // pairs_per_task))
    sized = F.broadcast(sized.drop("_pairs"))

    def parts(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = ranges.join(sized.select("_long", "_chunk", "_a", "_b"), ["_long", "_chunk"]).select(
        "_long", "_chunk", F.pmod(F.xxhash64("_spell"), F.col("_a")).cast("int").alias("_row"), parts("_b").alias("_column"),
        (F.col("_b") == 1).alias("_whole"), "_spell", "_first", "_end", "_lat", "_lon",
    )
    day = F.unix_date("_event_day")
    places = F.array(*[
        F.struct(F.lit(n).alias("_long"), F.expr(f"cast(floor(_day / {n}) as int) - {back}").alias("_chunk"))
        for n in lengths for back in (0, 1)
    ]) if lengths else F.expr("cast(array() as array<struct<_long:int,_chunk:int>>)")
    right = points.withColumn("_day", day).select("*", F.inline(places)).join(sized, ["_long", "_chunk"]).where(
        "_day >= _from AND _day < _to"
    ).withColumn("_column", F.pmod(F.xxhash64("_event_lat", "_event_lon"), F.col("_b")).cast("int")).select(
        "_long", "_chunk", parts("_a").alias("_row"), "_column", "_day", "_event_lat", "_event_lon",
        "_n", "_sum", "_is_major",
    )
    left, right = left.repartition(tasks, *CELL), right.repartition(tasks, *CELL)
    return left.groupBy(*CELL).cogroup(right.groupBy(*CELL)).applyInArrow(_reduce, FIGURES)


def _hundredths(lat: np.ndarray, lon: np.ndarray, event_lat: np.ndarray, event_lon: np.ndarray) -> np.ndarray:
    """Hotel points by event points; as ``geo.haversine_km``, rounded half up."""
    with np.errstate(invalid="ignore"):
        a, b = np.radians(lat)[:, None], np.radians(event_lat)[None, :]
        half_lat, half_lon = np.sin((b - a) / 2), np.sin((np.radians(event_lon)[None, :] - np.radians(lon)[:, None]) / 2)
        angle = np.arcsin(np.sqrt(half_lat * half_lat + np.cos(a) * np.cos(b) * half_lon * half_lon))
    angle[np.isnan(angle)] = np.pi / 2
    return np.floor(2 * fv.EARTH_KM * angle * 100 + 0.5)


def _distinct(lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct points and the number of each row's point."""
    points, at = np.unique(np.column_stack([lat, lon]) + 0.0, axis=0, return_inverse=True)
    return points[:, 0], points[:, 1], at.reshape(-1)


def _figures(h: np.ndarray, order: np.ndarray, share: np.ndarray, n: np.ndarray, score: np.ndarray, major: np.ndarray, whole: bool) -> list:
    """Columns of ``FIGURES`` for hotel points by event points, with the row of ``h`` in place of the spell.

    ``order`` sorts the rows of ``h``, ``share`` is what an event's score counts at that distance.
    """
    hotels, points = order.shape
    total = int(n.sum())
    running = np.cumsum(n[order].ravel())
    base = np.arange(hotels) * total

    def at(k: int) -> np.ndarray:
        """The k-th smallest distance of each hotel point, from 1."""
        place = np.searchsorted(running, base + k, "left")
        return h[np.arange(hotels), order.ravel()[place]]

    least, most = at(1), at(total)
    sums = h @ n.astype(np.float64)
    weight = share @ score
    nearest = h[:, major].min(axis=1, initial=np.inf)
    row = np.arange(hotels)
    if whole:
        low, high = at((total + 1) // 2), at(total // 2 + 1)
        rows, values, counts = np.r_[row, row], np.r_[low, high], np.ones(2 * hotels, np.int64)
    else:
        key, back = np.unique((row[:, None] * 3_000_000 + h[:, n > 0].astype(np.int64)).ravel(), return_inverse=True)
        counts = np.bincount(back.reshape(-1), np.broadcast_to(n[n > 0], (hotels, int((n > 0).sum()))).ravel()).astype(np.int64)
        rows, values = key // 3_000_000, key % 3_000_000
    first = np.r_[True, rows[1:] != rows[:-1]] if not whole else np.arange(2 * hotels) < hotels
    columns = [least, most, sums, np.full(hotels, total), weight, nearest]
    return [rows, values, counts, *[np.where(first, c[rows], np.nan) for c in columns]]


def _table(spells: list[np.ndarray], figures: list[list]) -> pa.Table:
    names = [c.split()[0] for c in FIGURES.split(", ")]
    kinds = [pa.float64() if c.endswith("double") else pa.int64() for c in FIGURES.split(", ")]
    if not figures:
        return pa.table({n: pa.array([], k) for n, k in zip(names, kinds)})
    columns = [np.concatenate([s[f[0]] for s, f in zip(spells, figures)])] + [np.concatenate([f[i] for f in figures]) for i in range(1, 9)]
    out = {}
    for i, (name, kind, c) in enumerate(zip(names, kinds, columns)):
        if i < 3:
            out[name] = pa.array(c.astype(np.int64), kind)
        elif name == "_weight":
            # a sum without a number is told from an absent one by the count beside it
            out[name] = pa.array(c, kind, mask=np.isnan(columns[6]))
        else:
            empty = ~np.isfinite(c)
            out[name] = pa.array(np.where(empty, 0, c).astype(np.float64 if kind == pa.float64() else np.int64), kind, mask=empty)
    return pa.table(out)


def _reduce(left: pa.Table, right: pa.Table) -> pa.Table:
    """All ranges of a cell against all its events."""
    if not left.num_rows or not right.num_rows:
        return _table([], [])
    ids, first, end, whole = (left.column(c).to_numpy() for c in ("_spell", "_first", "_end", "_whole"))
    h_lat, h_lon, hotel = _distinct(left.column("_lat").to_numpy(), left.column("_lon").to_numpy())
    by_day = np.argsort(right.column("_day").to_numpy(), kind="stable")
    day, n, major = (right.column(c).to_numpy()[by_day] for c in ("_day", "_n", "_is_major"))
    score = right.column("_sum").fill_null(0.0).to_numpy()[by_day]
    e_lat, e_lon, point = _distinct(right.column("_event_lat").to_numpy()[by_day], right.column("_event_lon").to_numpy()[by_day])
    spells, figures = [], []
    # the ranges in order of their dates, then of their hotel point
    order = np.lexsort((hotel, end, first))
    cuts = np.flatnonzero(np.r_[True, (np.diff(first[order]) != 0) | (np.diff(end[order]) != 0)])
    groups = []
    for one in np.split(order, cuts[1:]):
        a, b = np.searchsorted(day, (first[one[0]], end[one[0]]))
        if b > a:
            groups.append((one, a, b))
    shared = [g for g in groups if (g[2] - g[1]) * 8 >= len(e_lat)]
    for one, a, b in groups:
        if (b - a) * 8 < len(e_lat):  # few of the cell's points: those alone
            some, at = np.unique(point[a:b], return_inverse=True)
            for part in _slices(one, len(some)):
                h = _hundredths(h_lat[hotel[part]], h_lon[hotel[part]], e_lat[some], e_lon[some])
                spells.append(ids[part])
                figures.append(_figures(h, np.argsort(h, axis=1), _share(h), *_sums(at.reshape(-1), len(some), n[a:b], score[a:b], major[a:b]), whole[0]))
    for hotels in _slices(np.arange(len(h_lat)), len(e_lat)) if shared else ():
        h = _hundredths(h_lat[hotels], h_lon[hotels], e_lat, e_lon)
        sorted_, share = np.argsort(h, axis=1), _share(h)
        for one, a, b in shared:
            part = one[(hotel[one] >= hotels[0]) & (hotel[one] <= hotels[-1])]
            if len(part):
                mine = hotel[part] - hotels[0]
                mine = slice(None) if np.array_equal(mine, np.arange(len(hotels))) else mine
                spells.append(ids[part])
                figures.append(_figures(h[mine], sorted_[mine], share[mine], *_sums(point[a:b], len(e_lat), n[a:b], score[a:b], major[a:b]), whole[0]))
    return _table(spells, figures)


def _share(h: np.ndarray) -> np.ndarray:
    return 1.0 / (h / 100 + fv.WEIGHT_OFFSET_KM)


def _slices(rows: np.ndarray, width: int) -> Iterator[np.ndarray]:
    size = max(1, MATRIX // width)
    return (rows[i : i + size] for i in range(0, len(rows), size))


def _sums(point: np.ndarray, points: int, n: np.ndarray, score: np.ndarray, major: np.ndarray):
    """Events, score and whether a major one is among them, for each point of a range."""
    return np.bincount(point, n, points).astype(np.int64), np.bincount(point, score, points), np.bincount(point, major, points) > 0
