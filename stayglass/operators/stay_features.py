"""Event exposure per stay.

Many bookings share dates and hotel, and many events share day and venue. Both sides are
therefore reduced to distinct profiles before they meet:

* everything that depends on dates alone (scores, counts, days, main segment) is built per
  ``(check-in, check-out)`` from one row per ``(day, segment)``;
* distances are built per ``(check-in, check-out, hotel point)`` from one row per ``(day, event
  point)``.

Booking rows only take part in the last join, and a date or hotel holding a third of all bookings
is a single profile.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.functions.dates import days_within
from stayglass.operators.joins import day_bounds
from stayglass.operators.spell_distances import spell_distances
from stayglass.session import work_path

STAY = {"checkin": "checkin", "checkout": "checkout", "lat": "lat", "lon": "lon"}
EVENT = {"day": "day", "score": "score", "segment": "segment", "lat": "event_lat", "lon": "event_lon"}

BASIC_FEATURES = [
    "events_total_score", "events_max_score", "events_avg_score", "events_count",
    "events_earliest_day", "events_latest_day", "events_avg_day", "events_primary_segment",
    "events_span_days", "events_density", "has_major_event", "has_multiple_events",
]
SPATIAL_FEATURES = [
    "events_total_score", "events_max_score", "events_avg_score", "events_count",
    "min_distance_to_event", "max_distance_to_event", "avg_distance_to_events",
    "median_distance_to_events", "events_earliest_day", "events_latest_day", "events_avg_day",
    "events_primary_segment", "events_span_days", "events_density",
    "distance_weighted_event_score", "distance_to_closest_major_event", "has_nearby_event_1km",
    "has_nearby_event_5km", "has_major_event", "event_accessibility_score",
]


def flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("bigint")


def group_mode(df: DataFrame, by: list[str], column: str, name: str, missing: str = "Unknown") -> DataFrame:
    """Most frequent value per group, the smallest on ties; ``missing`` if a group has none."""
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.when(F.col(column).isNotNull(), F.struct(-F.col("_n"), F.col(column)))
    return counts.groupBy(*by).agg(F.coalesce(F.min_by(column, rank), F.lit(missing)).alias(name))


def date_features(stays: DataFrame, events: DataFrame, stay: Mapping[str, str] = STAY,
                  event: Mapping[str, str] = EVENT) -> DataFrame:
    """Basic event features per distinct (check-in, check-out) with an event in between."""
    ci, co = stay["checkin"], stay["checkout"]
    per_day = events.where(F.col(event["day"]).isNotNull()).groupBy(
        F.col(event["day"]).alias("_day"), F.col(event["segment"]).alias("_segment")
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(event["score"]).alias("_scored"),
        F.sum(event["score"]).alias("_sum"),
        F.max(event["score"]).alias("_max"),
    )
    ranges = (
        stays.select(ci, co).distinct()
        .withColumn("_bounds", day_bounds(events, event["day"]))
        .withColumn("_day", F.explode(days_within(F.col(ci), F.col(co), F.col("_bounds"))))
        .drop("_bounds")
    )
    offset = F.datediff("_day", ci).cast("bigint")
    per_segment = ranges.join(per_day, "_day").groupBy(ci, co, "_segment").agg(
        F.sum("_n").alias("_n"),
        F.sum("_scored").alias("_scored"),
        F.sum("_sum").alias("_sum"),
        F.max("_max").alias("_max"),
        F.min(offset).alias("_first"),
        F.max(offset).alias("_last"),
        F.sum(offset * F.col("_n")).alias("_days"),
    )
    segment_rank = F.when(F.col("_segment").isNotNull(), F.struct(-F.col("_n"), F.col("_segment")))
    totals = per_segment.groupBy(ci, co).agg(
        F.coalesce(F.sum("_sum"), F.lit(0.0)).alias("_sum"),
        F.sum("_scored").alias("events_count"),
        F.max("_max").alias("_max"),
        F.min("_first").alias("events_earliest_day"),
        F.max("_last").alias("events_latest_day"),
        (F.sum("_days") / F.sum("_n")).alias("_avg_day"),
        F.coalesce(F.min_by("_segment", segment_rank), F.lit("Unknown")).alias("events_primary_segment"),
    )
    span = F.col("events_latest_day") - F.col("events_earliest_day")
    # two decimals first; everything below is derived from the rounded figures
    return totals.select(
        ci, co,
        F.round("_sum", 2).alias("events_total_score"),
        F.round("_max", 2).alias("events_max_score"),
        F.round(F.try_divide(F.col("_sum"), F.col("events_count")), 2).alias("events_avg_score"),
        "events_count", "events_earliest_day", "events_latest_day",
        F.round("_avg_day", 2).alias("events_avg_day"),
        "events_primary_segment",
        span.alias("events_span_days"),
        (F.col("events_count") / (span + 1)).alias("events_density"),
        flag(F.round("_max", 2) >= fv.MAJOR_EVENT_SCORE).alias("has_major_event"),
        flag(F.col("events_count") >= 2).alias("has_multiple_events"),
    )


def distance_features(stays: DataFrame, events: DataFrame, stay: Mapping[str, str] = STAY,
                      event: Mapping[str, str] = EVENT) -> DataFrame:
    """Distance features per distinct (check-in, check-out, hotel point)."""
    spell = [stay["checkin"], stay["checkout"], stay["lat"], stay["lon"]]
    spells = numbered(stays.select(*spell).na.drop().where(F.col(spell[1]) > F.col(spell[0])).distinct(), "_spell")
    points = located(events, event).groupBy(
        F.col(event["day"]).alias("_event_day"),
        F.col(event["lat"]).alias("_event_lat"),
        F.col(event["lon"]).alias("_event_lon"),
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(event["score"]).alias("_sum"),
        F.coalesce(F.max(event["score"]) >= fv.MAJOR_EVENT_SCORE, F.lit(False)).alias("_is_major"),
    )
    # One row or two per spell: the figures come with the two middle distances, whose median is that of all.
    # Only a spell whose events are dealt over several tasks has a row per distance and task.
    facts = spell_distances(spells, points, spell).groupBy("_spell").agg(
        (F.min("_least") / 100).alias("min_distance_to_event"),
        (F.max("_most") / 100).alias("max_distance_to_event"),
        (F.sum("_total") / (F.sum("_events") * F.lit(100.0))).alias("_avg"),
        # half the sum of two whole hundredths, so the median rounds the same way everywhere
        (F.percentile("_h", F.lit(0.5), F.col("_n")) / 100).alias("_median"),
        F.coalesce(F.sum("_weight"), F.lit(0.0)).alias("_weighted"),
        (F.min("_major") / 100).alias("distance_to_closest_major_event"),
    ).join(spells, "_spell")
    nearby = F.col("min_distance_to_event")
    weighted = F.round("_weighted", 2)
    return facts.select(
        *spell,
        "min_distance_to_event", "max_distance_to_event",
        F.round("_avg", 2).alias("avg_distance_to_events"),
        F.round("_median", 2).alias("median_distance_to_events"),
        weighted.alias("distance_weighted_event_score"),
        "distance_to_closest_major_event",
        flag(nearby <= 1.0).alias("has_nearby_event_1km"),
        flag(nearby <= 5.0).alias("has_nearby_event_5km"),
        F.round(weighted * flag(nearby <= 5.0), 2).alias("event_accessibility_score"),
    )


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows with a number each. They are written once, so that every reader sees the same numbers."""
    path = work_path(df.sparkSession, "numbered")
    df.withColumn(name, F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def located(events: DataFrame, event: Mapping[str, str] = EVENT) -> DataFrame:
    return events.where(
        F.col(event["day"]).isNotNull() & F.col(event["lat"]).isNotNull() & F.col(event["lon"]).isNotNull()
    )


def spatial_features(stays: DataFrame, events: DataFrame, stay: Mapping[str, str] = STAY,
                     event: Mapping[str, str] = EVENT) -> DataFrame:
    """All spatial event features per distinct (check-in, check-out, hotel point)."""
    dates = date_features(
        stays.where(F.col(stay["lat"]).isNotNull() & F.col(stay["lon"]).isNotNull()),
        located(events, event), stay, event,
    )
    spell = [stay["checkin"], stay["checkout"], stay["lat"], stay["lon"]]
    return distance_features(stays, events, stay, event).join(dates, spell[:2]).select(
        *spell, *SPATIAL_FEATURES
    )


def enrich_stays(stays: DataFrame, features: DataFrame, on: list[str],
                 no_major_as_zero: bool = False) -> DataFrame:
    """Left join of the features; stays without events get 0 and the segment ``None``.

    A missing "closest major event" stays null unless ``no_major_as_zero``, since 0 km would say
    the opposite.
    """
    added = [c for c in features.columns if c not in on]
    zero = [
        c for c in added
        if c != "events_primary_segment"
        and (no_major_as_zero or c != "distance_to_closest_major_event")
    ]
    return (
        stays.join(features, on, "left")
        .na.fill(0, subset=zero)
        .na.fill("None", subset=[c for c in added if c == "events_primary_segment"])
    )


def spatial_summary(features: DataFrame) -> DataFrame:
    """One row: distance range, shares of stays near events, scores."""
    def share(column: str) -> Column:
        return F.round(F.try_divide(F.sum(column) * 100.0, F.count(F.lit(1))), 4)

    return features.agg(
        F.count(F.lit(1)).alias("stays"),
        F.round(F.avg("avg_distance_to_events"), 4).alias("avg_distance"),
        F.min("min_distance_to_event").alias("closest"),
        F.max("max_distance_to_event").alias("furthest"),
        F.sum("has_nearby_event_1km").alias("near_1km"),
        share("has_nearby_event_1km").alias("near_1km_pct"),
        F.sum("has_nearby_event_5km").alias("near_5km"),
        share("has_nearby_event_5km").alias("near_5km_pct"),
        F.sum("has_major_event").alias("with_major"),
        share("has_major_event").alias("with_major_pct"),
        F.round(F.avg("distance_weighted_event_score"), 4).alias("avg_weighted_score"),
        F.max("event_accessibility_score").alias("max_accessibility"),
    )
