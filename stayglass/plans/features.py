"""Engineered model features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.functions import buckets, dates, text
from stayglass.operators import rows
from stayglass.operators.columns import features_by_missing_rate, quoted

BINNED = [
    ("Distance from attraction", "distance_category", fv.DISTANCE_BINS),
    ("booking_lead_time", "lead_time_category", fv.LEAD_BINS),
    ("length_of_stay", "stay_category", fv.STAY_BINS),
    ("events_total_score", "event_intensity", fv.EVENT_BINS),
    ("MEAN_TEMPERATURE", "temp_category", fv.TEMPERATURE_BINS),
]


def engineer_features(df: DataFrame, price: str = "price_cad", checkin: str = "Check-in Date",
                      top_districts: int = 5) -> DataFrame:
    """Rows with a price, plus log price, buckets, calendar parts and interactions."""
    df = rows.complete_cases(df, [price])
    new = {f"log_{price}": buckets.log_target(F.col(quoted(price)))}
    for source, name, (edges, labels) in BINNED:
        if source in df.columns:
            new[name] = buckets.bucket_right_closed(F.col(quoted(source)), edges, labels)
    if checkin in df.columns:
        parts = dates.calendar_parts(F.to_date(F.col(quoted(checkin))))
        new.update({k: v for k, v in parts.items() if k != "week_of_year"})
    if {"is_weekend", "is_holiday"} <= set(df.columns):
        new["weekend_holiday"] = text.interaction(
            text.python_bool(F.col("is_weekend")), text.python_bool(F.col("is_holiday"))
        )
    df = df.withColumns(new)
    if {"district", "room_category"} <= set(df.columns):
        df = rows.collapse_to_top(df, "district", top_districts, "district_simple")
        df = df.withColumn(
            "district_room_combo", text.interaction(F.col("district_simple"), F.col("room_category"))
        )
    return df


def model_table(df: DataFrame, wanted: Sequence[str] = fv.MODEL_FEATURES, price: str = "price_cad",
                keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Complete cases over the features that are rarely missing, with both targets."""
    features = features_by_missing_rate(df, wanted)
    target = f"log_{price}"
    chosen = df.select(*[quoted(c) for c in [*keep, *features, target, price]])
    return rows.complete_cases(chosen, [*features, target]), features
