"""Unified listings to a model-ready table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.functions import dates, geo, rules, text
from stayglass.operators import columns as cols
from stayglass.operators import rows
from stayglass.operators.columns import quoted
from stayglass.operators.joins import calendar_flag

HOTEL, CHECKIN, CHECKOUT, SNAPSHOT = "Hotel name", "Check-in Date", "Check-out Date", "Date"
ROOM, GUESTS, DISTANCE = "Room Type", "Number of People", "Distance from attraction"


def convert_prices(df: DataFrame) -> DataFrame:
    """Canonical ``price_usd``, parsed when it is text, and ``price_cad``."""
    df = cols.canonical_name(df, fv.PRICE_NAMES, "price_usd")
    if "price_usd" not in df.columns:
        return df
    price = F.col("price_usd")
    if dict(df.dtypes)["price_usd"] == "string":
        df = df.withColumn("price_usd", text.parse_price_strict(price))
    return df.withColumns({
        "price_cad": text.convert_currency(F.col("price_usd")),
        "price_usd": F.round("price_usd", 2),
    })


def clean(df: DataFrame) -> DataFrame:
    """Types, anomalies, price range, length of stay, trimmed text."""
    df = cols.keep_best_covered(df, ["distance", "attraction"], DISTANCE)
    if dict(df.dtypes).get(DISTANCE) == "string":
        df = df.withColumn(DISTANCE, text.parse_first_number(F.col(quoted(DISTANCE))))
    df = cols.coerce(df, fv.COLUMN_TYPES)
    df = rows.fill(df, {GUESTS: fv.DEFAULT_GUESTS})
    if HOTEL in df.columns:
        df = rows.without_denied(df, HOTEL)
    if "price_usd" in df.columns:
        df = rows.within_or_null(df, "price_usd", *fv.PRICE_RANGE_USD)
    if {CHECKIN, CHECKOUT} <= set(df.columns) and "length_of_stay" not in df.columns:
        df = df.withColumn(
            "length_of_stay", dates.stay_nights(F.col(quoted(CHECKIN)), F.col(quoted(CHECKOUT)))
        )
    return cols.trim_strings(df)


def add_weather_defaults(df: DataFrame) -> DataFrame:
    df = cols.drop_suffixed(df, "_weather", fv.WEATHER_DEFAULTS)
    return cols.default_if_empty(df, fv.WEATHER_DEFAULTS)


def add_places(df: DataFrame, address: str = "Address", unknown_at_centre: bool = True) -> DataFrame:
    """District from address and name, its coordinates, and the nearest district for the rest.

    ``unknown_at_centre`` gives unmatched districts the city centre (and so the district nearest
    to it); otherwise they stay without coordinates.
    """
    df = df.withColumn("district", rules.classify_district(
        F.col(quoted(address)) if address in df.columns else None,
        F.col(quoted(HOTEL)) if HOTEL in df.columns else None,
        F.col("district") if "district" in df.columns else None,
    ))
    place = rules.tiered_lookup(F.col("district"), fv.DISTRICTS, fv.DEFAULT_DISTRICT)
    known = F.lit(True) if unknown_at_centre else F.col("_p.tier") < 4
    df = df.withColumn("_p", place).withColumns({
        "latitude": F.when(known, F.col("_p.lat")),
        "longitude": F.when(known, F.col("_p.lon")),
    }).drop("_p")
    if not unknown_at_centre:
        return df
    # a missing district always sits at the centre here, so its nearest district is one constant
    centres = [d for d in fv.DISTRICTS if d[0] != fv.DEFAULT_DISTRICT]
    _, lat, lon = next(d for d in fv.DISTRICTS if d[0] == fv.DEFAULT_DISTRICT)
    nearest = geo.nearest_point(F.lit(lat), F.lit(lon), centres)["name"]
    return df.withColumn("district", F.coalesce("district", nearest))


def add_derived(df: DataFrame) -> DataFrame:
    ci, co = F.col(quoted(CHECKIN)), F.col(quoted(CHECKOUT))
    new = {}
    if {CHECKIN, CHECKOUT} <= set(df.columns):
        new["is_weekend"] = dates.weekend_overlap(ci, co)
    if CHECKIN in df.columns:
        new["week_of_year"] = dates.calendar_parts(ci)["week_of_year"]
        if SNAPSHOT in df.columns:
            new["booking_lead_time"] = dates.lead_days(ci, F.col(quoted(SNAPSHOT)))
    if ROOM in df.columns:
        new["room_category"] = rules.classify_room(F.col(quoted(ROOM)))
    return df.withColumns(new) if new else df


def transform(df: DataFrame, holidays: DataFrame, holiday_day: str = "day", address: str = "Address",
              unknown_at_centre: bool = True, min_coverage: float = fv.MIN_COVERAGE) -> DataFrame:
    """All steps in order; ends with one coverage pass that drops empty and sparse columns."""
    df = clean(convert_prices(df))
    df = add_weather_defaults(df)
    if {CHECKIN, CHECKOUT} <= set(df.columns):
        df = calendar_flag(df, CHECKIN, CHECKOUT, holidays, holiday_day, "is_holiday")
    df = add_derived(add_places(df, address, unknown_at_centre))
    return cols.drop_sparse(df, min_coverage)


def quality_report(df: DataFrame) -> DataFrame:
    """Coverage of the key features of a transformed table."""
    key = [c for c in ("price_cad", "district", "latitude", "longitude", "is_holiday") if c in df.columns]
    return cols.coverage_report(df, key)
