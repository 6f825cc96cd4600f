"""Stays with weather and event exposure: the flagship job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayglass.operators.joins import join_weather
from stayglass.operators.stay_features import EVENT, STAY, date_features, enrich_stays, spatial_features


def has_coordinates(stays: DataFrame, lat: str, lon: str) -> bool:
    """Does any stay carry coordinates? Stops at the first one found."""
    if lat not in stays.columns or lon not in stays.columns:
        return False
    return not stays.where(F.col(lat).isNotNull()).limit(1).isEmpty()


def unify(stays: DataFrame, events: DataFrame | None, weather: DataFrame | None, measures: Sequence[str],
          weather_day: str = "day", mode: str = "auto", weather_fanout: bool = False,
          stay: Mapping[str, str] = STAY, event: Mapping[str, str] = EVENT,
          no_major_as_zero: bool = False) -> DataFrame:
    """Left joins of weather and of event features onto the stays.

    ``mode``: ``spatial`` with distances, ``basic`` from dates alone, ``auto`` picks spatial when
    any stay has coordinates.
    """
    unified = stays
    if weather is not None:
        unified = join_weather(unified, weather, stay["checkin"], weather_day, measures, weather_fanout)
    if events is None:
        return unified
    if mode == "auto":
        mode = "spatial" if has_coordinates(stays, stay["lat"], stay["lon"]) else "basic"
    dates = [stay["checkin"], stay["checkout"]]
    if mode == "basic":
        return enrich_stays(unified, date_features(stays, events, stay, event), dates)
    features = spatial_features(stays, events, stay, event)
    return enrich_stays(unified, features, [*dates, stay["lat"], stay["lon"]], no_major_as_zero)
