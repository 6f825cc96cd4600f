"""Great-circle distances and nearest fixed point."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayglass import fixed_values as fv


def _chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    return half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon


def _half_turn(angle: Column) -> Column:
    # rounding may push the chord of antipodal points just above 1; null stays null
    return F.nanvl(angle, F.lit(math.pi / 2))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = _chord(lat1, lon1, lat2, lon2)
    return F.lit(2 * fv.EARTH_KM) * _half_turn(F.asin(F.sqrt(a)))


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = _chord(lat1, lon1, lat2, lon2)
    return F.lit(2 * fv.EARTH_MILES) * _half_turn(F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def point_list(points: Sequence[tuple[str, float, float]]) -> Column:
    """A fixed list of points as one array literal of (ord, name, lat, lon)."""
    return F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(name).alias("name"), F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))
        for i, (name, lat, lon) in enumerate(points)
    ])


def nearest_point(lat: Column, lon: Column, points: Sequence[tuple[str, float, float]]) -> Column:
    """Struct (km, ord, name) of the closest of a fixed list of points; earlier wins a tie.

    The list is a dimension of a few dozen literals, so the search is one row-local expression:
    no join, no shuffle.
    """
    near = F.transform(point_list(points), lambda p: F.struct(
        haversine_km(lat, lon, p["lat"], p["lon"]).alias("km"), p["ord"].alias("ord"), p["name"].alias("name")
    ))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.array_min(near))
