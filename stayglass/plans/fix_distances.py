"""Missing distances filled from the reference point that explains the recorded ones best."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stayglass import fixed_values as fv
from stayglass.operators.joins import best_reference_point, infer_reference_point
from stayglass.operators.rows import fill_missing_distance, plausibility_report
from stayglass.sources.files import replace_table


def fix_distances(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                  distance: str = "Distance from attraction",
                  points: Sequence[tuple[str, float, float]] = fv.ATTRACTIONS) -> DataFrame:
    """Infers the point (one aggregate over the rows) and fills; recorded distances stay."""
    _, p_lat, p_lon = best_reference_point(infer_reference_point(df, lat, lon, distance, points))
    return fill_missing_distance(df, lat, lon, distance, (p_lat, p_lon))


def run(df: DataFrame, path: str, copy_to: str | None = None, distance: str = "Distance from attraction",
        bounds: tuple[float, float] = fv.PLAUSIBLE_MILES, **names: str) -> DataFrame:
    """Fix and replace the table at ``path``, which ``df`` may have been read from. The check of the distances written:
    how many there are, how many lie inside and outside of ``bounds``, the least and the most."""
    replace_table(fix_distances(df, distance=distance, **names), path, copy_to)
    return plausibility_report(df.sparkSession.read.parquet(path), distance, *bounds)
