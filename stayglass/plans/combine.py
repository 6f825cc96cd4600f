"""Daily listing snapshots to one deduplicated table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayglass import fixed_values as fv
from stayglass.operators.columns import quoted
from stayglass.operators.rows import keep_first
from stayglass.sources.files import normalise_na, scan_drifting_csv, write_table


def dedupe_snapshots(listings: DataFrame, order: list[Column], key: list[str] = fv.DEDUPE_KEY) -> DataFrame:
    return keep_first(listings, key, order)


def combine_snapshots(spark: SparkSession, pattern: str, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Scan, null out "no value" texts, keep the first copy of each listing.

    First means the lowest file name, then the lowest remaining column values. ``renames`` may map
    an old header (``name``) to a key column (``Hotel name``); by default old layouts without the
    key columns collapse, since missing keys compare equal.
    """
    raw = scan_drifting_csv(spark, pattern, provenance="_file")
    for old, new in (renames or {}).items():
        if old in raw.columns and new in raw.columns:
            raw = raw.withColumn(new, F.coalesce(F.col(quoted(new)), F.col(quoted(old)))).drop(old)
    return dedupe_snapshots(normalise_na(raw), [F.col("_file")]).drop("_file")


def run(spark: SparkSession, pattern: str, out: str) -> str:
    return write_table(combine_snapshots(spark, pattern), out)
