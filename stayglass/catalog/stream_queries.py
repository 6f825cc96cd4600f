"""Streaming jobs run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayglass.catalog.registry import register
from stayglass.session import work_path
from stayglass.sources import tables as t
from stayglass.streaming import ingest


def _event_stream(spark, folder):
    schema = t.table(spark, folder, "events").schema
    return ingest.file_stream(spark, folder, schema, files="events.parquet")


@register("stream_ingest", "SELECT DISTINCT user_id, event_type FROM events")
def stream_ingest(spark, folder):
    # the delay spans the table, so a key is never forgotten
    kept = ingest.dedupe_stream(_event_stream(spark, folder), ["user_id", "event_type"], "ts", "90 days")
    out = ingest.run_available(kept, work_path(spark, "ingest"), work_path(spark, "ingest-state"))
    return spark.read.parquet(out).select("user_id", "event_type")


@register("stream_daily_counts", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1
HAVING CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_daily_counts(spark, folder):
    counts = ingest.daily_counts_stream(_event_stream(spark, folder), "ts", "1 hour")
    out = ingest.run_available(counts, work_path(spark, "daily"), work_path(spark, "daily-state"))
    return spark.read.parquet(out).select("day", F.col("n").cast("bigint").alias("n"))


@register("stream_daily_totals", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_totals(spark, folder):
    table = work_path(spark, "totals")
    ingest.maintain_daily_counts(_event_stream(spark, folder), "ts", table, work_path(spark, "totals-state"), ["event_type"])
    return ingest.daily_counts(spark, table).select("day", "event_type", "n")
