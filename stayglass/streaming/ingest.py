"""Incremental counterparts of the daily snapshot jobs.

A folder that receives one file per day is read as a stream; ``availableNow`` processes what has
arrived and stops, so the jobs can run on any schedule. Offsets and state live next to the output
under the given checkpoint path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayglass.operators.columns import quoted
from stayglass.sources import files


#: complete versions of a maintained table that stay: the newest, and one for readers that have begun
KEPT_VERSIONS = 2


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream, optionally a few at a time."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a timestamp; one without a zone is taken in the session's."""
    if isinstance(stream.schema[ts].dataType, T.TimestampType):
        return stream
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def dedupe_stream(stream: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arriving row per key; a key is remembered for ``delay`` of event time."""
    return event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def daily_counts_stream(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows per day, emitted once the watermark has passed the day."""
    return (
        event_time(stream, ts).withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date("w.start").alias("day"), "n")
    )


def run_available(stream: DataFrame, out: str, checkpoint: str) -> str:
    """Append everything available to a parquet table and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out


def _versions(spark: SparkSession, table: str) -> dict[int, str]:
    """Complete versions of a maintained table, by batch number."""
    done = files.list_files(spark, f"{table}/v*/_SUCCESS")
    folders = [path.rsplit("/", 1)[0] for path in done]
    return {int(folder.rsplit("/v", 1)[1]): folder for folder in folders}


def merge_daily_counts(batch: DataFrame, number: int, ts: str, table: str, by: Sequence[str] = ()) -> None:
    """Add a batch of rows to the counts per day (and ``by`` columns) under ``table``.

    The batch is counted first; its few days are added to the version before and written as version ``number``. A batch
    that runs again replaces what it wrote, so no row counts twice. A null time counts under a null day.
    """
    spark, keys = batch.sparkSession, ["day", *by]
    delta = batch.groupBy(F.to_date(F.col(quoted(ts))).alias("day"), *[F.col(quoted(c)) for c in by]).agg(F.count(F.lit(1)).alias("n"))
    before = {k: folder for k, folder in _versions(spark, table).items() if k < number}
    if before:
        delta = spark.read.parquet(before[max(before)]).unionByName(delta)
    total = delta.groupBy(*[quoted(c) for c in keys]).agg(F.sum("n").alias("n"))
    total.write.mode("overwrite").parquet(f"{table}/v{number}")
    for old in sorted(before)[: -(KEPT_VERSIONS - 1)]:
        files.remove(spark, before[old])


def maintain_daily_counts(stream: DataFrame, ts: str, table: str, checkpoint: str, by: Sequence[str] = ()) -> str:
    """Counts per day of everything that has arrived, kept up to date batch by batch, and stop.

    Open days show at once and late rows correct closed ones, however late; there is no watermark and no state but the
    table, which has one row per day (and value of ``by``). ``table`` and ``checkpoint`` belong together: start both anew
    or none.
    """
    def add(rows: DataFrame, number: int) -> None:
        merge_daily_counts(rows, number, ts, table, by)

    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return table


def daily_counts(spark: SparkSession, table: str) -> DataFrame:
    """The newest complete version of a maintained table."""
    versions = _versions(spark, table)
    if not versions:
        raise FileNotFoundError(f"no complete version under {table}")
    return spark.read.parquet(versions[max(versions)])
