"""Helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayglass.session import work_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(columns, *names: str) -> list[str]:
    """Names for working columns that no column of the input has, whatever the case of its letters."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def name_of(column: str):
    """Column by its whole name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: later steps start there, also after an executor is lost."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: bytes of a record batch between the JVM and Python; the default counts 10,000 rows or 64 MB
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Record batches of ``BATCH_BYTES`` at most, unless the session has a setting of its own. Rows of long texts or of
    pairs of sets fill a default batch, which stands in the JVM's direct memory and in the worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) == "67108864b":  # the default
        spark.conf.set(key, str(BATCH_BYTES))


def fold(id_column, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % parts


def undotted(df: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """``df`` with plain names for all columns but the ``used`` ones, for functions over batches, which can't take dots
    in names; and the names it had, to be set again by position."""
    names = list(df.columns)
    plain: list[str] = []
    for c in names:
        plain += [c] if c in used else fresh([*names, *plain], f"column_{len(plain)}")
    return df.toDF(*plain), names
