"""CSV scans over drifting headers, source preference, sinks."""

from __future__ import annotations

import csv
import warnings
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayglass import fixed_values as fv
from stayglass.functions.text import null_if_na
from stayglass.operators.columns import quoted
from stayglass.operators.rows import union_by_name
from stayglass.session import work_path

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """A folder or file and all below it."""
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob, sorted."""
    hadoop_path, fs = _path(spark, pattern)
    found = fs.globStatus(hadoop_path) or []
    return sorted(s.getPath().toString() for s in found if s.isFile())


def header_of(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names in the first line; None for a file that cannot be read or is empty."""
    hadoop_path, fs = _path(spark, path)
    try:
        stream = fs.open(hadoop_path)
        try:
            reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            line = reader.readLine()
        finally:
            stream.close()
    except Exception:  # unreadable files are left out, as a listing folder may hold broken drops
        return None
    if not line or not line.strip():
        return None
    names = tuple(name.strip() for name in next(csv.reader([line.lstrip("\ufeff")])))
    if len(set(names)) < len(names):
        raise ValueError(f"{path} has a column name twice")
    return names


def scan_drifting_csv(spark: SparkSession, pattern: str, provenance: str | None = None,
                      skipped: list[str] | None = None) -> DataFrame:
    """All files of a glob as text columns, united by column name.

    Spark maps CSV columns by position, so files are grouped by their header line and each group
    is one distributed scan. Only first lines pass through the driver, many at a time. Files that
    cannot be read or are empty go to ``skipped``; without such a list a warning names them.
    """
    paths = list_files(spark, pattern)
    with ThreadPoolExecutor(32) as pool:
        headers = list(pool.map(lambda p: header_of(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        if header:
            groups.setdefault(header, []).append(path)
    left_out = [path for path, header in zip(paths, headers) if not header]
    if skipped is not None:
        skipped += left_out
    elif left_out:
        warnings.warn(f"not read: {', '.join(left_out)}", stacklevel=2)
    if not groups:
        raise FileNotFoundError(f"no readable CSV file matches {pattern}")
    frames = []
    for header, members in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        frame = spark.read.schema(schema).options(**CSV_OPTIONS).csv(members)
        frames.append(frame.withColumn(provenance, F.input_file_name()) if provenance else frame)
    return union_by_name(*frames)


def normalise_na(df: DataFrame, tokens: Sequence[str] = fv.NA_TOKENS) -> DataFrame:
    """"No value" texts to null and NaN to null, in every column."""
    fixed = {}
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, T.StringType):
            fixed[f.name] = null_if_na(c, list(tokens))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            fixed[f.name] = F.when(~F.isnan(c), c)
    return df.withColumns(fixed) if fixed else df


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV layout as text columns with "no value" texts nulled."""
    return normalise_na(spark.read.options(**CSV_OPTIONS).csv(path))


def scan_preferred(spark: SparkSession, *paths: str, **options: str) -> DataFrame:
    """The first path that exists: parquet unless its name ends in .csv."""
    for path in paths:
        if exists(spark, path):
            if path.endswith(".csv"):
                return normalise_na(spark.read.options(**CSV_OPTIONS, **options).csv(path))
            return spark.read.options(**options).parquet(path)
    raise FileNotFoundError(f"none of {paths} exists")


def stamp_metadata(df: DataFrame, values: Mapping[str, object], first: Sequence[str] = fv.METADATA_FIRST) -> DataFrame:
    """Add snapshot metadata; metadata columns come first."""
    stamped = df.withColumns({k: F.lit(v) for k, v in values.items()})
    lead = [c for c in first if c in stamped.columns]
    return stamped.select(*[quoted(c) for c in lead], *[quoted(c) for c in stamped.columns if c not in lead])


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back, so later passes start from the files."""
    return df.sparkSession.read.parquet(write_table(df, work_path(df.sparkSession, label)))


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)
    return path


def replace_table(df: DataFrame, path: str, copy_to: str | None = None) -> str:
    """Replace a table the frame may be read from, optionally keeping a copy elsewhere.

    The new rows go to a sibling path first and are swapped in once complete; the old files move
    aside. If a move fails the old files go back and an error is raised; between the two moves the
    table stands under its ``.old`` name alone.
    """
    spark = df.sparkSession
    staged, retired = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").parquet(staged)
    if copy_to:
        spark.read.parquet(staged).write.mode("overwrite").parquet(copy_to)
    target, fs = _path(spark, path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    if fs.exists(target):
        fs.delete(jvm_path(retired), True)
        if not fs.rename(target, jvm_path(retired)):
            raise OSError(f"cannot move {path} aside; the new rows are in {staged}")
    if not fs.rename(jvm_path(staged), target):
        if fs.exists(jvm_path(retired)):
            fs.rename(jvm_path(retired), target)
        raise OSError(f"cannot move {staged} to {path}")
    spark.catalog.refreshByPath(path)
    return path


def write_splits(df: DataFrame, metadata: DataFrame, folder: str, name: str = "split") -> str:
    """Split rows partitioned by split, plus the metadata row as JSON."""
    write_table(df, f"{folder}/rows", [name])
    metadata.write.mode("overwrite").json(f"{folder}/metadata")
    return folder


def load_split(spark: SparkSession, folder: str, split: str, targets: Sequence[str], name: str = "split") -> DataFrame:
    """Feature columns named in the metadata and the targets, of one split."""
    meta = spark.read.json(f"{folder}/metadata").first()
    rows = spark.read.parquet(f"{folder}/rows").where(F.col(name) == split)
    return rows.select(*[quoted(c) for c in [*meta["feature_columns"], *targets]])
