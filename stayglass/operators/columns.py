"""Column selection, renaming and coverage-driven pruning.

Operators marked *one pass* run a single aggregate over the input to decide which columns stay;
the result of that aggregate is one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayglass import fixed_values as fv
from stayglass.functions.text import parse_date, parse_whole


def quoted(name: str) -> str:
    return f"`{name}`"


def coverage(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """(rows, non-null count per column) - one pass."""
    columns = list(df.columns if columns is None else columns)
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.col(quoted(c))).alias(f"c{i}") for i, c in enumerate(columns)],
    ).first()
    return row["n"], {c: row[f"c{i}"] for i, c in enumerate(columns)}


def canonical_name(df: DataFrame, candidates: Sequence[str], name: str) -> DataFrame:
    """Rename the first candidate that exists to ``name``."""
    found = next((c for c in candidates if c in df.columns), None)
    return df if found in (None, name) else df.withColumnRenamed(found, name)


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in wanted if c in df.columns])


def drop_suffixed(df: DataFrame, suffix: str, containing: Iterable[str]) -> DataFrame:
    """Drop columns with the suffix whose name holds one of the given names."""
    words = list(containing)
    return df.drop(*[c for c in df.columns if c.endswith(suffix) and any(w in c for w in words)])


def keep_best_covered(df: DataFrame, words: Sequence[str], name: str) -> DataFrame:
    """Of the columns whose name holds all ``words``, keep the best covered as ``name`` - one pass.

    The first wins a tie.
    """
    found = [c for c in df.columns if all(w in c.lower() for w in words)]
    if len(found) < 2:
        return df
    _, counts = coverage(df, found)
    best = max(found, key=lambda c: counts[c])
    return df.drop(*[c for c in found if c != best]).withColumnRenamed(best, name)


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop columns without any value - one pass."""
    _, counts = coverage(df)
    return df.drop(*[c for c, n in counts.items() if n == 0])


def drop_low_coverage(df: DataFrame, threshold: float = fv.MIN_COVERAGE,
                      essential: Sequence[str] = fv.ESSENTIAL_COLUMNS) -> DataFrame:
    """Drop columns covered below ``threshold`` unless essential - one pass."""
    rows, counts = coverage(df)
    low = [c for c, n in counts.items() if c not in essential and n < threshold * rows]
    return df.drop(*low)


def drop_sparse(df: DataFrame, threshold: float = fv.MIN_COVERAGE,
                essential: Sequence[str] = fv.ESSENTIAL_COLUMNS) -> DataFrame:
    """``drop_empty`` followed by ``drop_low_coverage``, sharing one pass."""
    rows, counts = coverage(df)
    gone = [
        c for c, n in counts.items() if n == 0 or (c not in essential and n < threshold * rows)
    ]
    return df.drop(*gone)


def features_by_missing_rate(df: DataFrame, wanted: Sequence[str],
                             max_missing_pct: float = fv.MAX_MISSING_PCT) -> list[str]:
    """Available wanted columns missing in at most the given share - one pass."""
    names = [c for c in wanted if c in df.columns]
    rows, counts = coverage(df, names)
    return [c for c in names if rows and (rows - counts[c]) / rows * 100 <= max_missing_pct]


def default_if_empty(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Constant for columns that are absent or hold no value at all - one pass."""
    present = [c for c in defaults if c in df.columns]
    counts = coverage(df, present)[1] if present else {}
    filled = {c: F.lit(v) for c, v in defaults.items() if not counts.get(c)}
    return df.withColumns(filled) if filled else df


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by a name -> type map; values that do not fit become null."""
    have = dict(df.dtypes)
    casts = {}
    for name, kind in types.items():
        if name not in have or have[name] == kind:
            continue
        c = F.col(quoted(name))
        if have[name] != "string":
            casts[name] = c.try_cast(kind)
        elif kind == "date":
            casts[name] = parse_date(c)
        elif kind == "bigint":
            casts[name] = parse_whole(c)
        elif kind == "boolean":
            number = c.try_cast("double")
            casts[name] = F.coalesce(number != 0, c.try_cast("boolean"))
        else:
            casts[name] = c.try_cast(kind)
    return df.withColumns(casts) if casts else df


def trim_strings(df: DataFrame) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.trim(F.col(quoted(c))) for c in names}) if names else df


def coverage_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows: column_name, non_null, missing, coverage_pct. Lazy."""
    columns = list(df.columns if columns is None else columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(quoted(c))).alias(c) for c in columns],
    )
    return counts.unpivot("_rows", [quoted(c) for c in columns], "column_name", "non_null").select(
        "column_name",
        "non_null",
        (F.col("_rows") - F.col("non_null")).alias("missing"),
        F.round(F.try_divide(F.col("non_null") * 100.0, F.col("_rows")), 4).alias("coverage_pct"),
    )
