"""Second moments of many column pairs in one scan, on pairwise complete rows.

Each task adds up its record batches as matrices (column x against column y, over the rows that have both) and
returns one row per pair; these few rows meet by pair. The input is read once however many pairs there are.
Means are single doubles: a correlation is good to about the last digit of the values against their spread.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayglass.operators.columns import quoted

#: a sum of squares below this share of the squared distances it is taken from has lost too many digits
CANCELLED = 1e-6

PARTIAL = "x int, y int, n bigint, mean_x double, mean_y double, cxx double, cyy double, cxy double"


class Moments(NamedTuple):
    """Matrices over (x, y): rows, means, and sums of squared and multiplied distances from the means."""

    n: np.ndarray
    mean_x: np.ndarray
    mean_y: np.ndarray
    cxx: np.ndarray
    cyy: np.ndarray
    cxy: np.ndarray


def batch_moments(x: np.ndarray, y: np.ndarray) -> Moments:
    """Of the columns of two arrays with the same rows; NaN is a missing value.

    A pair whose common rows hold an infinity has NaN for its squares and products.
    """
    dx, there_x, infinite_x, shift_x = _centred(x)
    dy, there_y, infinite_y, shift_y = _centred(y)
    n = there_x.T @ there_y
    rows = np.maximum(n, 1)
    sum_x, sum_y = dx.T @ there_y, there_x.T @ dy
    square_x, square_y = (dx * dx).T @ there_y, there_x.T @ (dy * dy)
    out = Moments(
        n, shift_x[:, None] + sum_x / rows, shift_y + sum_y / rows,
        square_x - sum_x * sum_x / rows, square_y - sum_y * sum_y / rows, dx.T @ dy - sum_x * sum_y / rows,
    )
    # where the sums cancel, the rows of the pair are looked at themselves; a constant then has a spread of exactly 0
    for i, j in np.argwhere((out.cxx < CANCELLED * square_x) | (out.cyy < CANCELLED * square_y)):
        both = (there_x[:, i] > 0) & (there_y[:, j] > 0)
        a, b = x[both, i], y[both, j]
        if np.isfinite(a).all() and np.isfinite(b).all():
            out.mean_x[i, j], out.mean_y[i, j] = _mean(a), _mean(b)
            a, b = a - out.mean_x[i, j], b - out.mean_y[i, j]
            out.cxx[i, j], out.cyy[i, j], out.cxy[i, j] = a @ a, b @ b, a @ b
    unbounded = (infinite_x.T @ there_y + there_x.T @ infinite_y) > 0
    for matrix in (out.cxx, out.cyy, out.cxy):
        matrix[unbounded] = np.nan
    return out


def _mean(values: np.ndarray) -> float:
    """Mean, never outside the values: that of equal values is the value."""
    return float(np.clip(values.mean(), values.min(), values.max()))


def _centred(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Finite values less the mean of their column (others 0); which are there; which are infinite; the means."""
    finite = np.isfinite(values)
    shift = np.array([_mean(values[ok, i]) if ok.any() else 0.0 for i, ok in enumerate(finite.T)])
    less = np.where(finite, values, shift) - shift
    return less, (~np.isnan(values)).astype(float), np.isinf(values).astype(float), shift


def merged(a: Moments, b: Moments) -> Moments:
    """Moments of the rows of both."""
    n = a.n + b.n
    share = b.n / np.maximum(n, 1)
    by_x, by_y = b.mean_x - a.mean_x, b.mean_y - a.mean_y
    between = a.n * share
    return Moments(
        n, a.mean_x + by_x * share, a.mean_y + by_y * share,
        a.cxx + b.cxx + by_x * by_x * between, a.cyy + b.cyy + by_y * by_y * between, a.cxy + b.cxy + by_x * by_y * between,
    )


def co_moments(df: DataFrame, xs: Sequence[str], ys: Sequence[str]) -> DataFrame:
    """Rows (x, y, n, mean_x, mean_y, cxx, cyy, cxy), one for each column of ``xs`` with each of ``ys``, by position.

    ``n`` counts the rows that have both; cxx and cyy are sums of squared distances from the means over those rows, cxy
    that of products. Null and NaN are missing; pairs without common rows, and all pairs of an empty frame, have n = 0
    and null means.
    """
    names = list(dict.fromkeys([*xs, *ys]))
    at_x, at_y = [names.index(c) for c in xs], [names.index(c) for c in ys]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
                part = batch_moments(values[:, at_x], values[:, at_y])
                total = part if total is None else merged(total, part)
        if total is not None:
            i, j = (a.ravel().astype(np.int32) for a in np.indices(total.n.shape))
            cells = [i, j, total.n.ravel().astype(np.int64), *[m.ravel() for m in total[1:]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], [f.split()[0] for f in PARTIAL.split(", ")])

    numbers = df.select(*[F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    none = df.sparkSession.range(len(xs) * len(ys)).select(
        (F.col("id") / len(ys)).cast("int").alias("x"), (F.col("id") % len(ys)).cast("int").alias("y"), F.lit(0).cast("bigint").alias("n"),
        *[F.lit(0.0).alias(c) for c in ("mean_x", "mean_y", "cxx", "cyy", "cxy")],
    )
    # distances from one of the means, so that equal means leave exactly 0
    pair = Window.partitionBy("x", "y")
    parts = numbers.mapInArrow(partial, PARTIAL).unionByName(none)
    for c in ("x", "y"):
        mean = F.when(F.col("n") > 0, F.col(f"mean_{c}"))
        parts = parts.withColumn(f"from_{c}", F.min(mean).over(pair)).withColumn(f"d{c}", F.coalesce(mean - F.col(f"from_{c}"), F.lit(0.0)))
    n = F.col("n")
    sums = parts.groupBy("x", "y").agg(
        F.sum(n).alias("n"), F.max("from_x").alias("from_x"), F.max("from_y").alias("from_y"),
        F.sum(n * F.col("dx")).alias("sx"), F.sum(n * F.col("dy")).alias("sy"),
        F.sum(F.col("cxx") + n * F.col("dx") * F.col("dx")).alias("sxx"),
        F.sum(F.col("cyy") + n * F.col("dy") * F.col("dy")).alias("syy"),
        F.sum(F.col("cxy") + n * F.col("dx") * F.col("dy")).alias("sxy"),
    )
    rows = F.greatest(n, F.lit(1))

    def about_mean(total: str, a: str, b: str):
        return F.col(total) - F.col(a) * F.col(b) / rows

    return sums.select(
        "x", "y", "n", (F.col("from_x") + F.col("sx") / rows).alias("mean_x"), (F.col("from_y") + F.col("sy") / rows).alias("mean_y"),
        about_mean("sxx", "sx", "sx").alias("cxx"), about_mean("syy", "sy", "sy").alias("cyy"), about_mean("sxy", "sx", "sy").alias("cxy"),
    )


def correlations(df: DataFrame, xs: Sequence[str], ys: Sequence[str]) -> DataFrame:
    """Rows (x, y, n, r) with the columns' names; r is null where either column is constant, or an infinity takes part."""
    found = co_moments(df, xs, ys)
    r = F.try_divide(F.col("cxy"), F.sqrt(F.greatest(F.col("cxx"), F.lit(0.0))) * F.sqrt(F.greatest(F.col("cyy"), F.lit(0.0))))

    def name(names: Sequence[str], at: str):
        return F.element_at(F.array(*[F.lit(c) for c in names]), F.col(at) + 1).alias(at)

    return found.withColumn("r", r).select(name(xs, "x"), name(ys, "y"), "n", F.when(~F.isnan("r"), F.col("r")).alias("r"))
