"""Right-closed buckets and target transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_right_closed(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the ``(low, high]`` bucket, null outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one edge more than labels needed")
    chain = None
    for low, high, label in zip(edges, edges[1:], labels):
        test = (c > F.lit(float(low))) & (c <= F.lit(float(high)))
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def collapse_rare(c: Column, kept: Sequence[str], other: str = "other") -> Column:
    return F.when(c.isin(list(kept)), c).otherwise(other)


def log_target(c: Column) -> Column:
    return F.log1p(c)


def inverse_log_target(c: Column) -> Column:
    return F.expm1(c)
