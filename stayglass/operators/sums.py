"""Arrays of one fixed size that tasks add up."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WAYS = 16  # groups in which the arrays of many tasks meet before the driver adds those of the groups


def summed(df: DataFrame, size: int, add: Callable[[Iterator[pa.RecordBatch], np.ndarray], None], tasks: int) -> np.ndarray:
    """The sum over all tasks of arrays that ``add(batches, array)`` fills. ``tasks`` is about the number of tasks."""

    def fill(batches):
        total = np.zeros(size)
        add(batches, total)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % WAYS]), pa.array([total.tobytes()], pa.binary())], ["way", "cells"])

    def meet(group):
        total = np.zeros(size)
        for cells in group.column("cells").to_pylist():
            total += np.frombuffer(cells)
        return pa.table({"way": group.column("way")[:1], "cells": pa.array([total.tobytes()], pa.binary())})

    schema = "way bigint, cells binary"
    parts = df.mapInArrow(fill, schema)
    if tasks > 4 * WAYS:
        parts = parts.groupBy("way").applyInArrow(meet, schema)
    total = np.zeros(size)
    for row in sorted(parts.collect()):  # one order, so that sums repeat
        total += np.frombuffer(row.cells)
    return total
