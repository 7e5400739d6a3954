"""Training rows as blocks of numbers: stored once, then read by every pass of a fit.

A pass is one Spark job.  Each task works on its blocks with numpy and sends back one row of sums, so the driver
sees sums only, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame

# Rows that one call works on: their values in a layer stay in the processor's cache.
ROWS = 2048
# Sums of more tasks are added by further tasks first.
MANY = 64


def as_blocks(rows: DataFrame, features: Column, label: Column, kind: type = np.float64, a_task: int = 100_000) -> tuple[RDD, RDD]:
    """Stored pairs of features (rows by columns) and labels as numbers of ``kind``, and the same in tasks for a pass.

    A pass has a task for every ``a_task`` rows, as starting one takes longer than a few rows do, and as many as there are
    parts at most.  Unpersist the first of the two at the end.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (v.to_numpy(zero_copy_only=False).astype(kind) for v in (b.column("x").flatten(), b.column("y")))
                if not (np.isfinite(x).all() and np.isfinite(y).all() and (y >= 0).all() and (y % 1 == 0).all()):
                    raise ValueError("a feature is null or not finite, or a label no whole number from 0 on")
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["x", "y"])

    def unpack(row) -> tuple[np.ndarray, np.ndarray]:
        y = np.frombuffer(row["y"], kind)
        return np.frombuffer(row["x"], kind).reshape(len(y), -1), y
    packed = rows.select(vector_to_array(features).alias("x"), label.cast("double").alias("y")).mapInArrow(pack, "x binary, y binary")
    stored = packed.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    n = stored.map(lambda b: len(b[1])).sum()
    return stored, stored.coalesce(max(1, -(-n // a_task)))


def summed(blocks: RDD, one: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``one(x, y)`` over all rows, some at a time; None without rows.  Tasks' sums are added in their order."""
    def add(part: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
        total = None
        for x, y in part:
            for at in range(0, len(y), ROWS):
                found = one(x[at:at + ROWS], y[at:at + ROWS])
                total = found if total is None else total + found
        if total is not None:
            yield total
    sums = blocks.mapPartitions(add)
    if blocks.getNumPartitions() > MANY:
        try:
            return sums.treeReduce(np.add)
        except ValueError:  # of no task any sum; what fails in a task is no ValueError here
            return None
    parts = sums.collect()
    return sum(parts[1:], parts[0]) if parts else None
