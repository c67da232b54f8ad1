"""Sums of one array over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Numbers of a summed range, and branches of the tree.
RANGE, BRANCHES = 1 << 15, 32
SCHEMA = "part int, branch int, sum binary"


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(pdf["sum"].iloc[0]).copy()
    for s in pdf["sum"].iloc[1:]:
        total += np.frombuffer(s)
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "branch": [0], "sum": [total.tobytes()]})


def add_up(rows: DataFrame, local: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over tasks of what ``local`` makes of a task's batches: an array of ``size`` numbers, a bound that the caller sets.

    Arrays are summed by ranges and in two levels, so neither a task nor the driver takes one array from every task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.ascontiguousarray(local(batches), np.float64).ravel()
        ranges = range(0, size, RANGE)
        branch = TaskContext.get().partitionId() % BRANCHES
        columns = [pa.array([r // RANGE for r in ranges], pa.int32()), pa.array([branch] * len(ranges), pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([total[r : r + RANGE].tobytes() for r in ranges], pa.binary())], ["part", "branch", "sum"])

    sums = rows.mapInArrow(run, SCHEMA).groupBy("part", "branch").applyInPandas(_add, SCHEMA).groupBy("part").applyInPandas(_add, SCHEMA)
    out = np.zeros(size)
    for r in sums.collect():  # ``size`` numbers
        out[r["part"] * RANGE : (r["part"] + 1) * RANGE] = np.frombuffer(bytes(r["sum"]))
    return out
