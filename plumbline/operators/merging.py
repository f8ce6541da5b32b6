"""Sums of mergeable states over all tasks, added up in Spark a bounded number at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 512  # tasks whose states meet in one group before the last merge
SCHEMA = "key string, task long, state binary"

States = dict[str, np.ndarray]


def accumulate(df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], States], merge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """One row ``(key, state)`` per key: what ``make`` gives for each task, merged.

    A state is a flat array of doubles.  Each task sends its states once; groups
    of FAN_IN tasks merge, then what is left per key.  A merge holds two states,
    however many it goes through, and nothing reaches the driver.
    """

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for key, state in make(batches).items():
            yield _row(key, task, state)

    def join(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column(batch.schema.get_field_index("state")):
                state = np.frombuffer(raw.as_buffer(), np.float64)
                total = state if total is None else merge(total, state)
        yield _row(key[0].as_py(), key[1].as_py() if len(key) > 1 else 0, total)

    states = df.mapInArrow(start, SCHEMA)
    states = states.groupBy("key", F.floor(F.col("task") / FAN_IN)).applyInArrow(join, SCHEMA)
    return states.groupBy("key").applyInArrow(join, SCHEMA).select("key", "state")


def _row(key: str, task: int, state: np.ndarray) -> pa.RecordBatch:
    values = [pa.array([key], pa.string()), pa.array([task], pa.int64()), pa.array([np.ascontiguousarray(state, np.float64).tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(values, ["key", "task", "state"])


def collected(states: DataFrame) -> States:
    """The merged states on the driver; their size is that of the columns, not of the rows."""
    return {row["key"]: np.frombuffer(bytes(row["state"]), np.float64) for row in states.collect()}
