"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import threading
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark whatever store its path names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null as empty), so that no other column can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions the session gives a shuffle: what key ranges are cut into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def unhex_lower(column: Column) -> Column:
    return F.lower(F.hex(column))


def give_back() -> None:
    """Return the freed memory of this process to the system, where its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


IDLE_SECONDS = 2  # longer than from task to task of a stage
_waiting: list[threading.Timer] = []


def busy() -> None:
    """A task of this worker begins: nothing is freed until it ends."""
    while _waiting:
        _waiting.pop().cancel()


def idle(release: Callable[[], None], seconds: float = IDLE_SECONDS) -> None:
    """A task ends: call ``release`` unless another one begins soon.

    Spark keeps workers for a minute, so what they remember would lie beside the memory of the stages that follow.
    """
    busy()
    timer = threading.Timer(seconds, release)
    timer.daemon = True
    timer.start()
    _waiting.append(timer)
