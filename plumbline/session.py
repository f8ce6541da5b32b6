"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` holds further Spark settings."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
        if is_local(master):
            # Small files: let every core have a part of them.
            builder = builder.config("spark.sql.files.openCostInBytes", "256k")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(master: str) -> bool:
    """Whether driver and tasks are one process (``local``, ``local[n]``), not a cluster of any kind."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which every executor can reach.

    A folder of our own is made only where the setting is missing and the
    session is local (tests); on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir")
        if configured:
            sc.setCheckpointDir(configured)
        elif is_local(sc.master):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="plumbline-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{checkpoint_folder(spark)}/plumbline/{name}-{uuid.uuid4().hex}"


def balance(df: DataFrame) -> DataFrame:
    """Even out the partitions with one shuffle, sized by adaptive execution.

    For inputs of iterative fits: skew left by a filter or join would otherwise
    slow down every pass.  Balance plain columns before they are encoded, as
    vectors are wider to shuffle.
    """
    return df.hint("rebalance")


def spread(df: DataFrame) -> DataFrame:
    """Give every core its share of the rows.

    For small rows that much is computed from: by bytes one task would get them all.
    """
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def pin(df: DataFrame, name: str = "pin", rows_per_file: int = 0, **options) -> DataFrame:
    """Write ``df`` to the shared folder once and return a scan of it.

    Model fits read their input dozens of times.  A pinned table is computed
    once, is pruned and pushed down to like any Parquet source, and gives the
    same rows after an executor is lost.  ``rows_per_file`` bounds the rows of a
    file: narrow rows pack so well that a split by bytes holds many millions.  ``options`` are the writer's.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.options(**options).parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Lists of the tables pinned by the jobs that run now, innermost last.
_SCOPES: list[list[str]] = []


class Report:
    """What a job gives back; it owns the tables the job pinned.

    ``close`` (or leaving a ``with`` block) deletes them, after which the frames
    over them stop working.
    """

    _pins: tuple[str, ...] = ()
    _session: SparkSession | None = None

    def close(self) -> None:
        for path in self._pins:
            _delete(self._session, path)
        self._pins = ()

    def __enter__(self):
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def owns_pins(job: Callable) -> Callable:
    """Hand the tables that ``job`` pins to the report it returns."""

    @functools.wraps(job)
    def run(*args, **kwargs):
        _SCOPES.append([])
        try:
            report = job(*args, **kwargs)
        finally:
            pinned = _SCOPES.pop()
        if isinstance(report, Report):
            report._pins += tuple(pinned)
            report._session = SparkSession.active()
        elif _SCOPES:
            _SCOPES[-1].extend(pinned)
        return report

    return run


def _delete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release_pins(spark: SparkSession) -> bool:
    """Delete every table this application pinned, as its last step: frames over them stop working."""
    return _delete(spark, f"{checkpoint_folder(spark)}/plumbline")


CACHED_AT_ONCE = 2 << 30  # bytes that fits side by side may cache together


def fits_at_once(scan: DataFrame, cached: int = 0) -> int:
    """How many fits over a pinned table to run side by side.

    Each fit may cache its rows.  While the table has no more partitions than
    there are cores, one fit cannot fill the cluster and several fit in memory;
    a table of many rounds of tasks is fitted one model at a time.  Packed files
    hide how much a fit caches, so ``cached``, its bytes, bounds the number too.
    """
    rounds = scan.rdd.getNumPartitions() / scan.sparkSession.sparkContext.defaultParallelism
    together = 6 if rounds <= 1 else 2 if rounds <= 8 else 1
    return max(1, min(together, CACHED_AT_ONCE // cached)) if cached else together


def run_together(spark: SparkSession, task: Callable, items: Iterable, parallelism: int = 4) -> list:
    """Run ``task(item)`` for several items at once, as independent Spark jobs."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [task(item) for item in items]
    pool = ThreadPool(min(parallelism, len(items)))
    try:
        return pool.map(inheritable_thread_target(spark)(task), items)
    finally:
        pool.close()
