"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None, name: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``covers`` names the inventory lines it shows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        key = name or fn.__name__
        assert key not in QUERIES, key
        QUERIES[key] = Query(key, covers, fn, sql)
        return fn

    return register
