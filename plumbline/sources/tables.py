"""Tables in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line; ``path`` may be a glob.

    Without ``schema`` the types are inferred, which reads the files once more:
    give a schema for large inputs.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_interactions(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    columns: Sequence[str] = ("username", "indicatorId", "count"),
    **options: str,
) -> DataFrame:
    """User, item and count rows from any Spark source, including third-party connectors."""
    return spark.read.format(format).options(**options).load(path).select(*columns)


def frame_from_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | str | Sequence[str]) -> DataFrame:
    """A small in-memory list as a DataFrame."""
    return spark.createDataFrame(rows, schema)


def write_csv_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header line; fails by default when ``path`` exists."""
    df.write.option("header", True).mode(mode).csv(path)
