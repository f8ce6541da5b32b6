"""Grouping of category codes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The country codes kept as they are, and the codes grouped as EUROPE.
KEPT_COUNTRIES = ["GB", "US", "IN", "UNKNOWN"]
EUROPE_CODES = [
    "BE", "BG", "CZ", "DK", "DE", "EE", "IE", "EL", "ES", "FR", "HR", "IT", "CY", "LV", "LT", "LU",
    "HU", "MT", "NL", "AT", "PL", "PT", "RO", "SI", "SK", "FI", "SE", "CH", "IS", "NO", "LI", "EU",
]
COUNTRY_GROUPS = {"EUROPE": EUROPE_CODES}
OTHER = "OTHER"


def category_group(
    col: str | Column,
    groups: Mapping[str, Iterable[str]] = COUNTRY_GROUPS,
    keep: Iterable[str] = KEPT_COUNTRIES,
    other: str = OTHER,
) -> Column:
    """A code itself when kept, else its group's name, else ``other`` (also for null)."""
    code = F.col(col) if isinstance(col, str) else col
    choice = F.when(code.isin(list(keep)), code)
    for name, codes in groups.items():
        choice = choice.when(code.isin(list(codes)), F.lit(name))
    return choice.otherwise(F.lit(other))


def group_category(
    df: DataFrame,
    col: str,
    groups: Mapping[str, Iterable[str]] = COUNTRY_GROUPS,
    keep: Iterable[str] = KEPT_COUNTRIES,
    other: str = OTHER,
    out: str | None = None,
) -> DataFrame:
    """Add the grouped category, in place unless ``out`` names a new column."""
    return df.withColumn(out or col, category_group(col, groups, keep, other))


def register_category_udf(
    spark: SparkSession,
    name: str = "countryGrouping",
    groups: Mapping[str, Iterable[str]] = COUNTRY_GROUPS,
    keep: Iterable[str] = KEPT_COUNTRIES,
    other: str = OTHER,
):
    """Register the grouping under a name for SQL text, as an Arrow-batched UDF.

    ``category_group`` gives the same values inside generated code and is the
    one to use from Python.
    """
    target = {code: group for group, codes in groups.items() for code in codes} | {code: code for code in keep}

    @F.pandas_udf(T.StringType())
    def grouped(codes: pd.Series) -> pd.Series:
        return codes.map(target).fillna(other)

    return spark.udf.register(name, grouped)
