"""Projections, column expressions and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def select_exprs(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    """SQL expressions; use ``get(arr, 0)`` for an element that may be missing."""
    return df.selectExpr(*exprs)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*cols)


def ratio_column(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """``num / den``, null where the divisor is zero or null."""
    return df.withColumn(out, F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")))


def scale_column(df: DataFrame, col: str, factor: float) -> DataFrame:
    return df.withColumn(col, F.col(col) * F.lit(factor))


def null_to_zero(df: DataFrame, cols: Sequence[str], suffix: str = "_cleaned") -> DataFrame:
    """Nulls become a zero of the column's own type; an empty suffix overwrites in place."""
    return df.withColumns(
        {f"{c}{suffix}": F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols}
    )


# Comparisons by name; null never satisfies one, so it takes the other value.
_COMPARE = {
    ">=": lambda c, v: c >= v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    "<": lambda c, v: c < v,
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
}


def threshold_label(
    df: DataFrame,
    col: str,
    op: str,
    value: Any,
    if_true: Any = 1,
    if_false: Any = 0,
    out: str = "label",
) -> DataFrame:
    """Two-valued label; a null input counts as not meeting the test."""
    return df.withColumn(out, F.when(_COMPARE[op](F.col(col), value), F.lit(if_true)).otherwise(F.lit(if_false)))


def constant_column(df: DataFrame, name: str, value: Any) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def lowercase_column(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.lower(col))


def first_element(df: DataFrame, arr: str, out: str) -> DataFrame:
    """First array element, null when the array is empty."""
    return df.withColumn(out, F.get(arr, F.lit(0)))


def file_basename(df: DataFrame, col: str = "image.origin", out: str = "name") -> DataFrame:
    """Last part of a path."""
    return df.withColumn(out, F.substring_index(F.col(col), "/", -1))


def cast_to_int_equal(left: str | Column, right: str | Column) -> Column:
    """Whether two numbers agree once both are cut to integers."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return as_col(left).cast("int") == as_col(right).cast("int")


def filter_expr(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which a SQL condition is true; false and null rows drop."""
    return df.filter(condition)


def require_columns(df: DataFrame, not_null: Sequence[str] = (), equals: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows with all of ``not_null`` present and all of ``equals`` matched."""
    for c in not_null:
        df = df.where(F.col(c).isNotNull())
    for c, v in (equals or {}).items():
        df = df.where(F.col(c) == F.lit(v))
    return df


def matching_predictions(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Rows whose prediction equals the label as integers."""
    return pred.where(cast_to_int_equal(prediction, label))
