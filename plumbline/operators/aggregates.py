"""Counts, pivots and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.encoding import CategoryIndex, fit_index
from plumbline.operators.moments import correlation_rows, description_rows, numeric_columns, states_of
from plumbline.session import pin


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def cluster_sizes(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(prediction).count()


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(label, prediction).count()


def interaction_totals(df: DataFrame, user: str, item: str, value: str) -> DataFrame:
    """Summed value per user and item, one row per pair that occurs."""
    return df.groupBy(user, item).agg(F.sum(value).alias(value))


def interaction_matrix(
    df: DataFrame, user: str, item: str, value: str, values: Sequence | None = None
) -> DataFrame:
    """One row per user and one column per item, null where the pair is missing.

    Give ``values`` when the items are known, it saves a job.  The items become
    columns, so their names reach the driver; ``interaction_totals`` gives the
    same values as rows, for any number of items.
    """
    if values is None:
        found = df.select(item).where(F.col(item).isNotNull()).distinct().toLocalIterator()
        values = sorted(row[0] for row in found)
    return df.groupBy(user).pivot(item, list(values)).sum(value)


def interaction_rows(df: DataFrame, user: str, item: str, value: str) -> tuple[DataFrame, CategoryIndex]:
    """The matrix in sparse rows ``(user, items, values)`` for any number of items, and the index of the items.

    ``items`` are rising places in the index (the item of most users is 0, ties by text),
    ``values`` the sums there.  Items stay in a distributed table; a row is as long as the
    user has distinct items.  A null item has no place, so a user with no other
    has an empty row; a null user is a user like others.
    """
    totals = pin(interaction_totals(df, user, item, value), "interactions")
    index = fit_index(totals, [item])
    placed = index.transform(totals, [item], ["__at"], invalid="keep")
    cell = F.when(F.col(item).isNotNull(), F.struct(F.col("__at").cast("int").alias("at"), F.col(value).alias("sum")))
    rows = placed.groupBy(user).agg(F.array_sort(F.collect_list(cell)).alias("__cells"))
    return rows.select(user, F.col("__cells.at").alias("items"), F.col("__cells.sum").alias("values")), index


def describe_table(df: DataFrame) -> DataFrame:
    """Count, mean, stddev, min and max as strings, one column per input column."""
    return df.describe()


def describe_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The same statistics as rows ``(column, stat, value)`` for numeric columns, from mergeable moments."""
    cols = list(cols or numeric_columns(df))
    return description_rows(states_of(df, cols, pairs=False), cols)


def label_correlations(
    df: DataFrame, label: str, cols: Sequence[str] | None = None, null_as_zero: bool = False
) -> DataFrame:
    """Pearson correlation of each column with the label, all in one pass.

    A pair with a null in it is left out; ``null_as_zero`` counts the null as 0.
    """
    cols = list(cols or numeric_columns(df))
    states = states_of(df, cols, [label], null_as_zero=null_as_zero)
    return correlation_rows(states, cols, [label]).select("column", "correlation")


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None, null_as_zero: bool = False) -> DataFrame:
    """Correlation of every pair of columns as rows ``(column, other, correlation)``.

    Each pair of column blocks is computed once and given both ways round.
    """
    cols = list(cols or numeric_columns(df))
    return correlation_rows(states_of(df, cols, null_as_zero=null_as_zero), cols)


def low_correlation_columns(
    df: DataFrame, label: str, threshold: float, cols: Sequence[str] | None = None
) -> list[str]:
    """Names of the columns whose correlation with the label is weaker than ``threshold``."""
    cols = [c for c in (cols or numeric_columns(df)) if c != label]
    found = label_correlations(df, label, cols).collect()
    return [r["column"] for r in found if r["correlation"] is None or not abs(r["correlation"]) >= threshold]


def drop_low_correlation(
    df: DataFrame, label: str, threshold: float, cols: Sequence[str] | None = None
) -> DataFrame:
    """Drop the numeric columns that hardly move with the label."""
    return df.drop(*low_correlation_columns(df, label, threshold, cols))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
