"""Equi joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts into which rows without a key are spread in a left join.
KEYLESS_PARTS = 1024


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, how: str = "inner", by_key: bool = False) -> DataFrame:
    """Join many rows to a table that has each key once.

    Spark broadcasts the lookup by its size in bytes; otherwise both sides shuffle
    by key, and adaptive execution splits the partitions of keys that hold many
    rows, between the tasks those rows come from (each task's share is bounded by
    its input).  Rows without a key match nothing: an inner join drops them before it
    shuffles, and a left join spreads them by a hash of their other columns and of
    the task they come from.

    ``by_key`` says that the rows already lie by key, so that one task may hold all
    rows of a hot one: they are rebalanced before the join, at the price of a second shuffle.
    """
    if by_key:
        df = df.hint("rebalance")
    if how == "inner":
        return df.join(lookup, key, how)
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in plain]), F.lit(KEYLESS_PARTS))
    left = df.withColumn("_spread", F.when(F.col(key).isNull(), spread).otherwise(F.lit(0)))
    return left.join(lookup.withColumn("_spread", F.lit(0).cast("long")), [key, "_spread"], how).drop("_spread")


def attach_user_names(
    recs: DataFrame,
    interactions: DataFrame,
    user: str = "userId",
    name: str = "username",
) -> DataFrame:
    """Recommendations with the user's name instead of the surrogate id.

    The interactions are reduced to one row per user before the join, so it is
    one-to-one however many rows a user has.
    """
    names = interactions.select(user, name).distinct()
    return recs.join(names, user, "inner").drop(user)
