"""Unions and hold-out splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(a: DataFrame, b: DataFrame, by_name: bool = False) -> DataFrame:
    """Rows of both frames, duplicates kept; by position unless ``by_name``."""
    return a.unionByName(b) if by_name else a.unionAll(b)


def random_holdout(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Random parts by weight.

    The draw depends on how the rows are partitioned, so give it a stable input
    (a table scan or a pinned frame), or use ``key_holdout``.
    """
    return df.randomSplit(list(weights), seed=seed)


def holdout_bucket(df: DataFrame, key: str | Sequence[str] | None = None) -> Column:
    """A bucket 0..99 that depends on the key values alone.

    It does not move when the table is repartitioned or a task runs again.
    Keys of every type are hashed by their text, so runs and steps of numbers
    spread; null is a value like others.  Without a key the whole row is hashed.
    """
    if key is None:
        return F.pmod(F.xxhash64(*df.columns), F.lit(100))
    return F.conv(F.substring(F.md5(_key_text(key).cast("binary")), 1, 8), 16, 10).cast("long") % 100


def _key_text(key: str | Sequence[str]) -> Column:
    cols = [key] if isinstance(key, str) else list(key)
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])


def key_holdout(df: DataFrame, key: str | Sequence[str] | None, pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """``(training, holdout)`` with about ``pct`` percent of the keys in training."""
    bucket = holdout_bucket(df, key)
    return df.where(bucket < pct), df.where(bucket >= pct)


def stratified_holdout(
    df: DataFrame,
    label: str,
    percents: Mapping[object, int],
    key: str | Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A split with its own training share per class.

    One predicate covers all classes, so the table is read once per part and
    not once per class.  Classes without a share go to the hold-out.
    """
    share = F.lit(0)
    for value, pct in percents.items():
        share = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(pct)).otherwise(share)
    bucket = holdout_bucket(df, key)
    return df.where(bucket < share), df.where(bucket >= share)


HASH_BITS, LEVEL_BITS = 60, 15


def _key_hash(key: str | Sequence[str]) -> Column:
    """The first 60 bits of the digest behind ``holdout_bucket``."""
    return F.conv(F.substring(F.md5(_key_text(key).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def exact_stratified_holdout(
    df: DataFrame, label: str, percents: Mapping[object, int], key: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """``(training, holdout)`` where class ``c`` gives ``floor(rows * percent / 100)`` training rows, exactly.

    Rows are in order of a hash of ``key``; a class's threshold is found by four
    histograms, each refining the bucket the threshold lies in, so that one row per
    class reaches the driver.  Rows of one key stay together: where the threshold
    falls among them they all go to the hold-out, and the class gives that many
    fewer.  Classes without a share, and rows of a null class that is not
    named, go to the hold-out; so does everything of an empty table.
    """
    values = list(percents)
    number = F.coalesce(*[F.when(F.col(label).eqNullSafe(F.lit(v)), F.lit(i)) for i, v in enumerate(values)], F.lit(-1))
    hashed = df.select(number.alias("class"), _key_hash(key).alias("h")).where("class >= 0")
    sizes = {r["class"]: r["count"] for r in hashed.groupBy("class").count().collect()}
    left = {i: sizes[i] * percents[values[i]] // 100 for i in sizes}
    whole = {i for i in left if left[i] >= sizes[i]}
    prefix = {i: 0 for i in left if i not in whole}
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        for i, (bucket, before) in _crossings(hashed, prefix, left, shift).items():
            prefix[i], left[i] = bucket, left[i] - before
    bound = F.lit(0).cast("long")
    for i in sizes:
        limit = 1 << HASH_BITS if i in whole else prefix[i]
        bound = F.when(number == i, F.lit(limit).cast("long")).otherwise(bound)
    training = _key_hash(key) < bound
    return df.where(training), df.where(~training)


def _crossings(hashed: DataFrame, prefix: Mapping[int, int], left: Mapping[int, int], shift: int) -> dict[int, tuple[int, int]]:
    """Per class the bucket in which its threshold lies, and the rows of its open bucket before that."""
    if not prefix:
        return {}
    open_ = F.lit(False)
    wanted = F.lit(None).cast("long")
    for i, bucket in prefix.items():
        open_ = open_ | ((F.col("class") == i) & (F.shiftright("h", shift + LEVEL_BITS) == bucket))
        wanted = F.when(F.col("class") == i, F.lit(left[i]).cast("long")).otherwise(wanted)
    counts = hashed.where(open_).groupBy("class", F.shiftright("h", shift).alias("bucket")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("class").orderBy("bucket"))
    past = counts.withColumn("upto", upto).where(F.col("upto") > wanted)
    first = past.groupBy("class").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("at"))
    return {r["class"]: (r["at"]["bucket"], r["at"]["before"]) for r in first.collect()}
