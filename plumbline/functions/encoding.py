"""Category indexes, one-hot vectors and feature assembly."""

from __future__ import annotations

from collections.abc import Sequence

from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.joins import lookup_join
from plumbline.operators.topk import rank_counts
from plumbline.session import pin


def _nominal(values: int) -> dict:
    """The metadata by which trees and encoders know a category index and its number of values."""
    return {"ml_attr": {"type": "nominal", "num_vals": values}}


@dataclass
class CategoryIndex:
    """Fitted indexes of some columns: a table ``(value, index)`` and the number of values of each.

    The tables stay distributed, so a column can have any number of values.
    """

    tables: dict[str, DataFrame]
    sizes: dict[str, int]

    def transform(self, df: DataFrame, cols: Sequence[str], outs: Sequence[str], invalid: str = "error") -> DataFrame:
        """Add the indexes; a null or unknown value fails, loses its row (``skip``) or is one further index (``keep``)."""
        for col, out in zip(cols, outs):
            size = self.sizes[col]
            table = self.tables[col].select(F.col("value").alias("_value"), F.col("index").alias("_index"))
            keyed = df.withColumn("_value", F.col(col).cast("string"))
            joined = lookup_join(keyed, table, "_value", how="inner" if invalid == "skip" else "left").drop("_value")
            index = F.col("_index")
            if invalid == "keep":
                index = F.coalesce(index, F.lit(float(size)))
            elif invalid == "error":
                missing = F.raise_error(F.lit(f"null or unknown category in column {col}, use invalid='skip' or 'keep'"))
                index = F.coalesce(index, missing.cast("double"))
            named = index.alias(out, metadata=_nominal(size + (invalid == "keep")))
            df = joined.select(*[F.col(f"`{c}`") for c in joined.columns if c not in ("_index", out)], named)
        return df


def fit_index(df: DataFrame, cols: Sequence[str]) -> CategoryIndex:
    """Count the values of the columns, as text, and index them: most frequent is 0, ties by text.

    All columns are counted in one pass, combined before the shuffle; the order
    is a range sort over all tasks.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])
    values = df.select(F.inline(pairs)).where(F.col("value").isNotNull())
    ranked = pin(rank_counts(values.groupBy("at", "value").agg(F.count("*").alias("n")), "at"), "categories")
    sizes = dict(ranked.groupBy("at").count().collect())
    tables = {
        c: ranked.where(F.col("at") == i).select("value", (F.col("rank") - 1).cast("double").alias("index"))
        for i, c in enumerate(cols)
    }
    return CategoryIndex(tables, {c: sizes.get(i, 0) for i, c in enumerate(cols)})


def index_strings(df: DataFrame, cols: Sequence[str], outs: Sequence[str], invalid: str = "error") -> DataFrame:
    """Categories as double indexes: most frequent is 0, ties by text, numbers as text.

    Null categories follow ``invalid``: ``error``, ``skip`` the row, or ``keep``
    them as one further index.  One way for any number of values, by a join with
    the distributed table of ranks; the indexes carry the number of values.
    """
    return fit_index(df, cols).transform(df, cols, outs, invalid)


def hashed_index(df: DataFrame, cols: Sequence[str], outs: Sequence[str], buckets: int) -> DataFrame:
    """Categories as one of ``buckets`` indexes by a hash, for columns too wide for a vector of their values; null is a value."""

    def bucket(col: str) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(F.col(col).cast("string"), F.lit("null"))), F.lit(buckets)).cast("double")

    return df.select("*", *[bucket(c).alias(o, metadata=_nominal(buckets)) for c, o in zip(cols, outs)])


def drop_invalid_categories(df: DataFrame, cols: Sequence[str], outs: Sequence[str]) -> DataFrame:
    """Index categories and drop the rows without one."""
    return index_strings(df, cols, outs, invalid="skip")


def index_users(df: DataFrame, name: str = "username", out: str = "userId") -> DataFrame:
    """User names as the surrogate integers a recommender needs, for any number of users."""
    return index_strings(df, [name], [out]).withColumn(out, F.col(out).cast("int"))


def one_hot(df: DataFrame, cols: Sequence[str], outs: Sequence[str], drop_last: bool = True) -> DataFrame:
    """Indexes as sparse 0/1 vectors, the last category being all zeros."""
    encoder = OneHotEncoder(inputCols=list(cols), outputCols=list(outs), dropLast=drop_last)
    return encoder.fit(df).transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """Numbers and vectors joined to one vector; a null fails unless ``invalid`` is ``skip`` or ``keep``."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def encode_categories(train: DataFrame, df: DataFrame, cols: Sequence[str], outs: Sequence[str], buckets: int | None = None) -> tuple[DataFrame, list[str]]:
    """Vectors of the categories of ``train``, added to ``df``, and the names of those that hold anything.

    One column fewer than there are categories: the rarest one and unknown ones
    are all zeros, so no vector repeats the intercept.  ``buckets`` hashes the
    values into that many categories instead of counting them.
    """
    indexes = [f"_{o}_index" for o in outs]
    if buckets:
        df, sizes = hashed_index(df, cols, indexes, buckets), [buckets] * len(cols)
    else:
        fitted = fit_index(train, cols)
        df, sizes = fitted.transform(df, cols, indexes, invalid="keep"), [fitted.sizes[c] for c in cols]
    # A column with a single category says nothing and has no vector.
    useful = [(i, o, n) for i, o, n in zip(indexes, outs, sizes) if n > 1]
    clipped = {i: F.least(F.col(i), F.lit(float(n - 1))).alias(i, metadata=_nominal(n)) for i, _, n in useful}
    df = df.select(*[clipped.get(c, F.col(f"`{c}`")) for c in df.columns if c not in indexes or c in clipped])
    if useful:
        df = one_hot(df, [i for i, _, _ in useful], [o for _, o, _ in useful]).drop(*clipped)
    return df, [o for _, o, _ in useful]


def feature_stages(
    cat_cols: Sequence[str], num_cols: Sequence[str], estimator: Estimator | None = None, invalid: str = "keep"
) -> Pipeline:
    """Indexer, encoder, assembler and the estimator, fitted as one.

    Categories that only occur in scored rows get an index of their own
    (``invalid="keep"``), so hold-out rows never fail.  The ranks of the categories
    stay a distributed table, also in the fitted and in the saved pipeline.
    """
    from plumbline.functions.stages import CategoryIndexer

    indexes = [f"{c}_index" for c in cat_cols]
    vectors = [f"{c}_vector" for c in cat_cols]
    stages = [VectorAssembler(inputCols=[*vectors, *num_cols], outputCol="features")]
    if cat_cols:
        stages = [
            CategoryIndexer(inputCols=list(cat_cols), outputCols=indexes, invalid=invalid),
            OneHotEncoder(inputCols=indexes, outputCols=vectors),
            *stages,
        ]
    return Pipeline(stages=[*stages, estimator] if estimator is not None else stages)
