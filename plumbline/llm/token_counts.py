"""Exact length histogram: suffix sums answer totals, quantiles and truncated totals for every context limit.

Documents are counted by encoded length, batch by batch, before anything
shuffles; the histogram has one row per distinct length.  Suffix sums run inside
blocks of lengths and are carried over the few block totals, so no task gets the
whole histogram.

Defined cases: a null text counts as empty (length 0); repeated rows count each;
an empty table gives an empty histogram and totals of zero; columns other than
the text never take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import id_and_text
from plumbline.llm.tokens import lengths
from plumbline.session import pin

BLOCK = 64  # lengths whose sums run in one window


def length_histogram(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(n_tokens, docs)`` for each length that occurs, by the tokenizer file ``path``."""
    return lengths(id_and_text(docs, id_col, text_col), path).groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with, for each length: ``docs_from`` and ``tokens_from`` (of this length or longer), ``docs_upto`` and
    ``tokens_upto`` (of this length or shorter) and ``truncated_total`` (tokens left when each document is cut to this length)."""
    # Written, as it is read twice and small against the texts it counts.
    rows = pin(histogram, "length-histogram").select("n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("tokens"), F.floor(F.col("n_tokens") / BLOCK).alias("block"))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = blocks.select(
        F.col("block").alias("of"),
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    here = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    summed = rows.withColumn("docs_from", F.sum("docs").over(here)).withColumn("tokens_from", F.sum("tokens").over(here))
    out = summed.join(after, F.col("block") == F.col("of"))
    docs_from, tokens_from = F.col("docs_from") + F.col("later_docs"), F.col("tokens_from") + F.col("later_tokens")
    return out.select(
        "n_tokens",
        "docs",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        (F.col("all_docs") - docs_from + F.col("docs")).alias("docs_upto"),
        (F.col("all_tokens") - tokens_from + F.col("tokens")).alias("tokens_upto"),
        (F.col("all_tokens") - tokens_from + docs_from * F.col("n_tokens")).alias("truncated_total"),
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``(limit, docs_cut, tokens_kept, tokens_lost)`` for any context limits, from :func:`with_suffix_sums`."""
    wanted = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "limit long")
    longer, short = F.col("n_tokens") > F.col("limit"), F.col("n_tokens") <= F.col("limit")
    tokens = F.col("n_tokens") * F.col("docs")
    # One row per limit is broadcast; the histogram is read once.
    pairs = sums.select("n_tokens", "docs", F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("limit")) if limits else None
    if pairs is None:
        return wanted.selectExpr("limit", "0L AS docs_cut", "0L AS tokens_kept", "0L AS tokens_lost")
    cut = pairs.groupBy(F.col("limit").cast("long").alias("limit")).agg(
        F.sum(F.when(longer, F.col("docs")).otherwise(0)).alias("docs_cut"),
        F.sum(F.when(short, tokens).otherwise(F.col("limit") * F.col("docs"))).alias("tokens_kept"),
        F.sum(F.when(longer, tokens - F.col("limit") * F.col("docs")).otherwise(0)).alias("tokens_lost"),
    )
    return wanted.join(cut, "limit", "left").na.fill(0)


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``(share, n_tokens)``: the smallest length that at least this share of the documents does not exceed."""
    total = F.col("docs_upto") + F.col("docs_from") - F.col("docs")
    rows = [sums.where(F.col("docs_upto") >= F.lit(float(q)) * total).agg(F.lit(float(q)).alias("share"), F.min("n_tokens").alias("n_tokens")) for q in shares]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
