"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage works on all that the one before it kept, written as Parquet and read
again, so a lost executor never repeats an earlier stage.  All but the last return
the columns of ``documents``; rows with nulls, empty texts, repeated rows and
further columns pass by the rules of each operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import exact_dedup, packing, simhash, substring_dedup, toxicity
from plumbline.llm.common import table
from plumbline.llm.queries import QUERIES, LlmQuery, tokenizer_file
from plumbline.session import pin


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labels that are not held out."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the longest original, then the smallest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the smallest id."""
    return simhash.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of passages that start in a document with a smaller id."""
    cleaned = substring_dedup.clean(docs)
    if "n_chars" not in cleaned.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.coalesce(F.char_length("text").cast(cleaned.schema["n_chars"].dataType), "n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    packed = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express the score of the first stage; the tests rebuild every stage by its definition.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = {**QUERIES, "pipeline": LlmQuery(run, ORACLE_SQL)}
