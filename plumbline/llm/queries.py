"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    alignment,
    bpe_lexicon,
    chat_format,
    exact_dedup,
    fingerprints,
    packing,
    quality,
    simhash,
    substring_dedup,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from plumbline.llm.common import id_and_text, table
from plumbline.session import pin, scratch_path


@dataclass(frozen=True)
class LlmQuery:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer file is installed; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")
    lexicon = bpe_lexicon.build_lexicon(id_and_text(docs), path)
    decoded = bpe_lexicon.round_trip(docs, path, lexicon)
    decimals = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimals.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), out)
    return token_files.read_token_files(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.col("kept_text").cast("binary"), 256)
    return cleaned.select(F.col("id").alias("doc_id"), "n_words", "n_removed", digest.alias("kept_sha256"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.length_histogram(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return token_counts.with_suffix_sums(counted)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(
        """SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')
        AS t(conv_id, turn, role, text)"""
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    written = pin(chat_format.format_chats(turns), "chats").withColumn("turns", chat_format.parse(F.col("formatted")))
    read = written.withColumn("masked", chat_format.under_loss(F.col("formatted"), F.col("loss")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["said"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '</s>', '<\/s>'), '<s>', '<\s>'),
    '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>') AS written
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(3 + length(role) + 1 + length(written) + 4 + CASE WHEN role IN ('user', 'system') THEN 15 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.with_statistics(table(spark, sf_dir, "documents"))
    model = quality.fit(stats, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return quality.score(stats, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, LlmQuery] = {
    "op1_simhash_dedup": LlmQuery(op1_simhash_dedup),
    "op2_bpe_lexicon": LlmQuery(op2_bpe_lexicon),
    "op3_toxicity": LlmQuery(op3_toxicity),
    "op4_token_files": LlmQuery(op4_token_files),
    "op5_substring_dedup": LlmQuery(op5_substring_dedup),
    "op6_document_fingerprints": LlmQuery(op6_document_fingerprints),
    "op7_token_counts": LlmQuery(op7_token_counts),
    "op8_exact_dedup": LlmQuery(op8_exact_dedup, OP8_SQL),
    "op9_best_fit_packing": LlmQuery(op9_best_fit_packing),
    "op10_chat_formatting": LlmQuery(op10_chat_formatting, OP10_SQL),
    "op11_embedding_whitening": LlmQuery(op11_embedding_whitening),
    "op12_quality_classifier": LlmQuery(op12_quality_classifier),
    "op13_tokenizer_alignment": LlmQuery(op13_tokenizer_alignment),
}
