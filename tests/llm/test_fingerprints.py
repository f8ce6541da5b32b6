"""Sketches against plain sets of paragraphs."""

import hashlib
import re

import pytest
from helpers import DOCS, ODD_TEXTS, frame, prose, with_clashes
from pyspark.sql import functions as F

from plumbline.llm import fingerprints
from plumbline.llm.queries import op6_document_fingerprints


def paragraphs(text):
    out = set()
    for line in (text or "").split("\n"):
        first, rest = 32, line
        while rest:
            size = first if len(rest) > first else len(rest)
            cut = rest.find(" ", size)
            cut = len(rest) if cut < 0 else cut
            out.add(rest[:cut])
            rest, first = rest[cut:], 96
    return out


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(docs):
    ordered = sorted(docs, key=lambda d: -d[0])
    out = {}
    for k, (n, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[n] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, following))
    return out


def compare(rows, docs):
    want = expected(docs)
    assert sorted(r["doc_id"] for r in rows) == sorted(want)
    texts, prints = dict(docs), {}
    for r in rows:
        n_chars, sha, edited, following = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n_chars, sha)
        assert r["near_edited"] == pytest.approx(edited) and r["near_next"] == pytest.approx(following), texts[r["doc_id"]]
        prints.setdefault(texts[r["doc_id"]] or "", set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_op6(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    compare(op6_document_fingerprints(spark, sf_dir).collect(), docs)


def test_odd_texts_and_copies(spark):
    texts = [*ODD_TEXTS, *prose(15), *["one\ntwo\nthree"] * 3]
    docs = [(17 * k - 40, t) for k, t in enumerate(texts)]
    compare(fingerprints.fingerprints(with_clashes(frame(spark, texts, -40, 17))).collect(), docs)


@pytest.mark.parametrize("texts", [[], ["only\none"], ["a", "b"]])
def test_few_rows(spark, texts):
    compare(fingerprints.fingerprints(frame(spark, texts, 5)).collect(), [(5 + k, t) for k, t in enumerate(texts)])


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a\nb", "", "", 0), (1, "a\nb", "", "", 0), (None, "c", "", "", 0), (2, "d", "", "", 0)], DOCS)
    rows = fingerprints.fingerprints(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["near_next"]) for r in rows) == [(False, 1, 0.0), (False, 1, 1.0), (False, 2, 0.0), (True, None, 0.0)]


@pytest.mark.parametrize(
    "number", ["IF(id = 1999, 1000000000000, id)", "CAST(NULL AS LONG)", "IF(id < 100, id * id, 7)", "IF(id % 2 = 0, NULL, 9223372036854775807 - id * id * id)"]
)
def test_groups_are_even_and_in_order_however_ids_lie(spark, number):
    from pyspark.sql import Window

    docs = spark.range(0, 2000, 1, 5).selectExpr(f"{number} AS doc_id", "concat('text ', id) AS text")
    got = fingerprints._next_texts(docs).select("part", "doc_id", "text", "next_text").collect()
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    ordered = [r["text"] for r in docs.withColumn("k", F.row_number().over(order)).orderBy("k").collect()]
    assert {(r["text"], r["next_text"]) for r in got} == set(zip(ordered, [*ordered[1:], ordered[0]])) and len(got) == 2000
    sizes = {}
    for r in got:
        sizes[r["part"]] = sizes.get(r["part"], 0) + 1
    assert max(sizes.values()) < 4 * 2000 / (4 * fingerprints.shuffle_partitions(spark))


def test_a_failed_size_is_tried_again_larger(spark, monkeypatch):
    texts = [*prose(12, words=200)]
    monkeypatch.setattr(fingerprints, "ROUNDS", 2)  # too few to peel much at the first sizes
    monkeypatch.setattr(fingerprints, "ATTEMPTS", 12)
    sizes = []
    once = fingerprints.differing
    monkeypatch.setattr(fingerprints, "differing", lambda pairs, attempt: sizes.append(attempt) or once(pairs, attempt))
    compare(fingerprints.fingerprints(frame(spark, texts)).collect(), list(enumerate(texts)))
    assert max(sizes) > 0


def test_no_python_and_no_shuffle_of_cells(spark):
    rows = [(0, k, 0, [k, 2 * k + 1], [k, 5]) for k in range(20)]
    pairs = spark.createDataFrame(rows, "part int, row long, pair int, ours array<long>, theirs array<long>")
    plan = fingerprints.differing(pairs.repartition(4, "part"), 0)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") <= 2


def test_paragraphs_end_at_lines_and_spaces(spark):
    text = "x" * 40 + " " + "word " * 60 + "\n\nsecond line\n"
    row = spark.createDataFrame([(text,)], "t string").select(F.regexp_extract_all("t", F.lit(fingerprints.PARAGRAPH), 0).alias("p")).first()
    assert set(row["p"]) == paragraphs(text) and "".join(row["p"]) == re.sub("\n", "", text)
