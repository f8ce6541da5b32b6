"""Repeated passages against every window of every document."""

import random
import re

from helpers import DOCS, ODD_TEXTS, frame, prose, with_clashes
from pyspark.sql import functions as F

from plumbline.llm import substring_dedup
from plumbline.llm.queries import op5_substring_dedup

W = 13


def plain_removal(docs):
    """``[(doc_id, kept words, removed)]`` by the definition."""
    words = [(n, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for n, t in docs]
    least = {}
    for n, ws in words:
        for i in range(len(ws) - W + 1):
            key = tuple(ws[i : i + W])
            least[key] = min(least.get(key, n), n)
    out = []
    for n, ws in words:
        gone = [False] * len(ws)
        for i in range(len(ws) - W + 1):
            if least[tuple(ws[i : i + W])] < n:
                gone[i : i + W] = [True] * W
        out.append((n, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return sorted(out)


def found(df):
    return sorted((r["id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in df.collect())


def passages(n, seed=9):
    own = random.Random(seed)
    texts = prose(n, seed)
    shared = [" ".join(t.split()[: own.randint(11, 40)]) for t in prose(6, seed + 1, 60)]
    for k in range(n):
        for _ in range(own.randint(0, 2)):
            at = own.randint(0, len(texts[k]))
            texts[k] = texts[k][:at] + " " + own.choice(shared) + " " + texts[k][at:]
    return texts + texts[: n // 5]


def test_cover_meets_every_difference():
    d = substring_dedup
    for shift in range(d.PERIOD):
        assert any((a + delta) % d.PERIOD in d.COVER and (a + shift + delta) % d.PERIOD in d.COVER for a in [0] for delta in range(d.PERIOD))


def test_against_every_window(spark):
    texts = [*passages(60), *ODD_TEXTS]
    docs = with_clashes(frame(spark, texts))
    want = plain_removal(list(enumerate(texts)))
    for ranges, size in ((1, 300), (5, 2000), (8, 1 << 22)):
        assert found(substring_dedup.remove_repeats(docs, ranges=ranges, batch_bytes=size)) == want


def test_repeated_ids_and_null_ids(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(5, text, "", "", 0), (5, text, "", "", 0), (None, text, "", "", 0), (9, "x " + text, "", "", 0)], DOCS)
    got = {(r["id"], r["n_removed"]) for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {(5, 0), (None, 30), (9, 30)}
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_clean_keeps_rows_columns_and_untouched_texts(spark):
    texts = [*ODD_TEXTS, *passages(20)]
    docs = with_clashes(frame(spark, texts)).withColumn("deep", F.struct(F.array("doc_id").alias("kept_text")))
    out = substring_dedup.clean(docs)
    assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes
    want = {n: (removed, kept) for n, _, removed, kept in plain_removal(list(enumerate(texts)))}
    for r in out.collect():
        removed, kept = want[r["doc_id"]]
        assert r["text"] == (kept if removed else texts[r["doc_id"]]) and r["deep"]["kept_text"] == [r["doc_id"]]


def test_op5(spark, sf_dir):
    import hashlib

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in op5_substring_dedup(spark, sf_dir).collect())
    assert got == [(n, c, g, hashlib.sha256(t.encode()).hexdigest()) for n, c, g, t in plain_removal(docs)]


def test_texts_do_not_shuffle(spark):
    plan = substring_dedup.remove_repeats(frame(spark, prose(30)))._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        assert "Exchange" not in line or "texts" not in line
