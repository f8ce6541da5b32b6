"""The whole pipeline against its stages rebuilt by their definitions."""

import corpus_pipeline
from helpers import CLASHING, with_clashes
from test_exact_and_chat import plain_decisions
from test_simhash import plain_components, plain_fingerprint
from test_substring_dedup import plain_removal
from test_token_operators import check_packing

from plumbline.llm import toxicity


def rebuilt(spark, docs, sf_dir):
    """``{doc_id: text}`` that reaches the packing, by the definitions; only the fitted model is shared."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select("doc_id", "text"), model).collect()
    left = [(r["doc_id"], r["text"]) for r in scored if r["score"] < toxicity.THRESHOLD]
    kept = {k for _, k, *_ in plain_decisions(left)}
    left = sorted(d for d in left if d[0] in kept)
    groups = plain_components([(n, plain_fingerprint(t)) for n, t in left])
    left = [d for d, g in zip(left, groups) if d[0] == g]
    texts = dict(left)
    return {n: (text if removed else texts[n]) for n, _, removed, text in plain_removal(left)}


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = rebuilt(spark, docs, sf_dir)
    assert 0 < len(want) < docs.count()
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(want)
    sequences, total = check_packing(rows, want)
    assert sequences <= total / 1024 + 2


def test_stages_keep_the_columns(spark, sf_dir):
    docs = with_clashes(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert {r[c] for r in out.select(*CLASHING).distinct().collect() for c in CLASHING} <= {"x"}


def test_stages_on_nothing_and_on_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(0).unionByName(spark.createDataFrame([(None, None, None, None, None), (1, "", None, "s", 0), (1, "", None, "s", 0), (2, "a" * 40_000, "en", None, None)], docs.schema))
    for rows in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, sf_dir)
            rows.count()
