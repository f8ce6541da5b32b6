"""Quality scores: statistics, normal equations and curve against plain rebuilds, and labels never seen."""

import zlib

import numpy as np
import pytest
from helpers import DOCS, ODD_TEXTS, frame, prose, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import quality
from plumbline.llm.queries import op12_quality_classifier

LABELS = "doc_id long, quality int, toxic int"


def plain_shares(text):
    """Some of the statistics, sign by sign."""
    kinds = [quality.SIGN if ord(c) > 0xFFFF else quality._kind(c) for c in text]
    pairs = list(zip([quality.LINE, *kinds], kinds))
    words, n = text.split(), max(1, len(text))
    letters = sum(k in (quality.LOWER, quality.UPPER) for k in kinds)
    root = lambda part, of: min(1.0, part / max(of, 1)) ** 0.5
    return {
        "length": np.log1p(len(text)),
        "words": np.log1p(len(words)),
        "signs": root(kinds.count(quality.SIGN), n),
        "stops": root(kinds.count(quality.STOP), n),
        "upper after upper": root(sum(p == (quality.UPPER, quality.UPPER) for p in pairs), letters),
        "sign after sign": root(sum(p == (quality.SIGN, quality.SIGN) for p in pairs), n),
        "lone signs": root(sum(p[0] in (quality.SPACE, quality.LINE) and p[1] == quality.SIGN for p in pairs), len(words)),
        "stopped lines": root(sum(p == (quality.STOP, quality.LINE) for p in pairs), len([x for x in text.split("\n") if x])),
        "same word again": root(sum(a == b for a, b in zip(words, words[1:])), len(words)),
        "distinct words": root(len(set(words)), len(words)),
    }


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \nAB.,#|!1")), max_size=30)), max_size=6))
def test_statistics_of_texts_taken_together(texts):
    found = quality.statistics(texts)
    assert found.shape == (len(texts), len(quality.NAMES))
    for row, text in zip(found, texts):
        for name, value in plain_shares(text or "").items():
            assert row[quality.NAMES.index(name)] == pytest.approx(value), (name, text)


def test_statistics_of_odd_texts_are_finite():
    assert np.isfinite(quality.statistics(ODD_TEXTS)).all()
    assert (quality.statistics([None])[0] == quality.statistics([""])[0]).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.floats(0, 1)), min_size=1, max_size=25))
def test_isotonic_curve(rows):
    n = np.array([m for m, _ in rows], float)
    positive = np.floor([m * p for m, p in rows])
    at, share = quality.isotonic(np.arange(len(rows), dtype=float), n, positive)
    assert (np.diff(share) > 0).all() and (np.diff(at) > 0).all()
    # The greatest of all least averages: the definition of the isotonic fit.
    rates = [max(min(positive[i : j + 1].sum() / n[i : j + 1].sum() for j in range(k, len(n))) for i in range(k + 1)) for k in range(len(n))]
    assert np.allclose(sorted(set(np.round(rates, 12))), np.round(share, 12))


def junk(k):
    return " ".join(["again"] * 40) if k % 2 else " ".join(f"w{k}### $$$ x|{j}" for j in range(30))


def test_model_equals_a_plain_rebuild(spark, monkeypatch):
    monkeypatch.setattr(quality, "FAN_IN", 2)
    texts = [*prose(160), *map(junk, range(60))]
    docs = frame(spark, texts, parts=9)
    labels = spark.createDataFrame([(k, int(k < 160), 0) for k in range(220)], LABELS)
    stats = quality.with_statistics(docs)
    model = quality.fit(stats, labels)
    used = [k for k in range(220) if zlib.crc32(str(k).encode()) % 4 != 2]
    s = np.concatenate([quality.statistics([texts[k]]) for k in used])
    y = np.array([float(k < 160) for k in used])
    spread = s.std(axis=0)
    fourier = quality.Fourier(s.mean(axis=0), np.where(spread > 1e-6, spread, 1.0))
    z = fourier.features(s)
    assert np.allclose(fourier.mean, model.fourier.mean) and np.allclose(fourier.scale, model.fourier.scale)
    penalty = np.full(z.shape[1], model.penalty)
    penalty[0] = 0
    weights = np.linalg.solve(z.T @ z + np.diag(penalty + 1e-9), z.T @ y)
    assert np.allclose(z @ weights, z @ model.weights, atol=1e-4)
    grams = quality.normal_equations(quality._training_rows(stats, labels), model.fourier)
    side = np.hstack([model.fourier.features(s), y[:, None]])
    assert len(grams) == quality.FOLDS and np.allclose(sum(grams), side.T @ side)
    assert model.penalty in quality.PENALTIES
    scores = {r["doc_id"]: r["score"] for r in quality.score(stats, model).collect()}
    assert np.allclose([scores[k] for k in used], np.interp(z @ model.weights, *model.steps), atol=1e-6)
    assert min(scores[k] for k in range(160)) > max(scores[k] for k in range(160, 220))


def test_kernel_is_close_to_gaussian():
    own = np.random.default_rng(3)
    fourier = quality.Fourier(np.zeros(len(quality.NAMES)), np.ones(len(quality.NAMES)))
    s = own.normal(size=(40, len(quality.NAMES)))
    z = fourier.features(s)[:, 1:]
    apart = ((s[:, None] - s[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * quality.WIDTH**2))).max() < 0.25


def test_held_out_labels_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = quality.with_statistics(docs.drop("lang", "source"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    one, two = (dict(map(tuple, quality.score(stats, quality.fit(stats, x)).collect())) for x in (labels, turned))
    assert one == two


def test_query_on_rows_it_did_not_learn_from(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = op12_quality_classifier(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 800 and sum(p == y for p, y in held) > 0.97 * len(held)


def test_odd_rows_and_labels(spark):
    texts = [*ODD_TEXTS, *prose(60), *map(junk, range(40))]
    docs = with_clashes(frame(spark, texts, parts=4)).unionByName(with_clashes(spark.createDataFrame([(None, "to be", "", "", 5), (3, " ", "", "", 1)], DOCS)))
    labels = spark.createDataFrame([(k, int(k < 81), 0) for k in range(22, 122)] + [(None, 1, 0), (30, None, 0), (31, 0, 0), (999, 0, 0)], LABELS)
    stats = quality.with_statistics(docs)
    scores = quality.score(stats, quality.fit(stats, labels)).collect()
    assert len(scores) == len(texts) + 2 and all(0 <= r["score"] <= 1 for r in scores)
    by_id = {}
    for r in scores:
        by_id.setdefault(r["doc_id"], []).append(r["score"])
    assert len(by_id[3]) == 2 and by_id[0] == by_id[1]  # null and empty alike


@pytest.mark.parametrize("labels,share", [([], 0.0), ([(1, 1, 0)], 1.0), ([(1, 0, 0), (3, 0, 0)], 0.0), ([(1, None, 0)], 0.0)])
def test_labels_of_one_kind(spark, labels, share):
    stats = quality.with_statistics(frame(spark, ["a b", None, "c"]))
    model = quality.fit(stats, spark.createDataFrame(labels, LABELS))
    assert [r["score"] for r in quality.score(stats, model).collect()] == [share] * 3


def test_empty_table(spark):
    stats = quality.with_statistics(spark.createDataFrame([], DOCS))
    assert quality.score(stats, quality.fit(stats, spark.createDataFrame([(1, 1, 0), (3, 0, 0)], LABELS))).collect() == []
