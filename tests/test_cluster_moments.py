"""Spread and silhouette from cluster moments against Spark's evaluator and plain distances."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions.encoding import assemble
from plumbline.models import cluster_moments as cm
from plumbline.models import clustering
from plumbline.models.metrics import silhouette_score
from plumbline.session import fits_at_once, pin


def moments_of(x, cluster, n, shift):
    x = x - shift
    counts = np.bincount(cluster, minlength=n).astype(float)
    sums = np.array([x[cluster == c].sum(axis=0) for c in range(n)])
    return cm.Moments(shift, counts, sums, np.array([(x[cluster == c] ** 2).sum() for c in range(n)]))


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 25), st.integers(1, 3), st.integers(2, 5), st.integers(0, 10_000))
def test_silhouettes_equal_plain_distances(rows, width, n, seed):
    own = np.random.default_rng(seed)
    x, cluster = own.integers(-4, 5, size=(rows, width)).astype(float), own.integers(0, n, rows)
    got = moments_of(x, cluster, n, np.full(width, 0.5)).silhouettes(x, cluster)
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    for k in range(rows):
        mine = (cluster == cluster[k]) & (np.arange(rows) != k)
        others = [apart[k][cluster == c].mean() for c in set(cluster) - {cluster[k]}]
        if not mine.any() or not others:
            assert got[k] == 0
            continue
        a, b = apart[k][mine].mean(), min(others)
        assert got[k] == pytest.approx((b - a) / max(a, b) if max(a, b) else 0, abs=1e-9)


@pytest.fixture(scope="module")
def points(spark):
    rows = spark.range(500, numPartitions=4).select((F.sin("id") * 5 + F.col("id") % 3 * 9 + 1000).alias("a"), (F.cos(F.col("id") * 2) * 4).alias("b"))
    return pin(assemble(rows, ["a", "b"]).select("features"))


def test_sweep_equals_spark(points):
    sweep = clustering.kmeans_sweep(points, [2, 3, 7])
    for row in sweep.scores.collect():
        model = sweep.models[row["k"]]
        scored = model.transform(points)
        assert row["sse"] == pytest.approx(model.summary.trainingCost, rel=1e-9)
        assert row["silhouette"] == pytest.approx(silhouette_score(scored), abs=1e-9)
        sizes = {r["prediction"]: r["count"] for r in sweep.sizes.where(F.col("k") == row["k"]).collect()}
        assert sizes == {r["prediction"]: r["count"] for r in scored.groupBy("prediction").count().collect()}


def test_two_scans_after_the_fits(spark, points, monkeypatch):
    runs = []
    monkeypatch.setattr(cm, "collected", lambda states: runs.append(states) or collected(states))
    from plumbline.operators.merging import collected

    clustering.kmeans_sweep(points, [2, 3, 4])
    plans = [states._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0] for states in runs]
    assert [p.count("FileScan") for p in plans] == [1, 1] and all("Generate" not in p for p in plans)


def test_sparse_vectors(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.sparse(4, [1], [3.0]),), (Vectors.dense([0.0, 3.0, 0.0, 0.0]),), (Vectors.sparse(4, [2], [9.0]),)]
    sweep = clustering.kmeans_sweep(pin(spark.createDataFrame(rows, ["features"])), [2])
    assert [(r["clusters"], r["sse"]) for r in sweep.scores.orderBy("k").collect()] == [(2, 0.0)]


def test_rows_that_repeat_are_fitted_once_with_their_number(spark):
    rows = spark.range(2400, numPartitions=3).select((F.col("id") % 6 * 10 + F.floor(F.col("id") % 60 / 30)).alias("a"), (F.col("id") % 4).alias("b"))
    points = pin(assemble(rows, ["a", "b"]).select("features"))
    sweep = clustering.kmeans_sweep(points, [2, 3])
    for row in sweep.scores.collect():
        model = sweep.models[row["k"]]
        assert model.summary.predictions.count() == rows.distinct().count() < 2400 / clustering.REPEATS
        scored = model.transform(points)
        assert row["sse"] == pytest.approx(sum(s["n"] * s["d"] for s in spread_of(scored, model)), rel=1e-9)
        assert row["silhouette"] == pytest.approx(silhouette_score(scored), abs=1e-9)
        sizes = {r["prediction"]: r["count"] for r in sweep.sizes.where(F.col("k") == row["k"]).collect()}
        assert sizes == {r["prediction"]: r["count"] for r in scored.groupBy("prediction").count().collect()}
    assert clustering.fit_kmeans(points, 3).summary.trainingCost == pytest.approx(sweep.models[3].summary.trainingCost)


def spread_of(scored, model):
    found = scored.groupBy("features", "prediction").count().collect()
    return [{"n": r["count"], "d": float(((r["features"].toArray() - model.clusterCenters()[r["prediction"]]) ** 2).sum())} for r in found]


def test_different_points_and_weighted_fits_stay_as_they_are(spark, points):
    assert clustering.distinct_points(points) == (points, None)
    empty = spark.createDataFrame(points.limit(0).collect(), points.schema)
    assert clustering.distinct_points(empty)[0].count() == 0
    weighted = pin(spark.range(40).select(F.lit(2.0).alias("w"), (F.col("id") % 2).alias("a")))
    model = clustering.fit_kmeans(assemble(weighted, ["a"]), 2, weightCol="w")
    assert model.summary.predictions.count() == 40


def test_points_are_pinned_in_files_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(clustering, "POINTS_PER_FILE", 100)
    points = assemble(spark.range(250, numPartitions=1), ["id"]).select("features")
    files = clustering.pin_points(points).groupBy(F.input_file_name()).count()
    assert sorted(r["count"] for r in files.collect()) == [50, 100, 100]


def test_fits_side_by_side_are_bounded_by_what_they_cache(spark, points):
    many = fits_at_once(points)
    assert many > 1 and fits_at_once(points, 1000) == many and fits_at_once(points, 1 << 32) == 1
