"""K-means that shares its scans, against groups that are known and Spark's own fits."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from plumbline.models import clustering, shared_kmeans


def points(spark, values):
    return spark.createDataFrame([(Vectors.dense(v),) for v in values], ["features"]).repartition(5).cache()


def sorted_centers(model):
    return sorted(tuple(c) for c in model.clusterCenters())


@pytest.fixture
def large(monkeypatch):
    """Every table counts as too large to cache, and Spark's own fit is not called."""
    monkeypatch.setattr(clustering, "CACHED_AT_ONCE", 0)
    monkeypatch.setattr(clustering, "_fit", None)


@pytest.mark.parametrize("repeats", [1, 5])
def test_separated_groups_are_found(spark, large, repeats):
    own = np.random.default_rng(1)
    spots = np.array([[0, 0], [500, 100], [2000, -300]])
    values = np.concatenate([s + own.normal(size=(60, 2)) for s in spots])
    sweep = clustering.kmeans_sweep(points(spark, np.repeat(values, repeats, axis=0)), [2, 3], initSteps=8)
    assert np.allclose(sorted_centers(sweep.models[3]), [values[i : i + 60].mean(axis=0) for i in (0, 60, 120)])
    assert {(r["k"], r["count"]) for r in sweep.sizes.collect() if r["k"] == 3} == {(3, 60 * repeats)}
    score = {r["k"]: r for r in sweep.scores.collect()}
    assert score[3]["sse"] == pytest.approx(repeats * sum(((values[i : i + 60] - values[i : i + 60].mean(axis=0)) ** 2).sum() for i in (0, 60, 120)))
    assert score[2]["sse"] > score[3]["sse"] and score[3]["silhouette"] > 0.99
    assert sweep.models[3].getK() == 3 and sweep.models[3].getFeaturesCol() == "features"


def test_spread_is_near_that_of_spark_and_centers_are_means(spark):
    values = np.random.default_rng(2).normal(size=(4000, 3)) * [1, 30, 1000] + [5, 1e5, -1e6]
    frame = points(spark, values)
    models = shared_kmeans.fit_together(frame, None, [4, 7], "features", 3, maxIter=100)
    for k, model in models.items():
        centers = np.array(model.clusterCenters())
        nearest = ((values[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        assert len(centers) == k and np.allclose(centers, [values[nearest == i].mean(axis=0) for i in range(k)])
        theirs = np.array(clustering.fit_kmeans(frame, k, maxIter=100).clusterCenters())
        costs = [((values[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum() for c in (centers, theirs)]
        assert costs[0] < 1.3 * costs[1]


def test_weights_count_as_rows(spark):
    rows = [(Vectors.dense([0.0]), 1.0), (Vectors.dense([1.0]), 3.0), (Vectors.dense([100.0]), 2.0), (Vectors.dense([104.0]), 2.0)]
    frame = spark.createDataFrame(rows, ["features", "n"])
    models = shared_kmeans.fit_together(frame, "n", [2], "features", 1)
    assert sorted_centers(models[2]) == [(0.75,), (102.0,)]


def test_fewer_distinct_points_than_clusters(spark, large):
    sweep = clustering.kmeans_sweep(points(spark, [[1.0], [1.0], [4.0]]), [5, 2], initSteps=6)
    assert [sorted_centers(m) for m in (sweep.models[5], sweep.models[2])] == [[(1.0,), (4.0,)]] * 2
    one = clustering.kmeans_sweep(points(spark, [[3.0, 2.0]] * 4), [4])
    assert sorted_centers(one.models[4]) == [(3.0, 2.0)]
