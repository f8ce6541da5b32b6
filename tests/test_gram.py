"""Elastic-net paths from one pass against Spark's solver, point by point."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import functions as F

from plumbline.functions.encoding import assemble
from plumbline.models import gram, tuning
from plumbline.session import pin

GRID = ([0.0, 0.01, 0.1, 0.5, 2.0], [0.0, 0.1, 0.5, 1.0])


@pytest.fixture(scope="module")
def points(spark):
    """Correlated numbers, one that never varies, and a label with noise."""
    x = F.sin(F.col("id") * 0.7) * 3
    rows = spark.range(400, numPartitions=5).select(
        x.alias("a"),
        (x + F.cos(F.col("id") * 1.3)).alias("b"),
        (F.col("id") % 5 == 0).cast("double").alias("c"),
        F.lit(4.0).alias("same"),
        (F.cos(F.col("id") * 2.1) * 1e-3).alias("tiny"),
        (x * 2 - F.cos(F.col("id") * 1.3) + F.sin(F.col("id") * 11.0) + 100).alias("label"),
    )
    return pin(assemble(rows, ["a", "b", "c", "same", "tiny"]).select("features", "label"))


def test_every_point_equals_spark(spark, points):
    est = LinearRegression(tol=1e-14, maxIter=5000)
    split = F.rand(7) < 0.7
    pairs = [(reg, enp) for reg in GRID[0] for enp in GRID[1]]
    fits, metrics, _ = tuning.linear_path(points, pairs, est, "r2", split)
    parts = pin(points.select("*", split.alias("fits")))
    for (reg, enp), fit, metric in zip(pairs, fits, metrics):
        model = est.copy({est.regParam: reg, est.elasticNetParam: enp}).fit(parts.where("fits"))
        assert np.allclose(model.coefficients.toArray(), fit.weights, atol=1e-6 if reg or enp else 1e-5), (reg, enp)
        assert model.intercept == pytest.approx(fit.intercept, abs=1e-6)
        assert RegressionEvaluator(metricName="r2").evaluate(model.transform(parts.where("NOT fits"))) == pytest.approx(metric, abs=1e-7)


@pytest.mark.parametrize("metric", gram.METRICS)
def test_search_equals_the_search_of_spark(points, metric):
    est = LinearRegression(tol=1e-12, maxIter=1000)
    search = tuning.tuner(est, tuning.param_grid(est, [0.01, 0.5], [0.1, 1.0]), RegressionEvaluator(metricName=metric), seed=3)
    ours, theirs = tuning.tune_linear(points, search), search.fit(points)
    assert ours.validationMetrics == pytest.approx(theirs.validationMetrics, rel=1e-6)
    assert np.allclose(ours.bestModel.coefficients.toArray(), theirs.bestModel.coefficients.toArray(), atol=1e-6)
    assert ours.bestModel.getRegParam() == theirs.bestModel.getRegParam() and ours.bestModel.getElasticNetParam() == theirs.bestModel.getElasticNetParam()


def test_model_scores_saves_and_loads(spark, points, tmp_path):
    est = LinearRegression()
    model = tuning.tune(points, est, tuning.param_grid(est, [0.1], [0.5])).bestModel
    model.write().overwrite().save(str(tmp_path / "m"))
    again = LinearRegressionModel.load(str(tmp_path / "m"))
    a, b = (sorted(r["prediction"] for r in m.transform(points).collect()) for m in (model, again))
    assert a == b and len(a) == 400
    assert again.getRegParam() == 0.1 and again.getElasticNetParam() == 0.5


def test_one_scan_for_the_whole_grid(points):
    plan = gram.gram_states(points, F.rand(1) < 0.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Generate" not in plan and plan.count("MapInArrow") == 1


def test_only_what_products_determine_takes_the_short_way(points):
    def short(est, evaluator=None, grid=None):
        return tuning._from_products(points, tuning.tuner(est, grid or tuning.param_grid(est, [0.1], [0.5]), evaluator))

    assert short(LinearRegression()) and short(LinearRegression(), RegressionEvaluator(metricName="rmse"))
    assert not short(LinearRegression(), RegressionEvaluator(metricName="mae"))
    assert not short(LinearRegression(fitIntercept=False)) and not short(LinearRegression(standardization=False))
    assert not short(LinearRegression(loss="huber", regParam=0.1)) and not short(LinearRegression(weightCol="w"))
    est = LinearRegression()
    assert not short(est, grid=[{est.regParam: 0.1, est.maxIter: 5}])


def test_empty_split_is_an_error(points):
    est = LinearRegression()
    with pytest.raises(ValueError, match="no rows"):
        tuning.linear_path(points, [(0.1, 0.5)], est, "r2", F.lit(True))


def test_constant_label_and_blocks(spark, points, monkeypatch):
    flat = pin(points.select("features", F.lit(3.5).alias("label")))
    fits, _, _ = tuning.linear_path(flat, [(0.1, 0.5)], LinearRegression(), "rmse", F.rand(1) < 0.5)
    assert fits[0].intercept == pytest.approx(3.5) and not fits[0].weights.any()
    whole = gram.grams(points, F.lit(0))[0]
    monkeypatch.setattr(gram, "BLOCK", 2)
    monkeypatch.setattr(gram, "BATCH", 50)
    parts = gram.grams(points, F.lit(0))[0]
    assert np.allclose(whole.products, parts.products) and np.allclose(whole.mean, parts.mean) and whole.n == parts.n == 400


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 40), st.integers(1, 6), st.integers(1, 39))
def test_grams_merge(seed, rows, width, cut):
    own = np.random.default_rng(seed)
    z = own.normal(size=(rows, width + 1)) + own.normal(size=width + 1) * 1e6
    cut = min(cut, rows - 1)

    def of(part):
        off = part - part.mean(axis=0)
        return gram.Gram(len(part), part.mean(axis=0), off.T @ off)

    one, two = of(z), of(z[:cut]) + of(z[cut:])
    assert np.allclose(one.mean, two.mean) and np.allclose(one.products, two.products, rtol=1e-6, atol=1e-4)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([0.01, 0.3, 2.0]), st.sampled_from([0.1, 0.5, 1.0]))
def test_solutions_meet_the_conditions_of_the_minimum(seed, reg, enp):
    own = np.random.default_rng(seed)
    x = own.normal(size=(60, 8)) @ own.normal(size=(8, 8))
    z = np.hstack([x, (x @ own.normal(size=8) + own.normal(size=60))[:, None]])
    off = z - z.mean(axis=0)
    problem = gram.Standardised(gram.Gram(60, z.mean(axis=0), off.T @ off))
    w = problem.solve(reg, enp, np.zeros(8))
    pull, ridge = enp * reg / problem.label_spread, (1 - enp) * reg / problem.label_spread
    slope = problem.outer - problem.inner @ w - ridge * w
    assert np.allclose(slope[w != 0], pull * np.sign(w[w != 0]), atol=1e-9) and (np.abs(slope[w == 0]) <= pull + 1e-9).all()
