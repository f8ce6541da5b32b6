"""Descent, rules of trees, exact shares and sparse rows against plain rebuilds."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from plumbline.functions.encoding import assemble, index_strings
from plumbline.models import descent, estimators, rules
from plumbline.operators import aggregates
from plumbline.operators.splits import exact_stratified_holdout


def bucket(*keys):
    return int(hashlib.md5("|".join(map(str, keys)).encode()).hexdigest()[:8], 16) % 100


@pytest.fixture(scope="module")
def sides(spark):
    rows = [(i, float(np.sin(i) + (i % 2)), float(np.cos(3 * i) - (i % 2) / 2), float(i % 2)) for i in range(400)]
    return assemble(spark.createDataFrame(rows, "id long, a double, b double, label double"), ["a", "b"]).repartition(5).cache()


@pytest.mark.parametrize("pct, averaged", [(100, False), (30, True), (1, False)])
def test_descent_equals_a_plain_loop(sides, pct, averaged):
    model = descent.fit_svm_by_descent(sides, 9, 0.7, 0.02, pct, "id", averaged)
    points = [(r["id"], np.array([r["a"], r["b"]]), 1 if r["label"] else -1) for r in sides.collect()]
    w, kept = np.zeros(2), []
    for t in range(1, 10):
        some = [(x, y) for i, x, y in points if pct == 100 or bucket(i, t) < pct]
        if some:
            down = sum((-y * x for x, y in some if y * (w @ x) < 1), np.zeros(2)) / len(some)
            w = w * (1 - 0.7 / np.sqrt(t) * 0.02) - 0.7 / np.sqrt(t) * down
        kept += [w] if 2 * t > 9 else []
    assert model.coefficients.toArray() == pytest.approx(np.mean(kept, axis=0) if averaged else w, abs=1e-12)
    assert model.intercept == 0


def test_descent_tells_classes_apart_and_its_model_is_saved(sides, tmp_path):
    model = descent.fit_svm_by_descent(sides, 60, key="id")
    right = model.transform(sides).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.6
    model.write().save(str(tmp_path / "svm"))
    again = LinearSVCModel.load(str(tmp_path / "svm"))
    assert again.coefficients == model.coefficients


def test_descent_on_nothing(sides):
    with pytest.raises(ValueError):
        descent.fit_svm_by_descent(sides.where("false"), 2)


@pytest.fixture(scope="module")
def mixed(spark):
    """Numbers and an indexed category with a name that needs quoting."""
    rows = [("abcdefg"[i * i % 7], float(i % 23), 0.1 * i, float((i % 23 > 9) ^ (i * i % 7 in (1, 4)))) for i in range(600)]
    df = index_strings(spark.createDataFrame(rows, "kind string, x double, `y AND z` double, label double"), ["kind"], ["place"])
    return assemble(df, ["place", "x", "y AND z"]).cache()


NAMES = ["place", "x", "y AND z"]


@pytest.mark.parametrize("depth", [0, 1, 5, 9])
def test_rules_of_a_tree_score_alike(spark, mixed, depth):
    model = estimators.fit_decision_tree(mixed, depth)
    leaves = rules.leaf_rules(spark, model, NAMES)
    scored = rules.score_by_rules(model.transform(mixed), leaves, "own")
    assert scored.where("NOT prediction <=> own").count() == 0
    # Each row is taken by exactly one predicate, and by as many rows as the leaf was fitted on.
    for leaf in leaves.collect():
        assert mixed.where(leaf["rule"]).count() == leaf["support"]
    assert sum(r["support"] for r in leaves.collect()) == mixed.count()


def test_rules_of_forests_score_alike(spark, mixed):
    voting = estimators.fit_random_forest(mixed, numTrees=7)
    scored = rules.score_by_rules(voting.transform(mixed), rules.leaf_rules(spark, voting, NAMES), "own")
    assert scored.where("NOT prediction <=> own").count() == 0
    mean = RandomForestRegressor(numTrees=5, seed=1).fit(mixed)
    scored = rules.score_by_rules(mean.transform(mixed), rules.leaf_rules(spark, mean, NAMES), "own")
    assert scored.where("abs(prediction - own) > 1e-12 OR own IS NULL").count() == 0


def test_rules_give_null_for_null(spark, mixed):
    leaves = rules.leaf_rules(spark, estimators.fit_decision_tree(mixed), NAMES)
    rows = spark.createDataFrame([(None, 1.0, 1.0), (0.0, 1.0, 1.0), (0.0, float("nan"), 1.0)], "place double, x double, `y AND z` double")
    known = [r["prediction"] is not None for r in rules.score_by_rules(rows, leaves).collect()]
    assert known == [False, True, True]


def test_nodes_link_to_their_parents(spark, mixed):
    nodes = {r["node"]: r for r in rules.tree_nodes(spark, estimators.fit_decision_tree(mixed, 3)).collect()}
    for n in nodes.values():
        below = [c for c in nodes.values() if c["parent"] == n["node"]]
        assert len(below) == (0 if n["left"] is None else 2)
        assert (n["feature"] is None) == (n["left"] is None)
        assert not below or sum(c["support"] for c in below) == n["support"]
    assert [n["node"] for n in nodes.values() if n["parent"] is None] == [0]
    with pytest.raises(TypeError):
        rules.tree_nodes(spark, None)


def place(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:15], 16)


def test_shares_are_exact(spark):
    df = spark.range(3001).select("id", F.when(F.col("id") % 10 == 3, "rare").when(F.col("id") % 11 == 0, F.lit(None)).otherwise("usual").alias("kind"))
    percents = {"rare": 33, None: 50, "usual": 80}
    training, holdout = exact_stratified_holdout(df, "kind", percents, "id")
    groups = {}
    for r in df.collect():
        groups.setdefault(r["kind"], []).append(r["id"])
    expected = {i for kind, ids in groups.items() for i in sorted(ids, key=place)[: len(ids) * percents[kind] // 100]}
    assert {r["id"] for r in training.collect()} == expected
    assert {r["id"] for r in holdout.repartition(7).collect()} == {r["id"] for r in df.collect()} - expected


def test_shares_of_whole_none_and_unnamed_classes(spark):
    df = spark.range(100).withColumn("kind", (F.col("id") % 4).cast("int"))
    training, holdout = exact_stratified_holdout(df, "kind", {0: 100, 1: 0, 9: 50}, "id")
    assert {r["id"] for r in training.collect()} == set(range(0, 100, 4)) and holdout.count() == 75
    training, holdout = exact_stratified_holdout(df.where("false"), "kind", {0: 50}, "id")
    assert training.count() == holdout.count() == 0


def test_rows_of_one_key_stay_together(spark):
    rows = [("k", key) for key in [None, 1, 2, 3] for _ in range(10)]
    df = spark.createDataFrame(rows, "kind string, key int")
    training, holdout = exact_stratified_holdout(df, "kind", {"k": 65}, "key")
    first = sorted(["null", 1, 2, 3], key=place)[:2]
    assert {"null" if r["key"] is None else r["key"] for r in training.collect()} == set(first)
    assert training.count() == 20 and holdout.count() == 20


def test_sparse_rows_equal_the_pivot(spark):
    rows = [("u", 2, 1), ("u", 7, 4), ("v", 2, 3), ("u", 2, 5), (None, 9, 1), ("w", None, 8), ("v", None, 1), ("x", 9, None)]
    df = spark.createDataFrame(rows, "user string, item int, n int")
    sparse, index = aggregates.interaction_rows(df, "user", "item", "n")
    at = {r["index"]: int(r["value"]) for r in index.tables["item"].collect()}
    wide = aggregates.interaction_matrix(df, "user", "item", "n", [2, 7, 9])
    # The pivot cannot tell a sum of nulls from a missing pair; the rows can.
    for r in wide.join(sparse.withColumnRenamed("user", "who"), F.col("user").eqNullSafe(F.col("who"))).collect():
        own = {at[i]: v for i, v in zip(r["items"], r["values"])}
        assert r["items"] == sorted(r["items"]) and {k: own.get(k) for k in (2, 7, 9)} == {k: r[str(k)] for k in (2, 7, 9)}
    lists = {r["user"]: len(r["items"]) for r in sparse.collect()}
    assert lists == {"u": 2, "v": 1, None: 1, "w": 0, "x": 1}
    assert aggregates.interaction_rows(df.where("false"), "user", "item", "n")[0].count() == 0


def test_fit_facts_see_wrong_weights(spark, sides):
    from plumbline.catalog.facts import fit_facts
    from plumbline.models import gram, metrics, tuning
    from plumbline.plans.tabular import TunedReport
    from pyspark.ml.regression import LinearRegression

    points = sides.select("features", (F.col("a") * 3 + F.col("b") + F.col("label")).alias("label"), F.lit(True).alias("is_training"))
    est = LinearRegression(regParam=0.2, elasticNetParam=0.5)
    fitted = est.fit(points)
    right = fitted.coefficients.toArray()
    for intercept, weights, sound in ((0, 1, True), (0.05, 1, False), (0, np.array([1.02, 1]), False)):
        model = tuning._linear_model(spark, est, gram.Fit(0.2, 0.5, fitted.intercept + intercept, right * weights))
        scored = model.transform(points)
        report = TunedReport(model, metrics.regression_metrics(scored, by=["is_training"]), None, None, scored)
        assert [r["fit_is_sound"] for r in fit_facts(report).collect()] == [sound]
