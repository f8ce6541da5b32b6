import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from plumbline.catalog import inputs as src
from plumbline.functions.encoding import assemble
from plumbline.models import clustering, estimators, metrics, recommend, tuning
from plumbline.operators import aggregates, joins, splits, topk
from plumbline.plans import recommenders, tabular


@pytest.fixture(scope="module")
def blobs(spark):
    """Three well separated groups of points."""
    rows = [(float(10 * (i % 3)) + (i % 7) / 10, float(5 * (i % 3)) - (i % 5) / 10) for i in range(300)]
    return assemble(spark.createDataFrame(rows, "x double, y double"), ["x", "y"]).select("features").repartition(4).cache()


def test_accuracy_and_rates(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (1, 2), (2, 1)]
    pred = spark.createDataFrame([(float(a), float(b)) for a, b in rows], "label double, prediction double")
    assert metrics.accuracy(pred).first()["accuracy"] == pytest.approx(0.5)
    rates = {r["label"]: r for r in metrics.rates_by_label(pred).collect()}
    assert rates[1.0]["true_positive_rate"] == pytest.approx(2 / 3)
    assert rates[1.0]["false_positive_rate"] == pytest.approx(2 / 3)
    assert rates[2.0]["true_positive_rate"] == 0 and rates[2.0]["false_positive_rate"] == pytest.approx(1 / 5)
    assert rates[0.0]["false_positive_rate"] == 0
    likelihood = metrics.positive_likelihood(pred).first()["likelihood"]
    assert likelihood == pytest.approx(1.0)


def test_rates_equal_spark_summary(spark, sf_dir):
    df = assemble(src.table(spark, sf_dir, "part"), ["p_partkey", "p_retailprice"])
    df = df.select("features", (F.col("p_size") % 2).cast("double").alias("label"))
    model = LogisticRegression(maxIter=5).fit(df)
    summary = model.evaluate(df)
    rates = metrics.rates_by_label(model.transform(df)).orderBy("label").collect()
    assert [r["true_positive_rate"] for r in rates] == pytest.approx(list(summary.truePositiveRateByLabel))
    assert [r["false_positive_rate"] for r in rates] == pytest.approx(list(summary.falsePositiveRateByLabel))


def test_no_rows_give_null_accuracy(spark):
    empty = spark.createDataFrame([], "label double, prediction double")
    assert tuple(metrics.accuracy(empty).first()) == (0, None)


def test_regression_metrics_equal_spark(spark):
    rows = [(float(i), float(i) + (-1) ** i * 0.5) for i in range(20)]
    df = assemble(spark.createDataFrame(rows, "x double, label double"), ["x"])
    model = estimators.fit_linear_regression(df)
    ours = metrics.regression_metrics(model.transform(df)).first()
    assert ours["r2"] == pytest.approx(model.summary.r2)
    assert ours["rmse"] == pytest.approx(model.summary.rootMeanSquaredError)


def test_correlation_null_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 6.5), (4.0, 7.0), (5.0, None)], "a double, b double")
    dropped = aggregates.label_correlations(df, "a", ["b"]).first()["correlation"]
    zeroed = aggregates.label_correlations(df, "a", ["b"], null_as_zero=True).first()["correlation"]
    assert dropped == pytest.approx(df.dropna().corr("a", "b"))
    assert zeroed == pytest.approx(df.fillna(0).corr("a", "b"))


def test_pivot_null_and_order(spark):
    df = spark.createDataFrame([("u", 2, 1), ("u", 2, 4), ("v", 1, 3)], "user string, item int, n int")
    wide = aggregates.interaction_matrix(df, "user", "item", "n")
    assert wide.columns == ["user", "1", "2"]
    assert {tuple(r) for r in wide.collect()} == {("u", None, 5), ("v", 3, None)}


def test_key_holdout_does_not_move(spark):
    df = spark.range(1000).withColumn("name", F.concat(F.lit("n"), "id"))
    for key in ["id", "name", ["id", "name"], None]:
        train, test = splits.key_holdout(df, key, 80)
        again, _ = splits.key_holdout(df.repartition(13), key, 80)
        ids = lambda d: {r["id"] for r in d.collect()}
        assert ids(train) == ids(again) and not ids(train) & ids(test)
        assert len(ids(train)) + len(ids(test)) == 1000 and 700 < len(ids(train)) < 900


def test_holdout_of_the_largest_keys(spark):
    df = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (0,)], "id long")
    train, test = splits.key_holdout(df, "id", 50)
    assert train.count() + test.count() == 3


def test_random_holdout_is_repeatable(spark, sf_dir):
    df = src.table(spark, sf_dir, "orders").select("o_orderkey")
    first, second = (splits.random_holdout(df, (0.9, 0.1), seed=3)[1].collect() for _ in range(2))
    assert first == second and 0.05 * df.count() < len(first) < 0.16 * df.count()


def test_kmeans_finds_the_groups(spark, blobs):
    sweep = clustering.kmeans_sweep(blobs, [2, 3, 4])
    scores = {r["k"]: r for r in sweep.scores.collect()}
    assert scores[2]["sse"] > scores[3]["sse"] > scores[4]["sse"]
    assert max(scores, key=lambda k: scores[k]["silhouette"]) == 3
    sizes = {}
    for r in sweep.sizes.collect():
        sizes.setdefault(r["k"], []).append(r["count"])
    assert all(sum(s) == 300 for s in sizes.values()) and sorted(sizes[3]) == [100, 100, 100]
    assert sweep.centers.where("k = 4").count() == 4


def test_assignment_sse_equals_training_cost(spark, blobs):
    model = clustering.fit_kmeans(blobs, 3)
    ours = metrics.assignment_sse(model.transform(blobs)).first()["sse"]
    assert ours == pytest.approx(clustering.clustering_sse(blobs, model).first()["sse"], rel=1e-6)


def test_more_clusters_than_points(spark):
    df = assemble(spark.createDataFrame([(1.0,), (1.0,), (9.0,)], "x double"), ["x"])
    assert clustering.cluster_centers(df, clustering.fit_kmeans(df, 5)).count() == 2


def test_tuning_picks_the_best_point(spark):
    rows = [(float(i % 17), float(i % 5), 3.0 * (i % 17) + (i % 5) + (i % 3)) for i in range(400)]
    df = assemble(spark.createDataFrame(rows, "a double, b double, label double"), ["a", "b"])
    est = LinearRegression()
    grid = tuning.param_grid(est, *tuning.PRICE_GRID)
    assert len(grid) == 9
    assert len(tuning.param_grid(est, *tuning.ACTIVITY_GRID)) == 15
    assert len(tuning.param_grid(LogisticRegression(), *tuning.LAPSE_GRID)) == 18
    tuned = tuning.tune(df, est, grid)
    scores = tuning.validation_scores(df, tuned).collect()
    best = max(scores, key=lambda r: r["metric"])
    assert best["best"] and sum(r["best"] for r in scores) == 1
    chosen = {r["param"]: r["value"] for r in tuning.best_params(df, tuned).collect()}
    assert chosen == {"regParam": best["reg"], "elasticNetParam": best["enp"]}


def test_models_beat_the_majority(spark):
    rows = [(float(i % 10), float(i % 4), float((i % 10) * 2 + i % 4 > 10)) for i in range(600)]
    df = assemble(spark.createDataFrame(rows, "a double, b double, label double").coalesce(1), ["a", "b"]).cache()
    share = sum(r[2] for r in rows) / len(rows)
    majority = max(share, 1 - share)
    fits = [
        estimators.fit_decision_tree(df),
        estimators.fit_random_forest(df),
        estimators.fit_logistic_regression(df, reg=0.01),
        estimators.fit_linear_svm(df, iterations=10),
    ]
    for model in fits[:3]:
        assert metrics.accuracy(estimators.predict(model, df)).first()["accuracy"] > majority
    assert metrics.accuracy(estimators.predict(fits[3], df)).first()["accuracy"] >= majority - 0.2
    rules = estimators.tree_rules(df, fits[0])
    assert rules.where(F.col("rule").contains("If (feature")).count() > 0


def test_als_lists(spark, sf_dir):
    report = recommenders.search_recommender(src.searches(spark, sf_dir), k=3)
    recs = topk.explode_recommendations(report.by_user, "username").collect()
    lists = {}
    for r in sorted(recs, key=lambda r: r["rank"]):
        lists.setdefault(r["username"], []).append(r["rating"])
    assert all(len(v) <= 3 and v == sorted(v, reverse=True) for v in lists.values())
    assert len(lists) == src.searches(spark, sf_dir).select("username").distinct().count()
    assert report.matrix().columns[0] == "username"


def test_als_needs_no_integer_type(spark):
    df = spark.createDataFrame([(u, i, float(u * i)) for u in range(1, 6) for i in range(1, 6)], "u long, i long, r double")
    model = recommend.fit_als(df, "u", "i", "r")
    assert recommend.top_users_per_item(model, 2).count() == 5


def test_attached_names_are_not_multiplied(spark):
    recs = spark.createDataFrame([(0, "x"), (1, "y")], "userId int, recommendations string")
    seen = spark.createDataFrame([(0, "ann")] * 5 + [(1, "bob")], "userId int, username string")
    assert sorted(r["username"] for r in joins.attach_user_names(recs, seen).collect()) == ["ann", "bob"]


def test_name_clustering_writes_its_clusters(spark, sf_dir, tmp_path):
    out = str(tmp_path / "clusters")
    frame = src.indicators(spark, sf_dir)
    needs = ["subgroup", "unit", "numerator"]
    report = tabular.name_clustering(
        frame, "indicatorNid", "indicatorName", "numerator", needs, {"unit": "number"}, ["formId"], k=5, out_path=out
    )
    kept = frame.where("subgroup IS NOT NULL AND unit = 'number' AND numerator IS NOT NULL").count()
    assert report.predictions.count() == kept == spark.read.option("header", True).csv(out).count()
    assert report.sse > 0 and -1 <= report.silhouette <= 1


def test_price_regression_recovers_a_rule(spark):
    rows = [(i, "ab"[i % 2], float(i % 13), float(i % 5), 4.0 * (i % 13) + 10 * (i % 2)) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, c string, x double, d double, price double")
    report = tabular.price_regression(df, "price", ["c"], ["x"], ratio=("x", "d", "share"), key="id")
    scores = {r["is_training"]: r for r in report.metrics.collect()}
    assert scores[True]["n"] + scores[False]["n"] == 800 and scores[False]["r2"] > 0.98


def test_lapse_reports(spark, sf_dir):
    report = tabular.lapse_classifier(
        src.activity(spark, sf_dir), "next_month_views", ["payment_method_type"], ["age"], key="c_custkey",
        grid=([0.01], [0.0]),
    )
    holdout = report.metrics.where("NOT is_training").first()
    assert sum(r["count"] for r in report.extra["confusion"].collect()) == holdout["n"]
    assert report.extra["rates"].count() >= 1


def test_naive_bayes_weights_sum_to_one(spark):
    df = spark.createDataFrame([(0.0, Vectors.dense(1, 2)), (1.0, Vectors.dense(5, 0))], ["label", "features"])
    model = estimators.fit_naive_bayes(df)
    total = estimators.naive_bayes_weights(df, model).groupBy("label").agg(F.sum(F.exp("theta")).alias("t")).collect()
    assert all(r["t"] == pytest.approx(1.0) for r in total)


def test_comparison_on_no_rows(spark, blobs):
    df = blobs.withColumn("label", F.lit(1.0)).limit(20).unionAll(blobs.withColumn("label", F.lit(0.0)).limit(20))
    _, scores = tuning.compare_models({"logistic": LogisticRegression(maxIter=2)}, df, df.where("label = 7"))
    assert [tuple(r) for r in scores.collect()] == [("logistic", 0, None)]
    model = estimators.fit_logistic_regression(df, maxIter=2)
    _, fitted = tuning.compare_models({"ready": model}, df, df)
    assert fitted.first()["n"] == 40
