"""Queries of the estimators and of tuning.

Models with a closed form are checked by SQL.  The others are iterative or
sampled; they give their real output and have no SQL.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from plumbline.catalog import inputs as src
from plumbline.catalog.registry import query
from plumbline.functions.encoding import assemble, index_strings, one_hot
from plumbline.models import clustering, estimators, metrics, recommend, tuning
from plumbline.operators.columns import threshold_label
from plumbline.operators.splits import key_holdout
from plumbline.operators.topk import explode_recommendations
from plumbline.plans.images import classify_image_batch as classify
from plumbline.session import balance, pin
from plumbline.sources.pixel_lines import labeled_points


def lines(spark, sf_dir):
    """Line items as ``(label price, features quantity)``."""
    df = src.table(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    return assemble(df, ["l_quantity"]).select("features", "label", "l_quantity")


def trial_points(spark, sf_dir, cols=("access_count", "amount")):
    df = threshold_label(src.trials(spark, sf_dir), "payments_made", ">=", 1)
    df = assemble(balance(df), cols).select("c_custkey", F.col("label").cast("double").alias("label"), "features")
    return pin(df, "trial-points")


def two_class_points(spark, sf_dir):
    """Vectors as points whose label says whether their class is 5 or above."""
    pixels = src.pixel_rows(spark, sf_dir).withColumn("label", (F.col("label") >= 5).cast("int"))
    return pin(labeled_points(balance(pixels)), "two-class")


@query(
    "M1",
    """SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 4) AS value FROM lineitem
       UNION ALL SELECT 'x0', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""",
)
def fit_linear_regression(spark, sf_dir):
    df = lines(spark, sf_dir)
    model = estimators.fit_linear_regression(df)
    return estimators.linear_weights(df, model).withColumn("value", F.round("value", 4))


@query(
    "M12 M1",
    """SELECT l_quantity, count(*) AS n, round(any_value(a + b * l_quantity), 2) AS prediction FROM lineitem,
       (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)
       GROUP BY l_quantity""",
)
def predict(spark, sf_dir):
    df = lines(spark, sf_dir)
    scored = estimators.predict(estimators.fit_linear_regression(df), df)
    return scored.groupBy("l_quantity").agg(F.count("*").alias("n"), F.round(F.first("prediction"), 2).alias("prediction"))


@query(
    "M2",
    """SELECT c_mktsegment, count(*) AS n, round(avg(CASE WHEN c_acctbal < 1000 THEN 1.0 ELSE 0.0 END), 3) AS probability
       FROM customer GROUP BY c_mktsegment""",
)
def fit_logistic_regression(spark, sf_dir):
    """One category and no penalty: the fitted probability is the share in each category."""
    df = src.table(spark, sf_dir, "customer").select("c_mktsegment", (F.col("c_acctbal") < 1000).cast("double").alias("label"))
    df = one_hot(index_strings(df, ["c_mktsegment"], ["i"]), ["i"], ["features"])
    model = estimators.fit_logistic_regression(df, maxIter=200, tol=1e-12)
    scored = model.transform(df).select("c_mktsegment", vector_to_array("probability")[1].alias("probability"))
    return scored.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.first("probability"), 3).alias("probability"))


@query("M3")
def fit_decision_tree(spark, sf_dir):
    training, holdout = key_holdout(trial_points(spark, sf_dir), "c_custkey", 80)
    model = estimators.fit_decision_tree(training)
    return model.transform(holdout).groupBy("label", "prediction").count()


@query(
    "M3",
    f"""WITH t AS (SELECT access_count AS x, CASE WHEN payments_made >= 1 THEN 1 ELSE 0 END AS y FROM ({src.TRIALS_SQL})),
        v AS (SELECT x, count(*) AS n, sum(y) AS s FROM t GROUP BY x),
        c AS (SELECT x, lead(x) OVER (ORDER BY x) AS next_x, sum(n) OVER (ORDER BY x) AS ln, sum(s) OVER (ORDER BY x) AS ls,
                     sum(n) OVER () AS tn, sum(s) OVER () AS ts FROM v),
        g AS (SELECT (x + next_x) / 2 AS cut, ln, ls, tn - ln AS rn, ts - ls AS rs,
                     2 * ls * (ln - ls) / ln + 2 * (ts - ls) * (tn - ln - ts + ls) / (tn - ln) AS impurity FROM c WHERE next_x IS NOT NULL),
        b AS (SELECT cut, CASE WHEN 2 * ls > ln THEN 1.0 ELSE 0.0 END AS p_left, CASE WHEN 2 * rs > rn THEN 1.0 ELSE 0.0 END AS p_right
              FROM g ORDER BY impurity LIMIT 1)
        SELECT CAST(x AS BIGINT) AS access_count, CAST(CASE WHEN x <= cut THEN p_left ELSE p_right END AS DOUBLE) AS prediction,
               count(*) AS n FROM t, b GROUP BY 1, 2""",
)
def fit_decision_stump(spark, sf_dir):
    """A tree of one split over one number: the cut of lowest gini impurity."""
    df = threshold_label(src.trials(spark, sf_dir), "payments_made", ">=", 1)
    df = assemble(df, ["access_count"])
    model = estimators.fit_decision_tree(df, max_depth=1, maxBins=256)
    return model.transform(df).groupBy("access_count", "prediction").agg(F.count("*").alias("n"))


@query("M4")
def fit_random_forest(spark, sf_dir):
    training, holdout = key_holdout(trial_points(spark, sf_dir), "c_custkey", 80)
    model = estimators.fit_random_forest(training)
    return model.transform(holdout).groupBy("label", "prediction").count()


@query("M5")
def fit_forest_regression(spark, sf_dir):
    points = two_class_points(spark, sf_dir)
    train, test = points.where(src.is_training()), points.where(~src.is_training())
    model = estimators.fit_forest_regression(train)
    return model.transform(test).select("name", "label", F.round("prediction", 6).alias("prediction"))


def bayes_sql(frame, training="true"):
    """Priors ``pi`` and weights ``th`` of naive Bayes over ``(vec_id, label, pixels)``."""
    return f"""WITH px AS ({frame}),
      e AS (SELECT vec_id, label, unnest(pixels) AS v, generate_subscripts(pixels, 1) - 1 AS j FROM px),
      tr AS (SELECT * FROM px WHERE {training}),
      pi AS (SELECT label, ln(count(*) + 1) - ln((SELECT count(*) + count(DISTINCT label) FROM tr)) AS pi FROM tr GROUP BY label),
      sums AS (SELECT label, j, sum(v) AS s FROM e WHERE {training} GROUP BY label, j),
      th AS (SELECT label, j, ln(s + 1) - ln(sum(s) OVER (PARTITION BY label) + {src.VECTOR_WIDTH}) AS theta FROM sums)"""


NB_TRAINING = "vec_id % 5 <> 0"
NB_SCORED_SQL = """SELECT e.vec_id, e.label, arg_max(m.label, m.score) AS prediction FROM px e JOIN (
    SELECT vec_id, pi.label, any_value(pi) + sum(v * theta) AS score FROM e JOIN th USING (j) JOIN pi ON pi.label = th.label
    GROUP BY vec_id, pi.label) m USING (vec_id) WHERE e.vec_id % 5 = 0 GROUP BY e.vec_id, e.label"""


@query(
    "M6",
    f"{bayes_sql(src.PIXELS_SQL)} SELECT label, CAST(j AS INTEGER) AS feature, round(pi, 6) AS pi, round(theta, 6) AS theta FROM th JOIN pi USING (label)",
)
def fit_naive_bayes(spark, sf_dir):
    points = labeled_points(src.pixel_rows(spark, sf_dir))
    weights = estimators.naive_bayes_weights(points, estimators.fit_naive_bayes(points))
    return weights.select("label", "feature", F.round("pi", 6).alias("pi"), F.round("theta", 6).alias("theta"))


@query(
    "I5 M6 M12",
    f"{bayes_sql(src.PIXELS_SQL, NB_TRAINING)} SELECT 'scan,' || vec_id || '.png' AS name, CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction FROM ({NB_SCORED_SQL})",
)
def classify_image_batch(spark, sf_dir):
    pixels = src.pixel_rows(spark, sf_dir)
    model = estimators.fit_naive_bayes(labeled_points(pixels.where(src.is_training())))
    return classify(model, pixels.where(~src.is_training()))


@query("M7")
def fit_linear_svm(spark, sf_dir):
    points = two_class_points(spark, sf_dir)
    model = estimators.fit_linear_svm(points.where(src.is_training()))
    return model.transform(points.where(~src.is_training())).select("name", "label", "prediction")


def cluster_points(spark, sf_dir):
    df = balance(src.houses(spark, sf_dir).select("quantity", "size", "retail"))
    return clustering.pin_points(assemble(df, ["quantity", "size", "retail"]).select("features"), "cluster-points")


@query("M8")
def fit_kmeans(spark, sf_dir):
    points = cluster_points(spark, sf_dir)
    return clustering.fit_kmeans(points, 5).transform(points).groupBy("prediction").count()


@query("M9 A2 V8 V9")
def kmeans_sweep(spark, sf_dir):
    scores = clustering.kmeans_sweep(cluster_points(spark, sf_dir)).scores
    return scores.select("k", "clusters", F.round("sse", 2).alias("sse"), F.round("silhouette", 6).alias("silhouette"))


@query(
    "M10 M8 A2 V8",
    """SELECT CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 5.0::DOUBLE ELSE 20.0::DOUBLE END AS center,
              count(*) AS rows, 0.0::DOUBLE AS sse FROM lineitem GROUP BY 1""",
)
def cluster_centers(spark, sf_dir):
    """Three clusters over three distinct points: the centres are the points and nothing is left over."""
    flag = F.col("l_returnflag")
    spot = F.when(flag == "A", 0.0).when(flag == "N", 5.0).otherwise(20.0)
    df = src.table(spark, sf_dir, "lineitem").select(spot.alias("spot"))
    points = clustering.pin_points(assemble(balance(df), ["spot"]).select("features"), "spots")
    model = clustering.fit_kmeans(points, 3, initSteps=8)
    cost = clustering.clustering_sse(points, model)
    sizes = model.transform(points).groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("rows"))
    centers = clustering.cluster_centers(points, model).select("cluster", F.round(F.col("center")[0], 6).alias("center"))
    joined = centers.join(sizes, "cluster").select("center", "rows")
    return joined.withColumn("sse", F.round(F.lit(cost.first()["sse"]), 6))


def search_model(spark, sf_dir):
    from plumbline.functions.encoding import index_users

    ratings = pin(index_users(src.searches(spark, sf_dir)), "search-ratings")
    return recommend.fit_als(ratings, "userId", "indicatorId", "count"), ratings


@query("M11 M12")
def fit_als(spark, sf_dir):
    model, ratings = search_model(spark, sf_dir)
    scored = model.transform(ratings.withColumn("count", F.col("count").cast("float")))
    pred = scored.select(F.col("count").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"))
    return metrics.regression_metrics(pred)


@query("L2 L4")
def top_items_per_user(spark, sf_dir):
    model, _ = search_model(spark, sf_dir)
    return explode_recommendations(recommend.top_items_per_user(model, 5), "userId")


@query("L3 L4")
def top_users_per_item(spark, sf_dir):
    model, _ = search_model(spark, sf_dir)
    return explode_recommendations(recommend.top_users_per_item(model, 5), "indicatorId")


@query("M13 M3")
def tree_rules(spark, sf_dir):
    points = trial_points(spark, sf_dir)
    return estimators.tree_rules(points, estimators.fit_decision_tree(points))


# Elastic net over one feature: soft threshold, then shrinkage, on the standardised scale.
GRID_SQL = f"""
WITH t AS (SELECT corr(access_count, amount) AS r, stddev_pop(access_count) AS sy, stddev_pop(amount / 1000000) AS sx FROM ({src.TRIALS_SQL})),
g AS (SELECT (row_number() OVER (ORDER BY reg, enp) - 1) AS point, reg, enp
      FROM (SELECT unnest({tuning.PRICE_GRID[0]}) AS reg), (SELECT unnest({tuning.PRICE_GRID[1]}) AS enp))
SELECT CAST(point AS INTEGER) AS point, CAST(reg AS DOUBLE) AS reg, CAST(enp AS DOUBLE) AS enp,
       round(greatest(r - reg * enp / sy, 0) / (1 + reg * (1 - enp) / sy) * sy / sx, 3) AS slope FROM g, t
"""


@query("V1 M1", GRID_SQL)
def param_grid(spark, sf_dir):
    """Every grid point fitted on one feature, where the elastic net has a closed form."""
    df = src.trials(spark, sf_dir).select((F.col("amount") / 1000000).alias("millions"), F.col("access_count").alias("label"))
    points = pin(assemble(balance(df), ["millions"]).select("features", "label"), "grid-points")
    est = LinearRegression(tol=1e-10, maxIter=200)
    grid = tuning.param_grid(est, *tuning.PRICE_GRID)
    wide = tuning.grid_table(spark, grid).groupBy("point").pivot("param", ["regParam", "elasticNetParam"]).agg(F.first("value"))
    slopes = [(i, float(model.coefficients[0])) for i, model in est.fitMultiple(points, grid)]
    fitted = spark.createDataFrame(slopes, "point int, slope double")
    return wide.join(fitted, "point").select(
        "point", F.col("regParam").alias("reg"), F.col("elasticNetParam").alias("enp"), F.round("slope", 3).alias("slope")
    )


def tuned_lines(spark, sf_dir):
    df = balance(src.houses(spark, sf_dir).select("price", "quantity", "retail", "size"))
    points = pin(assemble(df, ["quantity", "retail", "size"]).select("features", F.col("price").alias("label")), "tune-points")
    est = LinearRegression()
    return points, tuning.tune(points, est, tuning.param_grid(est, *tuning.PRICE_GRID))


@query("V2 V1 V4")
def tune(spark, sf_dir):
    points, tuned = tuned_lines(spark, sf_dir)
    return tuning.validation_scores(points, tuned)


@query("V3")
def best_params(spark, sf_dir):
    points, tuned = tuned_lines(spark, sf_dir)
    return tuning.best_params(points, tuned)


@query("V10 V5")
def compare_models(spark, sf_dir):
    points = trial_points(spark, sf_dir)
    training, holdout = key_holdout(points, "c_custkey", 80)
    rivals = {"logistic": LogisticRegression(), "forest": RandomForestClassifier(maxDepth=5, seed=estimators.SEED)}
    return tuning.compare_models(rivals, training, holdout)[1]
