"""Queries of descent, rules of trees, exact shares and sparse rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog import inputs as src
from plumbline.catalog.facts import CUT_SQL, one_number
from plumbline.catalog.models import trial_points
from plumbline.catalog.registry import query
from plumbline.functions.encoding import assemble
from plumbline.models import descent, estimators, rules
from plumbline.operators import aggregates
from plumbline.operators.columns import threshold_label
from plumbline.operators.splits import exact_stratified_holdout
from plumbline.session import balance, pin

# ---- descent on the hinge loss

ROUNDS, STEP, REG, PCT = 12, 0.5, 0.01, 50
#: Every round of the descent, sample and step included, as one recursion.
DESCENT_SQL = f"""WITH RECURSIVE t AS (
    SELECT c_custkey, CASE WHEN payments_made >= 1 THEN 1 ELSE -1 END AS y, access_count / 10::DOUBLE AS a, amount / 1000000::DOUBLE AS b FROM ({src.TRIALS_SQL})),
  w(round, wa, wb) AS (
    SELECT 0, 0::DOUBLE, 0::DOUBLE
    UNION ALL
    SELECT round + 1,
           any_value(wa) * (1 - {STEP} / sqrt(round + 1) * {REG}) + {STEP} / sqrt(round + 1) * avg(CASE WHEN y * (wa * a + wb * b) < 1 THEN y * a ELSE 0 END),
           any_value(wb) * (1 - {STEP} / sqrt(round + 1) * {REG}) + {STEP} / sqrt(round + 1) * avg(CASE WHEN y * (wa * a + wb * b) < 1 THEN y * b ELSE 0 END)
    FROM w, t WHERE round < {ROUNDS} AND {src.bucket_sql("c_custkey", "round + 1")} < {PCT} GROUP BY round),
  m AS (SELECT avg(wa) AS wa, avg(wb) AS wb FROM w WHERE 2 * round > {ROUNDS})"""


def descended(spark, sf_dir):
    df = threshold_label(src.trials(spark, sf_dir), "payments_made", ">=", 1)
    df = df.select("c_custkey", F.col("label").cast("double").alias("label"), (F.col("access_count") / 10).alias("a"), (F.col("amount") / 1000000).alias("b"))
    points = pin(assemble(balance(df), ["a", "b"]).select("c_custkey", "label", "features"), "descent-points")
    return points, descent.fit_svm_by_descent(points, ROUNDS, STEP, REG, PCT, "c_custkey", averaged=True)


@query("M7", f"{DESCENT_SQL} SELECT 'intercept' AS term, 0::DOUBLE AS value UNION ALL SELECT 'x0', round(wa, 6) FROM m UNION ALL SELECT 'x1', round(wb, 6) FROM m")
def svm_by_descent(spark, sf_dir):
    points, model = descended(spark, sf_dir)
    return estimators.linear_weights(points, model).withColumn("value", F.round("value", 6))


@query("M7 M12", f"{DESCENT_SQL} SELECT c_custkey, CAST((y + 1) / 2 AS DOUBLE) AS label, CAST(wa * a + wb * b > 0 AS DOUBLE) AS prediction FROM t, m")
def svm_by_descent_scores(spark, sf_dir):
    points, model = descended(spark, sf_dir)
    return model.transform(points).select("c_custkey", "label", "prediction")


# ---- rules of trees


@query(
    "M13 M3",
    f"""{CUT_SQL} SELECT CASE WHEN x <= cut THEN 'up to' ELSE 'above' END AS side, any_value(CAST(cut AS DOUBLE)) AS cut, count(*) AS support, count(*) AS rows,
        CAST(sum(y) AS BIGINT) AS ones, CAST(any_value(CASE WHEN x <= cut THEN left_share ELSE right_share END) > 0.5 AS DOUBLE) AS prediction
        FROM t, b GROUP BY 1""",
)
def stump_rules_as_rows(spark, sf_dir):
    """The predicate of each side run against the table: the rows it takes are those the leaf was fitted on."""
    df = one_number(spark, sf_dir)
    model = estimators.fit_decision_tree(df, max_depth=1, maxBins=256)
    cut = rules.tree_nodes(spark, model).where("cut IS NOT NULL").first()["cut"]
    leaves = rules.leaf_rules(spark, model, ["access_count"])
    sides = [df.where(r["rule"]).agg(F.lit(r["rule"]).alias("rule"), F.count("*").alias("rows"), F.sum("label").cast("long").alias("ones")) for r in leaves.collect()]
    taken = sides[0].unionByName(sides[1])
    side = F.when(F.col("rule").contains("<="), F.lit("up to")).otherwise("above")
    return leaves.join(taken, "rule").select(side.alias("side"), F.lit(cut).alias("cut"), "support", "rows", "ones", "prediction")


@query("M13 M3 M4", f"SELECT unnest(['tree', 'forest']) AS model, n AS rows, n AS agree FROM (SELECT count(*) AS n FROM ({src.TRIALS_SQL}))")
def rules_agree_with_models(spark, sf_dir):
    """Rows on which the predicates of a tree of depth 5 and of a forest give what the model gives: all."""
    df = threshold_label(src.trials(spark, sf_dir), "payments_made", ">=", 1)
    names = ["access_count", "amount"]
    points = pin(assemble(balance(df), names).select("c_custkey", *names, F.col("label").cast("double").alias("label"), "features"), "rule-points")
    parts = []
    for name, model in {"tree": estimators.fit_decision_tree(points), "forest": estimators.fit_random_forest(points)}.items():
        scored = rules.score_by_rules(model.transform(points), rules.leaf_rules(spark, model, names), "by_rules")
        agree = F.sum((F.col("prediction") == F.col("by_rules")).cast("long"))
        parts.append(scored.agg(F.lit(name).alias("model"), F.count("*").alias("rows"), agree.alias("agree")))
    return parts[0].unionByName(parts[1])


@query("M13 M3")
def tree_leaf_rules(spark, sf_dir):
    """Every leaf of a tree of depth 5 as a predicate with its support."""
    model = estimators.fit_decision_tree(trial_points(spark, sf_dir))
    return rules.leaf_rules(spark, model, ["access_count", "amount"]).select("tree", "leaf", "rule", "support", "prediction")


# ---- exact shares per class

SHARES = {"AUTOMOBILE": 50, "BUILDING": 80, "MACHINERY": 0, "FURNITURE": 100}
SHARE_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SHARES.items()) + " ELSE 0 END"


@query(
    "U4",
    f"""SELECT c_custkey, c_mktsegment, place <= n * share // 100 AS training FROM (
          SELECT c_custkey, c_mktsegment, {SHARE_SQL} AS share, count(*) OVER (PARTITION BY c_mktsegment) AS n,
                 row_number() OVER (PARTITION BY c_mktsegment ORDER BY left(md5(CAST(c_custkey AS VARCHAR)), 15)) AS place FROM customer)""",
)
def exact_stratified_holdout_rows(spark, sf_dir):
    """Each segment gives exactly its share of rows to training: which rows they are."""
    customers = src.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    training, holdout = exact_stratified_holdout(customers, "c_mktsegment", SHARES, "c_custkey")
    return training.withColumn("training", F.lit(True)).unionByName(holdout.withColumn("training", F.lit(False)))


# ---- sparse rows


@query(
    "A4",
    f"""WITH s AS ({src.SEARCHES_SQL}),
        i AS (SELECT indicatorId, row_number() OVER (ORDER BY count(*) DESC, CAST(indicatorId AS VARCHAR)) - 1 AS place FROM s WHERE indicatorId IS NOT NULL GROUP BY indicatorId)
        SELECT username, coalesce(string_agg(CAST(place AS VARCHAR), ',' ORDER BY place), '') AS items,
               coalesce(string_agg(CAST("count" AS VARCHAR), ',' ORDER BY place) FILTER (place IS NOT NULL), '') AS sums
        FROM s LEFT JOIN i USING (indicatorId) GROUP BY username""",
)
def interaction_rows(spark, sf_dir):
    rows, _ = aggregates.interaction_rows(src.searches(spark, sf_dir), "username", "indicatorId", "count")
    return rows.select("username", F.array_join("items", ",").alias("items"), F.array_join("values", ",").alias("sums"))
