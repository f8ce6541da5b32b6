"""Queries of the metrics, on predictions made by a fixed rule so that SQL can check them."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog import inputs as src
from plumbline.catalog.registry import query
from plumbline.functions.encoding import assemble
from plumbline.models import metrics


def binary(spark, sf_dir):
    return src.table(spark, sf_dir, "labels").select(
        F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("prediction")
    )


def many_classes(spark, sf_dir):
    """Labels 0..3 and predictions 0..4, so one class is predicted that never occurs."""
    return src.table(spark, sf_dir, "part").select(
        (F.col("p_size") % 4).cast("double").alias("label"), (F.col("p_partkey") % 5).cast("double").alias("prediction")
    )


BINARY_SQL = "SELECT quality AS label, toxic AS prediction FROM labels"
CLASSES_SQL = "SELECT p_size % 4 AS label, p_partkey % 5 AS prediction FROM part"


@query(
    "V4",
    """SELECT l_returnflag, count(*) AS n,
              round(1 - sum(power(l_extendedprice - 1500 * l_quantity, 2)) / (var_pop(l_extendedprice) * count(*)), 6) AS r2,
              round(sqrt(avg(power(l_extendedprice - 1500 * l_quantity, 2))), 4) AS rmse
       FROM lineitem GROUP BY l_returnflag""",
)
def regression_metrics(spark, sf_dir):
    pred = src.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction")
    )
    df = metrics.regression_metrics(pred, by=["l_returnflag"])
    return df.select("l_returnflag", "n", F.round("r2", 6).alias("r2"), F.round("rmse", 4).alias("rmse"))


@query("V5 F3 P14", f"SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ({BINARY_SQL})")
def accuracy(spark, sf_dir):
    return metrics.accuracy(binary(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 6))


RATES_SQL = """
SELECT CAST(l AS DOUBLE) AS label,
       round(count(*) FILTER (label = l AND prediction = l) / count(*) FILTER (label = l), 6) AS true_positive_rate,
       round(count(*) FILTER (label <> l AND prediction = l) / count(*) FILTER (label <> l), 6) AS false_positive_rate
FROM p, (SELECT DISTINCT label AS l FROM p) GROUP BY l
"""


@query("V6", f"WITH p AS ({CLASSES_SQL}) {RATES_SQL}")
def rates_by_label(spark, sf_dir):
    df = metrics.rates_by_label(many_classes(spark, sf_dir))
    return df.select("label", *[F.round(c, 6).alias(c) for c in ["true_positive_rate", "false_positive_rate"]])


@query(
    "V7",
    f"""WITH p AS ({BINARY_SQL}), r AS (
          SELECT count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1) AS tpr,
                 count(*) FILTER (label = 1 AND prediction = 0) / count(*) FILTER (label = 1) AS fpr FROM p)
        SELECT round(tpr / (tpr + fpr), 6) AS likelihood FROM r""",
)
def positive_likelihood(spark, sf_dir):
    return metrics.positive_likelihood(binary(spark, sf_dir)).select(F.round("likelihood", 6).alias("likelihood"))


def assignments(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("a"),
        (F.col("l_discount") * 100).alias("b"),
        (F.col("l_tax") * 100).alias("c"),
        (F.col("l_linenumber") - 1).alias("prediction"),
    )
    return assemble(df, ["a", "b", "c"]).select("features", "prediction")


POINTS_SQL = "SELECT l_quantity AS a, l_discount * 100 AS b, l_tax * 100 AS c, l_linenumber - 1 AS k FROM lineitem"


@query(
    "V8 M10",
    f"""SELECT round(sum(sse), 2) AS sse FROM
        (SELECT (var_pop(a) + var_pop(b) + var_pop(c)) * count(*) AS sse FROM ({POINTS_SQL}) GROUP BY k)""",
)
def assignment_sse(spark, sf_dir):
    return metrics.assignment_sse(assignments(spark, sf_dir)).select(F.round("sse", 2).alias("sse"))


@query(
    "V9",
    f"""WITH p AS (SELECT row_number() OVER () AS id, * FROM ({POINTS_SQL})),
        s AS (SELECT k AS c_k, count(*) AS n, sum(a) AS sa, sum(b) AS sb, sum(c) AS sc, sum(a * a + b * b + c * c) AS sq FROM p GROUP BY k),
        d AS (SELECT id, k, c_k, n, a * a + b * b + c * c + sq / n - 2 * (a * sa + b * sb + c * sc) / n AS dist FROM p, s),
        o AS (SELECT id, max(CASE WHEN k = c_k THEN dist * n / (n - 1) END) AS own, min(CASE WHEN k <> c_k THEN dist END) AS other
              FROM d GROUP BY id)
        SELECT round(avg((other - own) / greatest(own, other)), 6) AS silhouette FROM o""",
)
def silhouette(spark, sf_dir):
    return metrics.silhouette(assignments(spark, sf_dir)).select(F.round("silhouette", 6).alias("silhouette"))
