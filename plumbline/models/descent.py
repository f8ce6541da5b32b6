"""A linear support vector machine by sampled sub-gradient descent, every pass in the JVM."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.splits import holdout_bucket

FAN_IN = 64  # groups in which the sums of tasks meet before the last sum


def fit_svm_by_descent(
    df: DataFrame,
    iterations: int = 100,
    step: float = 1.0,
    reg: float = 0.01,
    pct: int = 100,
    key: str | list[str] | None = None,
    averaged: bool = False,
) -> LinearSVCModel:
    """Hinge loss with an L2 penalty, without intercept, on labels 0 and 1.

    Round ``t`` takes ``pct`` percent of the rows, by a hash of ``key`` (the whole
    row without one) and ``t``, and moves against their mean sub-gradient by
    ``step / sqrt(t)``.  ``averaged`` gives the mean of the weights after each round
    of the second half.  A round whose sample is empty changes nothing.  Each
    round is one scan of ``df``, so give it a pinned frame.  What reaches the driver
    is one vector of the features' width a class.  Without rows there is no model.
    """
    weights: np.ndarray | None = None
    total, rounds = 0.0, 0
    for t in range(1, iterations + 1):
        gradient = _mean_gradient(_sample(df, key, t, pct), None if weights is None else _model(df, weights, iterations, reg))
        if gradient is not None:
            pace = step / np.sqrt(t)
            start = np.zeros_like(gradient) if weights is None else weights
            weights = start * (1 - pace * reg) - pace * gradient
        if averaged and weights is not None and 2 * t > iterations:
            total, rounds = total + weights, rounds + 1
    if weights is None:
        raise ValueError("no rows to fit on")
    return _model(df, total / rounds if rounds else weights, iterations, reg)


def _sample(df: DataFrame, key: str | list[str] | None, t: int, pct: int) -> DataFrame:
    if pct >= 100:
        return df
    keys = None if key is None else [key, "__round"] if isinstance(key, str) else [*key, "__round"]
    own = df.withColumn("__round", F.lit(t))
    return own.where(holdout_bucket(own, keys) < pct)


def _mean_gradient(rows: DataFrame, model: LinearSVCModel | None) -> np.ndarray | None:
    """The mean sub-gradient of the hinge loss; without a model all weights are zero and every row is inside the margin."""
    inside: Column = F.lit(True)
    if model is not None:
        rows = model.transform(rows)
        margin = vector_to_array("rawPrediction")[1]
        inside = F.when(F.col("label") > 0.5, margin < 1).otherwise(margin > -1)
    parts = rows.select((F.col("label") > 0.5).alias("positive"), inside.alias("inside"), "features", F.spark_partition_id().alias("task"))
    by = ["positive", "inside"]
    # Tasks sum by themselves, then in groups, so that the last sum does not meet one vector per task.
    groups = parts.groupBy(*by, (F.col("task") % FAN_IN).alias("group")).agg(F.count("*").alias("n"), Summarizer.sum(F.col("features")).alias("v"))
    found = groups.groupBy(*by).agg(F.sum("n").alias("n"), Summarizer.sum(F.col("v")).alias("v")).collect()
    if not found:
        return None
    gradient = np.zeros(len(found[0]["v"]))
    for row in found:
        if row["inside"]:
            gradient += (-1.0 if row["positive"] else 1.0) * row["v"].toArray()
    return gradient / sum(row["n"] for row in found)


def _model(df: DataFrame, weights: np.ndarray, iterations: int, reg: float) -> LinearSVCModel:
    """Spark's own model with the given weights: it scores, saves and loads as a fitted one does."""
    spark = df.sparkSession
    est = LinearSVC(maxIter=iterations, regParam=reg, fitIntercept=False, standardization=False)
    made = spark._jvm.org.apache.spark.ml.classification.LinearSVCModel(est.uid, _py2java(spark.sparkContext, Vectors.dense(weights)), 0.0)
    return est._copyValues(LinearSVCModel(made))
