"""Metrics as DataFrames, each from one aggregation over the predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.aggregates import confusion_counts
from plumbline.operators.columns import cast_to_int_equal


def regression_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """``r2`` and ``rmse``, for example by split."""
    residual = F.col(label) - F.col(prediction)
    sums = pred.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(residual * residual).alias("_sse"),
        (F.var_pop(label) * F.count(label)).alias("_sst"),
    )
    return sums.select(
        *by,
        "n",
        (F.lit(1.0) - F.try_divide("_sse", "_sst")).alias("r2"),
        F.sqrt(F.try_divide(F.col("_sse"), F.col("n"))).alias("rmse"),
    )


def accuracy(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Share of predictions that equal the label; null when there are no rows."""
    hit = F.when(cast_to_int_equal(prediction, label), 1.0).otherwise(0.0)
    return pred.groupBy(*by).agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


def rates_by_label(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """True and false positive rate of each label that occurs.

    The rows collapse to the confusion counts first; the rest runs on
    labels x labels rows.
    """
    n, actual, guess = F.col("count"), F.col(label).cast("double"), F.col(prediction).cast("double")
    none = F.lit(0).cast("long")
    hits = F.when(actual == guess, n).otherwise(none)
    roles = F.array(
        F.struct(actual.alias("label"), n.alias("rows"), none.alias("guessed"), hits.alias("hits")),
        F.struct(guess.alias("label"), none.alias("rows"), n.alias("guessed"), none.alias("hits")),
    )
    counts = confusion_counts(pred, label, prediction)
    sums = (
        counts.select(F.inline(roles))
        .groupBy("label")
        .agg(F.sum("rows").alias("rows"), F.sum("guessed").alias("guessed"), F.sum("hits").alias("hits"))
        .withColumn("total", counts.agg(F.sum("count")).scalar())
        .where(F.col("rows") > 0)
    )
    return sums.select(
        "label",
        F.try_divide("hits", "rows").alias("true_positive_rate"),
        F.coalesce(F.try_divide(F.col("guessed") - F.col("hits"), F.col("total") - F.col("rows")), F.lit(0.0)).alias(
            "false_positive_rate"
        ),
    )


def positive_likelihood(
    pred: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    positive: float = 1.0,
    negative: float = 0.0,
) -> DataFrame:
    """``TPR[positive] / (TPR[positive] + FPR[negative])``; this is not the precision."""
    rates = rates_by_label(pred, label, prediction).agg(
        F.max(F.when(F.col("label") == positive, F.col("true_positive_rate"))).alias("_tpr"),
        F.max(F.when(F.col("label") == negative, F.col("false_positive_rate"))).alias("_fpr"),
    )
    return rates.select(F.try_divide(F.col("_tpr"), F.col("_tpr") + F.col("_fpr")).alias("likelihood"))


def silhouette_score(pred: DataFrame, features: str = "features", prediction: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance."""
    return float(ClusteringEvaluator(featuresCol=features, predictionCol=prediction).evaluate(pred))


def silhouette(pred: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
    score = silhouette_score(pred, features, prediction)
    return pred.sparkSession.createDataFrame([(score,)], "silhouette double")


def assignment_sse(pred: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """Squared distance to the cluster means for any given assignment."""
    stats = pred.groupBy(prediction).agg(Summarizer.metrics("count", "variance").summary(F.col(features)).alias("s"))
    spread = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda a, v: a + v)
    return stats.agg(F.sum(spread * (F.col("s.count") - 1)).alias("sse"))
