"""Grids, validation splits and model comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.models import gram
from plumbline.models.estimators import SEED
from plumbline.models.metrics import accuracy
from plumbline.session import fits_at_once, run_together

# Penalty strength and elastic-net mix of each tuned job.
PRICE_GRID = ([0.01, 0.1, 0.5], [0.1, 0.5, 1.0])
ACTIVITY_GRID = ([0.1, 0.3, 0.5, 0.7, 1.0], [0.01, 0.5, 1.0])
LAPSE_GRID = ([0.01, 0.1, 0.3, 0.5, 0.7, 1.0], [0.0, 0.5, 1.0])


def param_grid(est: Estimator, reg: Sequence[float], enp: Sequence[float]) -> list:
    """Every combination of penalty strength and elastic-net mix."""
    return ParamGridBuilder().addGrid(est.regParam, list(reg)).addGrid(est.elasticNetParam, list(enp)).build()


def grid_table(spark: SparkSession, grid: Sequence) -> DataFrame:
    """A grid as rows ``(point, param, value)``."""
    rows = [(i, p.name, float(v)) for i, point in enumerate(grid) for p, v in point.items()]
    return spark.createDataFrame(rows, "point int, param string, value double")


def tuner(
    est: Estimator,
    grid: Sequence,
    evaluator: Evaluator | None = None,
    ratio: float = 0.75,
    seed: int = SEED,
    parallelism: int = 4,
) -> TrainValidationSplit:
    """An unfitted search; it can be the last stage of a larger estimator."""
    return TrainValidationSplit(
        estimator=est,
        estimatorParamMaps=list(grid),
        evaluator=evaluator or RegressionEvaluator(metricName="r2"),
        trainRatio=ratio,
        seed=seed,
        parallelism=parallelism,
    )


def tune(
    df: DataFrame,
    est: Estimator,
    grid: Sequence,
    evaluator: Evaluator | None = None,
    ratio: float = 0.75,
    seed: int = SEED,
    parallelism: int | None = None,
) -> TrainValidationSplitModel:
    """Score every grid point on one validation part and refit the best on all rows.

    Linear regression of up to 4,096 features takes one scan for the whole grid, see
    ``tune_linear``.  Other estimators read ``df``, which should be a scan or a pinned
    frame, for every grid point.
    """
    search = tuner(est, grid, evaluator, ratio, seed, parallelism or fits_at_once(df))
    if _from_products(df, search):
        return tune_linear(df, search)
    return search.fit(df)


def _from_products(df: DataFrame, search: TrainValidationSplit) -> bool:
    """Whether products of the columns determine every fit and metric of a search."""
    est, evaluator = search.getEstimator(), search.getEvaluator()
    if type(est) is not LinearRegression or type(evaluator) is not RegressionEvaluator or evaluator.getMetricName() not in gram.METRICS:
        return False
    plain = est.getFitIntercept() and est.getStandardization() and est.getLoss() == "squaredError" and not est.isSet(est.weightCol)
    plain = plain and not evaluator.isSet(evaluator.weightCol) and not evaluator.getThroughOrigin() and evaluator.getLabelCol() == est.getLabelCol()
    penalties = all({p.name for p in point} <= {"regParam", "elasticNetParam"} for point in search.getEstimatorParamMaps())
    return plain and penalties and _width(df, est.getFeaturesCol()) <= gram.MAX_FEATURES


def _width(df: DataFrame, features: str) -> int:
    """Features of a vector column, from its metadata or else its first row."""
    known = df.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    if known:
        return known
    first = df.select(features).first()
    return first[0].size if first else gram.MAX_FEATURES + 1


def tune_linear(df: DataFrame, search: TrainValidationSplit, split: Column | None = None) -> TrainValidationSplitModel:
    """The search over linear models from one pass over ``df``.

    ``split`` says which rows train; by default they are those that the search itself
    would draw.  Coefficients are those Spark's solver converges to.
    """
    est, evaluator = search.getEstimator(), search.getEvaluator()
    points = [_penalty(est, point) for point in search.getEstimatorParamMaps()]
    fits, metrics, whole = linear_path(df, points, est, evaluator.getMetricName(), _drawn(search) if split is None else split)
    pick = max if evaluator.isLargerBetter() else min
    best = points[metrics.index(pick(metrics))]
    model = _linear_model(df.sparkSession, est, gram.elastic_net_path(whole, [best])[0])
    return search._copyValues(TrainValidationSplitModel(model, metrics, None))


def _drawn(search: TrainValidationSplit) -> Column:
    return F.rand(search.getSeed()) < search.getTrainRatio()


def _penalty(est: LinearRegression, point: Mapping) -> tuple[float, float]:
    values = {p.name: float(v) for p, v in point.items()}
    return values.get("regParam", est.getRegParam()), values.get("elasticNetParam", est.getElasticNetParam())


def linear_path(
    df: DataFrame, points: Sequence[tuple[float, float]], est: LinearRegression, metric: str, split: Column
) -> tuple[list[gram.Fit], list[float], gram.Gram]:
    """Fits on the rows where ``split`` holds, their metric on the others, and the products of all rows."""
    found = gram.grams(df, F.coalesce(split, F.lit(False)).cast("int"), est.getFeaturesCol(), est.getLabelCol())
    if len(found) < 2:
        raise ValueError("one part of the validation split has no rows")
    fits = gram.elastic_net_path(found[1], points)
    return fits, [gram.score(found[0], fit, metric) for fit in fits], found[1] + found[0]


def path_table(spark: SparkSession, fits: Sequence[gram.Fit], metrics: Sequence[float]) -> DataFrame:
    """A path as rows ``(point, reg, enp, intercept, weights, metric)``."""
    rows = [(i, f.reg, f.enp, f.intercept, f.weights.tolist(), float(m)) for i, (f, m) in enumerate(zip(fits, metrics))]
    return spark.createDataFrame(rows, "point int, reg double, enp double, intercept double, weights array<double>, metric double")


def _linear_model(spark: SparkSession, est: LinearRegression, fit: gram.Fit) -> LinearRegressionModel:
    """Spark's own model with the given coefficients: it scores, saves and loads as a fitted one does."""
    made = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        est.uid, _py2java(spark.sparkContext, Vectors.dense(fit.weights)), fit.intercept
    )
    model = est._copyValues(LinearRegressionModel(made))
    return model._set(regParam=fit.reg, elasticNetParam=fit.enp)


def validation_scores(df: DataFrame, tuned: TrainValidationSplitModel) -> DataFrame:
    """Metric of each grid point, ``(point, reg, enp, metric, best)``."""
    metrics = list(tuned.validationMetrics)
    pick = max if tuned.getEvaluator().isLargerBetter() else min
    best = metrics.index(pick(metrics))
    rows = []
    for i, (point, metric) in enumerate(zip(tuned.getEstimatorParamMaps(), metrics)):
        values = {p.name: float(v) for p, v in point.items()}
        rows.append((i, values["regParam"], values["elasticNetParam"], float(metric), i == best))
    return df.sparkSession.createDataFrame(rows, "point int, reg double, enp double, metric double, best boolean")


def best_params(df: DataFrame, tuned: TrainValidationSplitModel) -> DataFrame:
    """The chosen penalty as rows ``(param, value)``."""
    best = tuned.bestModel
    rows = [("regParam", float(best.getRegParam())), ("elasticNetParam", float(best.getElasticNetParam()))]
    return df.sparkSession.createDataFrame(rows, "param string, value double")


def compare_models(
    estimators: Mapping[str, Estimator | Transformer], train: DataFrame, test: DataFrame, parallelism: int = 2
) -> tuple[dict[str, Model], DataFrame]:
    """Fit several estimators on one split: the models, and rows ``(model, n, accuracy)``.

    Fitted models are taken as they are, so one training serves many test sets.
    """

    def one(name: str) -> Transformer:
        est = estimators[name]
        return est.fit(train) if isinstance(est, Estimator) else est

    models = dict(zip(estimators, run_together(train.sparkSession, one, estimators, parallelism)))
    scored = test
    for name, model in models.items():
        kept = scored.columns
        scored = model.transform(scored).withColumnRenamed("prediction", f"_p_{name}").select(*kept, f"_p_{name}")
    picks = [F.struct(F.lit(name).alias("model"), F.col(f"_p_{name}").alias("prediction")) for name in models]
    # All models score in the same scan of the test rows; without any rows the accuracy is null.
    scores = accuracy(scored.select("label", F.inline(F.array(*picks))), by=["model"])
    names = train.sparkSession.createDataFrame([(name,) for name in models], "model string")
    return models, names.join(scores, "model", "left").select(
        "model", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "accuracy"
    )
