"""Screening, regression, classification and clustering of tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.categories import COUNTRY_GROUPS, KEPT_COUNTRIES, group_category
from plumbline.functions.encoding import assemble, encode_categories, fit_index, hashed_index, one_hot
from plumbline.functions.text import INDICATOR_STOP_WORDS, leading_ngram
from plumbline.models.clustering import KMeansSweep, fit_kmeans, kmeans_sweep, pin_points
from plumbline.models.estimators import SEED, tree_rules
from plumbline.models.metrics import (
    accuracy,
    positive_likelihood,
    rates_by_label,
    regression_metrics,
)
from plumbline.models.tuning import (
    ACTIVITY_GRID,
    LAPSE_GRID,
    PRICE_GRID,
    best_params,
    compare_models,
    param_grid,
    tune,
    validation_scores,
)
from plumbline.operators.aggregates import confusion_counts
from plumbline.operators.columns import (
    drop_columns,
    filter_expr,
    null_to_zero,
    ratio_column,
    require_columns,
    threshold_label,
)
from plumbline.operators.moments import table_moments
from plumbline.operators.splits import holdout_bucket
from plumbline.session import Report, owns_pins, pin
from plumbline.sources.tables import write_csv_table

TRAINING = "is_training"


@dataclass
class Screening(Report):
    description: DataFrame
    correlations: DataFrame
    kept: list[str]
    matrix: DataFrame


@dataclass
class TunedReport(Report):
    """A tuned model with its grid scores and the metrics of both parts."""

    model: Model
    metrics: DataFrame
    grid_scores: DataFrame
    best: DataFrame
    predictions: DataFrame
    extra: dict[str, DataFrame] = field(default_factory=dict)


@dataclass
class TreeReport(Report):
    models: dict[str, Model]
    accuracies: DataFrame
    rules: dict[str, DataFrame]
    holdout: DataFrame


@dataclass
class ClusterReport(Report):
    model: KMeansModel
    predictions: DataFrame
    sse: float
    silhouette: float


def mark_training(df: DataFrame, key: str | Sequence[str] | None, pct: int) -> DataFrame:
    """Flag the training rows, by key, so that both parts come from one scan."""
    return df.withColumn(TRAINING, holdout_bucket(df, key) < pct)


def encode_and_pin(
    df: DataFrame, label: str, cat_cols: Sequence[str], num_cols: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """``(is_training, label, features)`` as a stable table.

    The plain columns are written first, so what they come from runs once for
    the count of categories and the encoding.  Categories are counted on the
    training rows alone; others score as unknown.  ``buckets`` hashes them.
    """
    plain = df.select(TRAINING, F.col(label).cast("double").alias("label"), *cat_cols, *num_cols)
    vectors: list[str] = []
    if cat_cols:
        plain = pin(plain, "columns")
        plain, vectors = encode_categories(plain.where(TRAINING), plain, cat_cols, [f"{c}_vector" for c in cat_cols], buckets)
    features = assemble(plain, [*vectors, *num_cols])
    return pin(features.select(TRAINING, "label", "features"), "features")


def screen_features(
    df: DataFrame,
    label: str = "price",
    drop: Sequence[str] = (),
    weak: Sequence[str] | None = None,
    threshold: float = 0.1,
) -> Screening:
    """Describe a table, rate its columns against the label, and correlate those that stay.

    ``weak`` names the columns to leave out; without it the ones under
    ``threshold`` go.  Description, ratings and matrix come from one scan.
    """
    moments = table_moments(df)
    rated = [c for c in moments.cols if c not in drop]
    if weak is None:
        weak = moments.weaker_than(label, threshold, [c for c in rated if c != label])
    kept = drop_columns(df, [*drop, *weak])
    return Screening(
        moments.description(),
        moments.correlations_with(label, rated),
        kept.columns,
        moments.correlations([c for c in rated if c not in weak]),
    )


@owns_pins
def price_regression(
    df: DataFrame,
    label: str,
    cat_cols: Sequence[str],
    num_cols: Sequence[str],
    ratio: tuple[str, str, str] | None = None,
    key: str | Sequence[str] | None = None,
    pct: int = 80,
    grid: tuple[Sequence[float], Sequence[float]] = PRICE_GRID,
    train_ratio: float = 0.75,
    buckets: int | None = None,
    seed: int = SEED,
) -> TunedReport:
    """Tuned elastic-net regression with r2 and RMSE on training and hold-out rows.

    ``ratio`` is ``(numerator, divisor, name)`` of a derived column, zero where
    the divisor is.
    """
    if ratio:
        df = null_to_zero(ratio_column(df, *ratio), [ratio[2]], suffix="")
        num_cols = [*num_cols, ratio[2]]
    frame = encode_and_pin(mark_training(df, key, pct), label, cat_cols, num_cols, buckets)
    est = LinearRegression()
    tuned = tune(frame.where(TRAINING), est, param_grid(est, *grid), ratio=train_ratio, seed=seed)
    predictions = tuned.bestModel.transform(frame)
    return TunedReport(
        tuned.bestModel,
        regression_metrics(predictions, by=[TRAINING]),
        validation_scores(df, tuned),
        best_params(df, tuned),
        predictions,
    )


@owns_pins
def segment_by_kmeans(
    df: DataFrame,
    num_cols: Sequence[str],
    ratio: tuple[str, str, str] | None = None,
    ks: Sequence[int] = range(4, 10),
    seed: int = SEED,
) -> KMeansSweep:
    """Clusters of numeric columns for several ``k``, with sizes, SSE and silhouette."""
    if ratio:
        df = ratio_column(df, *ratio)
    frame = pin_points(assemble(df.select(*num_cols), num_cols).select("features"))
    return kmeans_sweep(frame, ks, seed=seed)


@owns_pins
def activity_forecast(
    df: DataFrame,
    label: str,
    cat_cols: Sequence[str],
    num_cols: Sequence[str],
    zero_filled: Sequence[str],
    condition: str = "is_cancelled = false",
    key: str | Sequence[str] | None = None,
    pct: int = 90,
    grid: tuple[Sequence[float], Sequence[float]] = ACTIVITY_GRID,
    train_ratio: float = 0.9,
    buckets: int | None = None,
    seed: int = SEED,
) -> TunedReport:
    """Next-period activity by tuned regression on encoded categories and numbers.

    ``zero_filled`` columns (the label among them) are used under their name
    with ``_cleaned`` behind it.  The hold-out is encoded as the training rows are.
    """
    df = null_to_zero(filter_expr(df, condition), zero_filled)
    df = df.withColumnRenamed(f"{label}_cleaned", "label").drop(*zero_filled)
    inputs = [f"{c}_cleaned" if c in zero_filled else c for c in num_cols]
    frame = encode_and_pin(mark_training(df, key, pct), "label", cat_cols, inputs, buckets)
    est = LinearRegression()
    tuned = tune(frame.where(TRAINING), est, param_grid(est, *grid), ratio=train_ratio, seed=seed)
    predictions = tuned.bestModel.transform(frame)
    return TunedReport(
        tuned.bestModel,
        regression_metrics(predictions, by=[TRAINING]),
        validation_scores(df, tuned),
        best_params(df, tuned),
        predictions,
    )


@owns_pins
def lapse_classifier(
    df: DataFrame,
    outcome: str,
    cat_cols: Sequence[str],
    num_cols: Sequence[str],
    zero_filled: Sequence[str] = (),
    condition: str = "is_cancelled = false",
    key: str | Sequence[str] | None = None,
    pct: int = 90,
    grid: tuple[Sequence[float], Sequence[float]] = LAPSE_GRID,
    train_ratio: float = 0.8,
    evaluator: Evaluator | None = None,
    buckets: int | None = None,
    seed: int = SEED,
) -> TunedReport:
    """Tuned logistic model of who goes quiet: label 1 when ``outcome`` is zero or missing.

    Chosen by accuracy unless an ``evaluator`` is given.  ``extra`` holds the
    hold-out's rates by label, likelihood of a positive, and confusion counts.
    """
    df = null_to_zero(filter_expr(df, condition), zero_filled)
    df = threshold_label(df, outcome, ">", 0, if_true=0, if_false=1)
    inputs = [f"{c}_cleaned" if c in zero_filled else c for c in num_cols]
    frame = encode_and_pin(mark_training(df, key, pct), "label", cat_cols, inputs, buckets)
    est = LogisticRegression()
    evaluator = evaluator or MulticlassClassificationEvaluator(metricName="accuracy")
    tuned = tune(frame.where(TRAINING), est, param_grid(est, *grid), evaluator, ratio=train_ratio, seed=seed)
    predictions = tuned.bestModel.transform(frame)
    holdout = predictions.where(~F.col(TRAINING))
    return TunedReport(
        tuned.bestModel,
        accuracy(predictions, by=[TRAINING]),
        validation_scores(df, tuned),
        best_params(df, tuned),
        predictions,
        {
            "rates": rates_by_label(holdout),
            "likelihood": positive_likelihood(holdout),
            "confusion": confusion_counts(holdout),
        },
    )


@owns_pins
def trial_conversion(
    df: DataFrame,
    category: str,
    paid: str,
    num_cols: Sequence[str],
    groups: Mapping[str, Iterable[str]] = COUNTRY_GROUPS,
    keep: Iterable[str] = KEPT_COUNTRIES,
    key: str | Sequence[str] | None = None,
    pct: int = 80,
    max_depth: int = 5,
    seed: int = SEED,
) -> TreeReport:
    """Who pays after a trial: a tree and a forest compared on the same hold-out."""
    df = threshold_label(group_category(df, category, groups, keep), paid, ">=", 1)
    df = mark_training(df, key, pct).select(TRAINING, F.col("label").cast("double").alias("label"), category, *num_cols)
    index = f"{category}_index"
    df = pin(df, "trial-columns")
    indexed = fit_index(df.where(TRAINING), [category]).transform(df, [category], [index], invalid="keep")
    frame = assemble(indexed, [index, *num_cols])
    frame = pin(frame.select(TRAINING, "label", "features"), "trials")
    estimators = {
        "decision_tree": DecisionTreeClassifier(maxDepth=max_depth, seed=seed),
        "random_forest": RandomForestClassifier(maxDepth=max_depth, seed=seed),
    }
    holdout = frame.where(~F.col(TRAINING))
    models, accuracies = compare_models(estimators, frame.where(TRAINING), holdout)
    return TreeReport(models, accuracies, {n: tree_rules(df, m) for n, m in models.items()}, holdout)


@owns_pins
def name_clustering(
    df: DataFrame,
    ident: str,
    name: str,
    category: str,
    not_null: Sequence[str] = (),
    equals: Mapping[str, object] | None = None,
    zero_filled: Sequence[str] = (),
    k: int = 210,
    buckets: int | None = None,
    words: Sequence[str] = INDICATOR_STOP_WORDS,
    out_path: str | None = None,
    seed: int = SEED,
) -> ClusterReport:
    """Cluster names by their leading trigram and one category.

    Names with the same trigram and category are the same point, so the model
    is fitted on the distinct points with their counts as weights.  Rows
    without a trigram drop out.  A vector has a place for every trigram; ``buckets``
    hashes them to that many where a centre of that width would not fit a task.
    ``out_path`` takes the clusters as CSV.
    """
    df = null_to_zero(require_columns(df, not_null, equals), zero_filled, suffix="")
    df = leading_ngram(df, name, 3, words).select(ident, name, "leading_ngram", category)
    rows = pin(df.where(F.col("leading_ngram").isNotNull() & F.col(category).isNotNull()), "names")
    indexes, vectors = ["_ngram_index", "_category_index"], ["_ngram_vector", "_category_vector"]
    names = ["leading_ngram", category]
    fitted = None if buckets else fit_index(rows, names)

    def encode(frame: DataFrame) -> DataFrame:
        frame = hashed_index(frame, names, indexes, buckets) if buckets else fitted.transform(frame, names, indexes, invalid="skip")
        return assemble(one_hot(frame, indexes, vectors), vectors).drop(*indexes, *vectors)

    points = pin(encode(rows.groupBy("leading_ngram", category).agg(F.count("*").alias("weight"))), "name-points")
    model = fit_kmeans(points, k, seed=seed, weightCol="weight")
    score = ClusteringEvaluator(weightCol="weight").evaluate(model.transform(points))
    # Every row is encoded and assigned where it is read, so no join back is needed.
    predictions = model.transform(encode(rows)).select(ident, name, "leading_ngram", "prediction")
    if out_path:
        write_csv_table(predictions.drop(ident), out_path)
    return ClusterReport(model, predictions, float(model.summary.trainingCost), float(score))
