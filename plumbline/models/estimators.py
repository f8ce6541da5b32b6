"""Estimators of Spark ML with the defaults of the jobs in ``plans``."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42


def fit_linear_regression(df: DataFrame, reg: float = 0.0, enp: float = 0.0, **params) -> Model:
    """Linear regression with an elastic-net penalty."""
    return LinearRegression(regParam=reg, elasticNetParam=enp, **params).fit(df)


def fit_logistic_regression(df: DataFrame, reg: float = 0.0, enp: float = 0.0, **params) -> Model:
    """Logistic regression with an elastic-net penalty."""
    return LogisticRegression(regParam=reg, elasticNetParam=enp, **params).fit(df)


def fit_decision_tree(df: DataFrame, max_depth: int = 5, **params) -> Model:
    """Gini tree.  Give ``maxBins`` when an indexed category has more than 32 values."""
    return DecisionTreeClassifier(**{"maxDepth": max_depth, "seed": SEED, **params}).fit(df)


def fit_random_forest(df: DataFrame, max_depth: int = 5, **params) -> Model:
    return RandomForestClassifier(**{"maxDepth": max_depth, "seed": SEED, **params}).fit(df)


def fit_forest_regression(df: DataFrame, **params) -> Model:
    """Forest on a numeric label, such as 0/1 image classes."""
    return RandomForestRegressor(**{"seed": SEED, **params}).fit(df)


def fit_naive_bayes(df: DataFrame, smoothing: float = 1.0, **params) -> Model:
    """Multinomial naive Bayes on non-negative features."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial", **params).fit(df)


def fit_linear_svm(df: DataFrame, iterations: int = 100, reg: float = 0.01, **params) -> Model:
    """Linear SVM on labels 0 and 1, hinge loss, without intercept.

    Spark's solver and its L2 penalty: weights differ from those of stochastic descent.
    """
    return LinearSVC(maxIter=iterations, regParam=reg, fitIntercept=False, standardization=False, **params).fit(df)


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Score rows with a fitted model."""
    return model.transform(df)


def naive_bayes_weights(df: DataFrame, model: Model) -> DataFrame:
    """Class priors and feature weights as rows ``(label, feature, pi, theta)``."""
    rows = [(label, float(pi), theta.tolist()) for label, (pi, theta) in enumerate(zip(model.pi.toArray(), model.theta.toArray()))]
    per_label = df.sparkSession.createDataFrame(rows, "label int, pi double, weights array<double>")
    spread = per_label.select("label", "pi", F.posexplode("weights").alias("feature", "theta"))
    return spread.select("label", "feature", "pi", "theta")


def tree_rules(df: DataFrame, model: Model) -> DataFrame:
    """The rules of a tree or forest as text lines ``(line, rule)``."""
    lines = list(enumerate(model.toDebugString.splitlines()))
    return df.sparkSession.createDataFrame(lines, "line int, rule string")


def linear_weights(df: DataFrame, model: Model) -> DataFrame:
    """Intercept and coefficients of a linear model as rows ``(term, value)``."""
    rows = [("intercept", float(model.intercept))]
    rows += [(f"x{i}", float(c)) for i, c in enumerate(model.coefficients.toArray())]
    return df.sparkSession.createDataFrame(rows, "term string, value double")
