"""K-means and its reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.models.cluster_moments import cluster_moments, mean_silhouettes
from plumbline.models.estimators import SEED
from plumbline.models.shared_kmeans import fit_together
from plumbline.session import CACHED_AT_ONCE, Report, fits_at_once, pin, run_together

WEIGHT = "_weight"
REPEATS = 4  # rows a distinct point, from which fits take the distinct points
POINTS_PER_FILE = 1 << 17  # a fit caches about 100 bytes a point and more for each partition it reads
SHARED_PARAMS = {"initSteps", "maxIter", "tol"}  # with which all models may share scans
POINT_BYTES = 96  # what a fit caches of a point, besides 8 bytes a value


def pin_points(points: DataFrame, name: str = "points") -> DataFrame:
    """Points pinned in files of bounded rows, so that no task of a fit caches more than some millions."""
    return pin(points, name, POINTS_PER_FILE)


def distinct_points(df: DataFrame, features: str = "features") -> tuple[DataFrame, str | None]:
    """What to fit on: the distinct points and the column of their numbers where rows repeat, else ``df`` and None.

    Both have the same objective.  One scan estimates whether the rows repeat; a table
    of mostly different points is never shuffled.
    """
    rows, distinct = df.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(features))).first()
    if rows < REPEATS * max(distinct, 1):
        return df, None
    points = df.groupBy(features).agg(F.count("*").cast("double").alias(WEIGHT))
    # The first centres depend on the order of the points: keep it the same in every run.
    return pin_points(points.sortWithinPartitions(F.xxhash64(features)), "distinct-points"), WEIGHT


def _fit(points: DataFrame, weight: str | None, k: int, features: str, seed: int, params: Mapping) -> KMeansModel:
    weighted = {"weightCol": weight} if weight else {}
    return KMeans(k=k, featuresCol=features, seed=seed, **weighted, **params).fit(points)


def fit_kmeans(df: DataFrame, k: int, features: str = "features", seed: int = SEED, **params) -> KMeansModel:
    """K-means; with fewer distinct points than ``k`` the model has fewer clusters.

    Rows that repeat are fitted as distinct points with weights (the model's summary is
    of those then), unless the caller gives a ``weightCol``.
    """
    points, weight = (df, None) if "weightCol" in params else distinct_points(df, features)
    return _fit(points, weight, k, features, seed, params)


def cluster_centers(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Centres as rows ``(cluster, center)``."""
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cluster int, center array<double>")


def clustering_sse(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Squared distance of the training rows to their centres."""
    return df.sparkSession.createDataFrame([(float(model.summary.trainingCost),)], "sse double")


@dataclass
class KMeansSweep(Report):
    """Models of several ``k`` with their scores, sizes and centres."""

    models: Mapping[int, KMeansModel]
    scores: DataFrame
    sizes: DataFrame
    centers: DataFrame


def kmeans_sweep(
    df: DataFrame,
    ks: Sequence[int] = range(4, 10),
    features: str = "features",
    seed: int = SEED,
    parallelism: int | None = None,
    **params,
) -> KMeansSweep:
    """Fit k-means for each ``k`` over one stable frame (a scan or a pinned table).

    Several fits run at once while the data is small, see ``fits_at_once``.  Points of
    which a fit would cache more than ``CACHED_AT_ONCE`` are scanned for all models
    together, see ``shared_kmeans``.  Sizes,
    spread and silhouette of all models take two scans together.  Rows that repeat
    are held once, with their number, by fits and scans alike.
    """
    spark = df.sparkSession
    ks = list(ks)
    points, weight = (df, None) if "weightCol" in params else distinct_points(df, features)
    first = points.select(features).first()
    cached = points.count() * (POINT_BYTES + 8 * len(first[0])) if first else 0
    if cached > CACHED_AT_ONCE and params.keys() <= SHARED_PARAMS:
        models = fit_together(points, weight, ks, features, seed, **params)
    else:
        fit = lambda k: _fit(points, weight, k, features, seed, params)
        models = dict(zip(ks, run_together(spark, fit, ks, parallelism or fits_at_once(points, cached))))
    moments = cluster_moments(points, models, features, weight)
    shapes = mean_silhouettes(points, models, moments, features, weight)
    centers = {k: np.array(model.clusterCenters()) for k, model in models.items()}
    scores = [(k, len(centers[k]), moments[k].spread(centers[k]), shapes[k]) for k in ks]
    sizes = [(k, i, int(n)) for k in ks for i, n in enumerate(moments[k].counts) if n]
    spots = [(k, i, center.tolist()) for k in ks for i, center in enumerate(centers[k])]
    return KMeansSweep(
        models,
        spark.createDataFrame(scores, "k int, clusters int, sse double, silhouette double"),
        spark.createDataFrame(sizes, "k int, prediction int, count long"),
        spark.createDataFrame(spots, "k int, cluster int, center array<double>"),
    )
