"""Spread and silhouette of many cluster models from two scans of the points.

The first scan gives, per model and cluster, the number of points, their sum and the
sum of their squared norms.  The squared distance of a point to all points of a cluster
follows from these alone, so the second scan has the silhouette of every model, and the
spread around given centres needs no scan of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.merging import States, accumulate, collected

BATCH = 1 << 20  # distances held at once


@dataclass(frozen=True)
class Moments:
    """Per cluster of one model: points, sums and squared norms, of points less ``shift``."""

    shift: np.ndarray
    counts: np.ndarray
    sums: np.ndarray
    squares: np.ndarray

    def spread(self, centers: np.ndarray) -> float:
        """Squared distances of all points to the centre of their cluster."""
        c = centers - self.shift
        own = self.squares - 2 * (c * self.sums).sum(axis=1) + self.counts * (c * c).sum(axis=1)
        return float(np.maximum(own, 0).sum())

    def silhouettes(self, points: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        """Of each point, as ``ClusteringEvaluator`` defines it: 0 where a point is alone in its cluster."""
        x = points - self.shift
        there = self.counts > 0
        n = np.maximum(self.counts, 1)
        apart = (x * x).sum(axis=1)[:, None] + self.squares / n - 2 * x @ (self.sums / n[:, None]).T
        rows = np.arange(len(x))
        size = self.counts[cluster]
        own = np.maximum(apart[rows, cluster], 0) * size / np.maximum(size - 1, 1)
        apart[:, ~there] = np.inf
        apart[rows, cluster] = np.inf
        other = np.maximum(apart.min(axis=1), 0)
        sound = (size > 1) & np.isfinite(other) & (np.maximum(own, other) > 0)
        other = np.where(sound, other, 1)
        return np.where(sound, (other - own) / np.maximum(own, other), 0)


def _assigned(df: DataFrame, models: Mapping[int, KMeansModel], features: str, weight: str | None) -> DataFrame:
    """The points as arrays, their weights and the cluster that each model gives them, all from the same scan."""
    names = [f"_k{k}" for k in models]
    for name, model in zip(names, models.values()):
        df = model.copy().setPredictionCol(name).setFeaturesCol(features).transform(df)
    number = F.col(weight).cast("double") if weight else F.lit(1.0)
    return df.select(vector_to_array(F.col(features)).alias("x"), number.alias("w"), *names)


def _points(batch: pa.RecordBatch, widest: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Points, their weights, and a column of clusters per model, a bounded number at a time."""
    if not batch.num_rows:
        return
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    weights, *clusters = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
    step = max(1, BATCH // max(widest, x.shape[1]))
    for at in range(0, len(x), step):
        part = slice(at, at + step)
        yield x[part], weights[part], [c[part] for c in clusters]


def cluster_moments(df: DataFrame, models: Mapping[int, KMeansModel], features: str = "features", weight: str | None = None) -> dict[int, Moments]:
    """Moments of every model's clusters, from one scan; ``weight`` names how many times a row counts."""
    sizes = {k: len(m.clusterCenters()) for k, m in models.items()}
    # Distances do not change when all points move; near zero they lose no digits.
    shift = np.mean([c for m in models.values() for c in m.clusterCenters()], axis=0)

    def make(batches: Iterator[pa.RecordBatch]) -> States:
        total: States = {}
        for batch in batches:
            for x, weights, clusters in _points(batch, max(sizes.values())):
                x = x - shift
                side = np.hstack([np.ones((len(x), 1)), x, (x * x).sum(axis=1)[:, None]])
                for (k, n), cluster in zip(sizes.items(), clusters):
                    own = np.zeros((n, len(x)))
                    own[cluster, np.arange(len(x))] = weights
                    total[str(k)] = total.get(str(k), 0) + (own @ side).ravel()
        return total

    found = collected(accumulate(_assigned(df, models, features, weight), make, np.add))
    out = {}
    for k, n in sizes.items():
        state = found.get(str(k), np.zeros(n * (len(shift) + 2))).reshape(n, -1)
        out[k] = Moments(shift, state[:, 0], state[:, 1:-1], state[:, -1])
    return out


def mean_silhouettes(
    df: DataFrame, models: Mapping[int, KMeansModel], moments: Mapping[int, Moments], features: str = "features", weight: str | None = None
) -> dict[int, float | None]:
    """The mean silhouette of every model, from one scan; None for a model of one cluster or no points."""
    keys = list(models)

    def make(batches: Iterator[pa.RecordBatch]) -> States:
        total: States = {}
        for batch in batches:
            for x, weights, clusters in _points(batch, max(len(m.counts) for m in moments.values())):
                for k, cluster in zip(keys, clusters):
                    own = moments[k].silhouettes(x, cluster)
                    total[str(k)] = total.get(str(k), 0) + np.array([weights.sum(), weights @ own])
        return total

    found = collected(accumulate(_assigned(df, models, features, weight), make, np.add))
    some = {k: (moments[k].counts > 0).sum() > 1 and str(k) in found for k in keys}
    return {k: float(found[str(k)][1] / found[str(k)][0]) if some[k] else None for k in keys}
