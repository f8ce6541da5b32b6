"""K-means for several numbers of clusters over a table too large to cache: all models share each scan.

The method is that of Spark's ``KMeans``: k-means|| for the first centres (one point at
random, then some by their distance in each of a few steps, reduced to k by weighted
k-means++), then Lloyd's steps until no centre moves further than ``tol``.  Points are
packed once, and a scan sums per model and cluster before anything is shuffled.  First
centres differ from Spark's, whose random numbers follow its own partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.merging import States, accumulate, collected
from plumbline.session import pin

BLOCK = 1 << 13  # points compared with all centres at once
ROWS_READ = 16  # packed rows of a row group, which is read as a whole
LOCAL_STEPS = 30  # of k-means++, as in Spark


def _packed(df: DataFrame, features: str, weight: str | None) -> DataFrame:
    """A batch of points a row: their values and, behind those, their weight, as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                both = np.column_stack([x, batch.column(1).to_numpy(zero_copy_only=False)])
                yield pa.RecordBatch.from_arrays([pa.array([both.astype("<f8").tobytes()], pa.binary())], ["points"])

    number = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(vector_to_array(F.col(features)).alias("x"), number.alias("w"))
    return pin(rows.mapInArrow(run, "points binary"), "packed-points", **{"parquet.block.row.count.limit": ROWS_READ})


def _blocks(batches: Iterator[pa.RecordBatch], shift: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Points less ``shift``, and their weights."""
    for batch in batches:
        for raw in batch.column(0):
            both = np.frombuffer(raw.as_buffer(), "<f8").reshape(-1, len(shift) + 1)
            for at in range(0, len(both), BLOCK):
                part = both[at : at + BLOCK]
                yield part[:, :-1] - shift, part[:, -1]


def _apart(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances to the centres, less the squared norm of the point."""
    out = x @ (-2 * centers.T)
    out += (centers * centers).sum(axis=1)
    return out


def _cost(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum(_apart(x, centers).min(axis=1) + (x * x).sum(axis=1), 0)


def _sums(table: DataFrame, shift: np.ndarray, centers: dict[int, np.ndarray], of_block: Callable) -> dict[int, np.ndarray]:
    """``of_block(x, w, centers)`` of each model, summed over all points."""

    def make(batches: Iterator[pa.RecordBatch]) -> States:
        total: States = {}
        for x, w in _blocks(batches, shift):
            for k, own in centers.items():
                total[str(k)] = total.get(str(k), 0) + of_block(x, w, own)
        return total

    found = collected(accumulate(table, make, np.add))
    return {k: found[str(k)] for k in centers}


def _chosen(table: DataFrame, shift: np.ndarray, centers: dict[int, np.ndarray], scale: dict[int, float], seed: Sequence[int]) -> dict[int, np.ndarray]:
    """Points taken with a chance of ``scale`` times their cost, some for each model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng([*seed, TaskContext.get().partitionId()])
        for x, _ in _blocks(batches, shift):
            for k, own in centers.items():
                taken = x[draw.random(len(x)) < scale[k] * _cost(x, own)]
                if len(taken):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([taken.astype("<f8").tobytes()], pa.binary())], ["k", "points"])

    rows = table.mapInArrow(run, "k int, points binary").collect()  # about 2k points a model
    out = {k: [np.frombuffer(bytes(r["points"]), "<f8").reshape(-1, len(shift)) for r in rows if r["k"] == k] for k in centers}
    return {k: np.concatenate([np.zeros((0, len(shift))), *own]) for k, own in out.items()}


def _reduced(candidates: np.ndarray, weights: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """Weighted k-means++ of a few candidates."""
    centers = candidates[[draw.choice(len(candidates), p=weights / weights.sum())]]
    while len(centers) < k:
        mass = weights * _cost(candidates, centers)
        if not mass.sum() > 0:
            break
        centers = np.vstack([centers, candidates[draw.choice(len(candidates), p=mass / mass.sum())]])
    before = None
    for _ in range(LOCAL_STEPS):
        nearest = _apart(candidates, centers).argmin(axis=1)
        if before is not None and (nearest == before).all():
            break
        before = nearest
        for i in range(len(centers)):
            if weights[nearest == i].sum() > 0:
                centers[i] = np.average(candidates[nearest == i], axis=0, weights=weights[nearest == i])
    return centers


def _first_centers(table: DataFrame, shift: np.ndarray, ks: Sequence[int], seed: int, steps: int) -> dict[int, np.ndarray]:
    """k-means|| of all models; ``shift`` is the point at random that each begins with."""
    centers = {k: np.zeros((1, len(shift))) for k in ks}
    for step in range(steps):
        total = _sums(table, shift, centers, lambda x, w, own: np.array([_cost(x, own).sum()]))
        scale = {k: 2.0 * k / float(v[0]) if v[0] > 0 else 0.0 for k, v in total.items()}
        more = _chosen(table, shift, centers, scale, [seed & 0xFFFFFFFF, step])
        centers = {k: np.unique(np.vstack([own, more[k]]), axis=0) for k, own in centers.items()}
    counts = _sums(table, shift, centers, lambda x, w, own: np.bincount(_apart(x, own).argmin(axis=1), minlength=len(own)).astype(float))
    draw = np.random.default_rng(seed & 0xFFFFFFFF)
    return {k: own if len(own) <= k else _reduced(own, counts[k], k, draw) for k, own in centers.items()}


def _cluster_sums(x: np.ndarray, w: np.ndarray, centers: np.ndarray) -> np.ndarray:
    nearest, n = _apart(x, centers).argmin(axis=1), len(centers)
    return np.stack([*(np.bincount(nearest, c * w, n) for c in x.T), np.bincount(nearest, w, n)], axis=1).ravel()


def _model(df: DataFrame, k: int, centers: np.ndarray, features: str, seed: int, params: dict) -> KMeansModel:
    """Spark's own model of these centres."""
    context = df.sparkSession.sparkContext
    vector = context._jvm.org.apache.spark.mllib.linalg
    spots = context._gateway.new_array(vector.Vector, len(centers))
    for i, center in enumerate(centers):
        values = context._gateway.new_array(context._jvm.double, len(center))
        for j, value in enumerate(center.tolist()):
            values[j] = value
        spots[i] = vector.Vectors.dense(values)
    fit = KMeans(k=k, featuresCol=features, seed=seed, **params)
    made = context._jvm.org.apache.spark.ml.clustering.KMeansModel(fit.uid, context._jvm.org.apache.spark.mllib.clustering.KMeansModel(spots))
    return fit._copyValues(KMeansModel(made))


def fit_together(df: DataFrame, weight: str | None, ks: Sequence[int], features: str, seed: int, **params) -> dict[int, KMeansModel]:
    """A model for each of ``ks``; ``params`` may have Spark's ``maxIter``, ``tol`` and ``initSteps``."""
    table = _packed(df, features, weight)
    # One point at random, the same however the rows are dealt out.
    start = df.select(features).orderBy(F.xxhash64(F.lit(seed), features)).first()[0]
    shift = np.array(start.toArray(), np.float64)
    centers = _first_centers(table, shift, ks, seed, params.get("initSteps", 2))
    open_ = dict(centers)
    for _ in range(params.get("maxIter", 20)):
        for k, sums in _sums(table, shift, open_, _cluster_sums).items():
            sums = sums.reshape(len(centers[k]), -1)
            there = sums[:, -1] > 0
            moved = np.where(there[:, None], sums[:, :-1] / np.where(there, sums[:, -1], 1)[:, None], centers[k])
            still = (((moved - centers[k]) ** 2).sum(axis=1) <= params.get("tol", 1e-4) ** 2).all()
            centers[k] = moved
            open_.pop(k) if still else open_.update({k: moved})
        if not open_:
            break
    return {k: _model(df, k, own + shift, features, seed, params) for k, own in centers.items()}
