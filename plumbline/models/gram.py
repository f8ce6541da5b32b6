"""Elastic-net regression on a whole grid from one pass over the rows.

A task sums centred products of the features and the label, per split, in blocks of
columns; sums merge exactly where means are far from zero.  Every grid point is then
solved on the merged products alone, by coordinate descent that starts from the point
before, and scored on those of the validation split; no other scan is made.  The
products take ``features * features`` numbers on the driver, so this way is for up to
MAX_FEATURES features, as Spark's own normal solver is.

The objective is that of ``LinearRegression`` with its defaults: half the mean squared
residual, and penalties on coefficients of standardised features and label.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.merging import States, accumulate, collected

MAX_FEATURES = 4096
BLOCK = 512  # columns of a block of products
SWEEPS, TOLERANCE = 20_000, 1e-13
BATCH = 1 << 21  # numbers centred at once


@dataclass(frozen=True)
class Gram:
    """Rows, means, and centred products of the features and, last, the label."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        n = self.n + other.n
        apart = other.mean - self.mean
        weight = self.n * other.n / n
        return Gram(n, self.mean + apart * (other.n / n), self.products + other.products + weight * np.outer(apart, apart))

    @property
    def features(self) -> int:
        return len(self.mean) - 1

    def errors(self, intercept: float, weights: np.ndarray) -> tuple[float, float]:
        """Sums of squared residuals and of squared deviations of the label."""
        side = np.append(weights, -1.0)
        off = intercept + side @ self.mean
        return max(float(side @ self.products @ side) + self.n * off * off, 0.0), float(self.products[-1, -1])


def _block_state(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``rows, width, height, means, means, products`` of two blocks of columns."""
    a, b = x.mean(axis=0), y.mean(axis=0)
    return np.concatenate([[len(x), x.shape[1], y.shape[1]], a, b, ((x - a).T @ (y - b)).ravel()])


def _parts(state: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    n, width, height = float(state[0]), int(state[1]), int(state[2])
    return n, state[3 : 3 + width], state[3 + width : 3 + width + height], state[3 + width + height :].reshape(width, height)


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    (n, ax, ay, ap), (m, bx, by, bp) = _parts(a), _parts(b)
    total = n + m
    x, y = bx - ax, by - ay
    products = ap + bp + np.outer(x, y) * (n * m / total)
    return np.concatenate([[total, *a[1:3]], ax + x * (m / total), ay + y * (m / total), products.ravel()])


def gram_states(df: DataFrame, split: Column, features: str = "features", label: str = "label") -> DataFrame:
    """Merged products ``(key, state)`` of each split (an integer) and pair of column blocks."""
    rows = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"), split.cast("int").alias("split"))

    def make(batches: Iterator[pa.RecordBatch]) -> States:
        total: States = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y, of = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            step = max(1, BATCH // (x.shape[1] + 1))
            for at in range(0, len(x), step):
                z = np.hstack([x[at : at + step], y[at : at + step, None]])
                for own in np.unique(of[at : at + step]).tolist():
                    part = z[of[at : at + step] == own]
                    for i in range(0, z.shape[1], BLOCK):
                        for j in range(i, z.shape[1], BLOCK):
                            key, state = f"{own}:{i}:{j}", _block_state(part[:, i : i + BLOCK], part[:, j : j + BLOCK])
                            total[key] = _merge(total[key], state) if key in total else state
        return total

    return accumulate(rows, make, _merge)


def grams(df: DataFrame, split: Column, features: str = "features", label: str = "label") -> dict[int, Gram]:
    """The products of each split, from one scan."""
    found: dict[int, dict[tuple[int, int], np.ndarray]] = {}
    for key, state in collected(gram_states(df, split, features, label)).items():
        own, i, j = map(int, key.split(":"))
        found.setdefault(own, {})[i, j] = state
    return {own: _whole(blocks) for own, blocks in sorted(found.items())}


def _whole(blocks: dict[tuple[int, int], np.ndarray]) -> Gram:
    parts = {at: _parts(state) for at, state in blocks.items()}
    starts = sorted({i for i, _ in parts})
    mean = np.concatenate([parts[i, i][1] for i in starts])
    products = np.empty((len(mean), len(mean)))
    for (i, j), (_, _, _, block) in parts.items():
        products[i : i + block.shape[0], j : j + block.shape[1]] = block
        products[j : j + block.shape[1], i : i + block.shape[0]] = block.T
    return Gram(parts[0, 0][0], mean, products)


@dataclass(frozen=True)
class Fit:
    reg: float
    enp: float
    intercept: float
    weights: np.ndarray


class Standardised:
    """Correlations of the features with each other and the label; a feature that does not vary stays out."""

    def __init__(self, gram: Gram):
        self.gram = gram
        spread = np.sqrt(np.maximum(np.diag(gram.products) / gram.n, 0))
        self.label_spread = float(spread[-1])
        self.spread = spread[:-1]
        varies = self.spread > 0
        scale = np.where(varies, self.spread, 1.0)
        self.inner = np.where(np.outer(varies, varies), gram.products[:-1, :-1] / gram.n / np.outer(scale, scale), 0)
        self.outer = np.where(varies, gram.products[:-1, -1] / gram.n / scale / (self.label_spread or 1.0), 0)
        self.scale, self.varies = scale, varies

    def solve(self, reg: float, enp: float, start: np.ndarray) -> np.ndarray:
        """Standardised weights of one grid point, from those of another."""
        if not self.label_spread:
            return np.zeros_like(start)
        pull, ridge = enp * reg / self.label_spread, (1 - enp) * reg / self.label_spread
        if not pull:
            return self._closed(ridge)
        w = start.copy()
        fitted = self.inner @ w
        diagonal = np.diag(self.inner)
        places = np.flatnonzero(self.varies)
        for sweep in range(SWEEPS):
            # Every few sweeps all features, in between those with a weight.
            some = places if sweep % 8 == 0 else places[w[places] != 0]
            moved = 0.0
            for k in some.tolist():
                open_ = self.outer[k] - fitted[k] + diagonal[k] * w[k]
                new = np.sign(open_) * max(abs(open_) - pull, 0.0) / (diagonal[k] + ridge)
                step = new - w[k]
                if step:
                    fitted += self.inner[:, k] * step
                    w[k] = new
                    moved = max(moved, abs(step))
            if moved <= TOLERANCE and sweep % 8 == 0:
                break
        return w

    def _closed(self, ridge: float) -> np.ndarray:
        w = np.zeros(len(self.outer))
        own = np.flatnonzero(self.varies)
        inner = self.inner[np.ix_(own, own)] + ridge * np.eye(len(own))
        w[own] = np.linalg.lstsq(inner, self.outer[own], rcond=1e-12)[0] if not ridge else np.linalg.solve(inner, self.outer[own])
        return w

    def unscaled(self, reg: float, enp: float, w: np.ndarray) -> Fit:
        weights = w * self.label_spread / self.scale
        mean = self.gram.mean
        return Fit(reg, enp, float(mean[-1] - weights @ mean[:-1]), weights)


def elastic_net_path(gram: Gram, points: Sequence[tuple[float, float]]) -> list[Fit]:
    """A fit for each ``(reg, enp)``, in the given order; solved from the strongest penalty down."""
    own = Standardised(gram)
    found: dict[tuple[float, float], Fit] = {}
    w = np.zeros(gram.features)
    for reg, enp in sorted(set(points), key=lambda p: (-p[0] * p[1], -p[0])):
        w = own.solve(reg, enp, w)
        found[reg, enp] = own.unscaled(reg, enp, w)
    return [found[p] for p in points]


def score(gram: Gram, fit: Fit, metric: str) -> float:
    """A metric of ``RegressionEvaluator`` that products determine: r2, rmse, mse or var."""
    residual, spread = gram.errors(fit.intercept, fit.weights)
    if metric == "r2":
        return 1 - residual / spread if spread else float("nan")
    if metric == "var":
        side = np.append(fit.weights, 0.0)
        off = fit.intercept + side @ gram.mean - gram.mean[-1]
        return float(side @ gram.products @ side) / gram.n + float(off * off)
    return residual / gram.n if metric == "mse" else float(np.sqrt(residual / gram.n))


METRICS = ("r2", "rmse", "mse", "var")
