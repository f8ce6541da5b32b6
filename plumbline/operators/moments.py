"""Co-moments of pairs of columns, nulls left out pair by pair, from one pass over the rows.

A state of a block of columns against another holds, for each pair, how many rows
have both values, both means over those rows, both sums of squared deviations and
the sum of products of deviations.  Two states merge entry by entry, without loss
where means are far from zero.  No row is ever written out per column or per pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.merging import States, accumulate, collected

BLOCK = 128  # columns of a block

# Places of the values of a pair.
ROWS, MEAN, OTHER_MEAN, SQUARES, OTHER_SQUARES, PRODUCTS, ODD = range(7)
# Places of the values of a column.
COUNT, AVERAGE, DEVIATION, LEAST, MOST, ODD_SUM = range(6)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _pair_state(x: np.ndarray, y: np.ndarray, x_there: np.ndarray, y_there: np.ndarray) -> np.ndarray:
    """Of all pairs of a column of ``x`` and one of ``y``; values that are not finite make a pair odd."""
    x, x_odd, x_centre = _centred(x, x_there)
    y, y_odd, y_centre = _centred(y, y_there)
    v, w = x_there.astype(np.float64), y_there.astype(np.float64)
    rows = v.T @ w
    x_sum, y_sum = x.T @ w, v.T @ y
    safe = np.maximum(rows, 1)
    x_mean, y_mean = x_sum / safe, y_sum / safe
    out = np.empty((7, x.shape[1], y.shape[1]))
    out[ROWS] = rows
    out[MEAN], out[OTHER_MEAN] = x_centre[:, None] + x_mean, y_centre[None, :] + y_mean
    out[SQUARES] = np.maximum((x * x).T @ w - x_sum * x_mean, 0)
    out[OTHER_SQUARES] = np.maximum(v.T @ (y * y) - y_sum * y_mean, 0)
    out[PRODUCTS] = x.T @ y - x_sum * y_mean
    out[ODD] = x_odd.T @ w + v.T @ y_odd
    return out


def _centred(x: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deviations from the block's mean (zero where absent or not finite), the flags of the latter, and the mean."""
    sound = there & np.isfinite(x)
    x = np.where(sound, x, 0)
    least = np.where(sound, x, np.inf).min(axis=0, initial=np.inf)
    most = np.where(sound, x, -np.inf).max(axis=0, initial=-np.inf)
    mean = x.sum(axis=0) / np.maximum(sound.sum(axis=0), 1)
    centre = np.where(least == most, np.where(np.isfinite(least), least, 0), mean)  # a constant deviates by exactly zero
    return np.where(sound, x - centre, 0), (there & ~sound).astype(np.float64), centre


def _merge_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[ROWS] + b[ROWS]
    part = b[ROWS] / np.maximum(n, 1)
    apart, other_apart, weight = b[MEAN] - a[MEAN], b[OTHER_MEAN] - a[OTHER_MEAN], a[ROWS] * part
    out = a + b
    # A side without rows has a meaningless mean, and weight zero.
    out[MEAN], out[OTHER_MEAN] = np.where(a[ROWS] > 0, a[MEAN] + apart * part, b[MEAN]), np.where(a[ROWS] > 0, a[OTHER_MEAN] + other_apart * part, b[OTHER_MEAN])
    out[SQUARES] += apart * apart * weight
    out[OTHER_SQUARES] += other_apart * other_apart * weight
    out[PRODUCTS] += apart * other_apart * weight
    return out


def _column_state(x: np.ndarray, there: np.ndarray) -> np.ndarray:
    off, odd, centre = _centred(x, there)
    n = there.sum(axis=0).astype(np.float64)
    mean = off.sum(axis=0) / np.maximum(n, 1)
    least = np.fmin.reduce(np.where(there, x, np.nan), axis=0, initial=np.nan)  # not a number is above all others
    most = np.where(there, x, -np.inf).max(axis=0, initial=-np.inf)
    odd_sum = np.where(odd > 0, x, 0).sum(axis=0)
    return np.stack([n, centre + mean, np.maximum((off * off).sum(axis=0) - n * mean * mean, 0), least, most, odd_sum])


def _merge_columns(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[COUNT] + b[COUNT]
    part = b[COUNT] / np.maximum(n, 1)
    apart = b[AVERAGE] - a[AVERAGE]
    out = a + b
    out[AVERAGE] = np.where(a[COUNT] > 0, a[AVERAGE] + apart * part, b[AVERAGE])
    out[DEVIATION] += apart * apart * a[COUNT] * part
    out[LEAST], out[MOST] = np.fmin(a[LEAST], b[LEAST]), np.maximum(a[MOST], b[MOST])
    return out


# A flat state says what it is of: 0 for columns, 1 for pairs, and its shape.


def _flat(kind: int, state: np.ndarray) -> np.ndarray:
    return np.concatenate([[kind, *state.shape], state.ravel()])


def _shaped(flat: np.ndarray) -> np.ndarray:
    sides = 3 if flat[0] else 2
    return flat[1 + sides :].reshape(flat[1 : 1 + sides].astype(int))


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _flat(int(a[0]), (_merge_pairs if a[0] else _merge_columns)(_shaped(a), _shaped(b)))


def _blocks(cols: Sequence[str]) -> list[slice]:
    return [slice(at, min(at + BLOCK, len(cols))) for at in range(0, len(cols), BLOCK)]


def states_of(df: DataFrame, cols: Sequence[str], others: Sequence[str] | None = None, pairs: bool = True, null_as_zero: bool = False) -> DataFrame:
    """Merged states ``(key, state)``, keyed ``c`` and the block for columns, ``p`` and two blocks for pairs.

    With ``others``, pairs are those of a column with one of these; without, every pair of columns once.
    """
    cols = list(cols)
    whole = [*cols, *[c for c in (others or []) if c not in cols]]
    right = [whole.index(c) for c in others] if others is not None else None
    zero = F.lit(0.0)
    values = [F.col(f"`{c}`").cast("double") for c in whole]
    rows = df.select([(F.coalesce(v, zero) if null_as_zero else v).alias(f"c{k}") for k, v in enumerate(values)])
    left = _blocks(cols)

    def make(batches: Iterator[pa.RecordBatch]) -> States:
        total: States = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            there = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            for i, a in enumerate(left):
                _add(total, f"c{i}", 0, _column_state(x[:, a], there[:, a]))
                if pairs and right is not None:
                    _add(total, f"p{i}:0", 1, _pair_state(x[:, a], x[:, right], there[:, a], there[:, right]))
                elif pairs:
                    for j in range(i, len(left)):
                        b = left[j]
                        _add(total, f"p{i}:{j}", 1, _pair_state(x[:, a], x[:, b], there[:, a], there[:, b]))
        return total

    return accumulate(rows, make, _merge)


def _add(total: States, key: str, kind: int, state: np.ndarray) -> None:
    own = _flat(kind, state)
    total[key] = _merge(total[key], own) if key in total else own


def _correlations(state: np.ndarray) -> np.ndarray:
    """Pearson's r of each pair; NaN stands for none (a masked null), also where a side does not vary."""
    spread = np.sqrt(state[SQUARES]) * np.sqrt(state[OTHER_SQUARES])
    return np.where((spread > 0) & (state[ODD] == 0), state[PRODUCTS] / np.where(spread > 0, spread, 1), np.nan)


def _null_where(values: np.ndarray, absent: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=absent)


def correlation_rows(states: DataFrame, cols: Sequence[str], others: Sequence[str] | None = None) -> DataFrame:
    """``(column, other, correlation)`` of every pair, both ways round without ``others``; null without two varying sides."""
    left, names, right = _blocks(cols), list(cols), list(others) if others is not None else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key[0] != "p":
                    continue
                state = _shaped(np.frombuffer(raw.as_buffer(), np.float64))
                i, j = map(int, key[1:].split(":"))
                a, b = names[left[i]], right if right is not None else names[left[j]]
                r, odd = _correlations(state), state[ODD] > 0
                sides = [(a, b, r, odd)] + ([(b, a, r.T, odd.T)] if right is None and i != j else [])
                for x, y, value, strange in sides:
                    flat = value.ravel()
                    absent = np.isnan(flat) & ~strange.ravel()
                    one, two = np.repeat(np.array(x, object), len(y)), np.tile(np.array(y, object), len(x))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one, pa.string()), pa.array(two, pa.string()), _null_where(flat, absent)], ["column", "other", "correlation"]
                    )

    return states.mapInArrow(read, "column string, other string, correlation double")


STATS = ["count", "mean", "stddev", "min", "max"]


def description_rows(states: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, stat, value)`` of every column; null where there are too few values."""
    left, names = _blocks(cols), list(cols)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key[0] != "c":
                    continue
                own = names[left[int(key[1:])]]
                values, absent = _described(_shaped(np.frombuffer(raw.as_buffer(), np.float64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for c in own for _ in STATS], pa.string()),
                        pa.array(STATS * len(own), pa.string()),
                        _null_where(values.T.ravel(), absent.T.ravel()),
                    ],
                    ["column", "stat", "value"],
                )

    return states.mapInArrow(read, "column string, stat string, value double")


def _described(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values in the order of STATS and which of them are absent."""
    n, odd = state[COUNT], state[ODD_SUM]
    strange = (odd != 0) | np.isnan(odd)
    mean = np.where(strange, odd, state[AVERAGE])
    spread = np.where(strange, np.nan, np.sqrt(state[DEVIATION] / np.maximum(n - 1, 1)))
    values = np.stack([n, mean, spread, np.where(n > 0, state[LEAST], 0), np.where(n > 0, state[MOST], 0)])
    absent = np.stack([n < 0, n < 1, n < 2, n < 1, n < 1])
    return values, absent


@dataclass(frozen=True)
class TableMoments:
    """Merged states of a table's columns on the driver: reports of any of them need no other scan."""

    df: DataFrame
    cols: tuple[str, ...]
    states: States

    def _frame(self) -> DataFrame:
        rows = [(key, state.tobytes()) for key, state in sorted(self.states.items())]
        return self.df.sparkSession.createDataFrame(rows, "key string, state binary")

    def correlations(self, cols: Sequence[str]) -> DataFrame:
        """``(column, other, correlation)`` of every pair of the given columns."""
        found = correlation_rows(self._frame(), self.cols)
        return found.where(F.col("column").isin(list(cols)) & F.col("other").isin(list(cols)))

    def correlations_with(self, label: str, cols: Sequence[str]) -> DataFrame:
        found = correlation_rows(self._frame(), self.cols).where(F.col("other") == label)
        return found.where(F.col("column").isin(list(cols))).select("column", "correlation")

    def description(self) -> DataFrame:
        return description_rows(self._frame(), self.cols)

    def weaker_than(self, label: str, threshold: float, cols: Sequence[str]) -> list[str]:
        """Columns whose correlation with the label is missing or below ``threshold``."""
        place = {c: k for k, c in enumerate(self.cols)}
        weak = []
        for c in cols:
            i, j = sorted((place[c], place[label]))
            r = _correlations(_shaped(self.states[f"p{i // BLOCK}:{j // BLOCK}"]))[i % BLOCK, j % BLOCK] if self.states else np.nan
            if not abs(r) >= threshold:
                weak.append(c)
        return weak


def table_moments(df: DataFrame, cols: Sequence[str] | None = None) -> TableMoments:
    """All columns and pairs of a table in one scan; the driver gets numbers per pair of columns."""
    cols = tuple(cols or numeric_columns(df))
    return TableMoments(df, cols, collected(states_of(df, cols)))
