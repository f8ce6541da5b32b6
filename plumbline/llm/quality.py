"""Quality by random Fourier features of document statistics, ridge scores and isotonic calibration.

A text becomes some statistics of its whole: shares of kinds of signs and of what follows
what, of words that repeat the one before them, of distinct words and lines, and lengths.
They are standardised, and FEATURES random cosines of them approximate a Gaussian kernel.
Each task sums its part of the normal equations, one for each of FOLDS folds; the sums are
added FAN_IN at a time in Spark, and the driver solves the ridge of a few penalties from
them.  Leaving out one fold is a subtraction, so the penalty is the one of least squared
error on left-out folds, without another pass.  Values of left-out rows, counted in BINS
fixed steps, give an isotonic curve (pool adjacent violators) that turns a value into a
score.

All labelled rows that are not held out take part.  The statistics, the kernel width and
the penalties were chosen on such rows alone, by those folds.

Defined cases: a null text counts as empty, and an empty one has zero statistics and the
score the model gives to those; without labels of both kinds every text gets the share
of label 1 (0 without labels); null labels and ids are left out of the fit; repeated
labels of one id count once, as the largest; repeated rows get equal scores, and a null id
is scored and never held out.  Columns other than id and text never take part in a score.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tokens import texts_of
from plumbline.session import pin

THRESHOLD = 0.7
FEATURES, WIDTH, SEED = 256, 8.0, 20_011
PENALTIES = (1e-3, 1e-2, 1e-1, 1.0)
FOLDS, FAN_IN, BINS = 3, 64, 2048
LOW, HIGH = -0.5, 1.5  # ridge values outside count as these
GROUP = 1 << 21  # characters whose statistics are taken at once

# Kinds of signs.
SPACE, LINE, LOWER, UPPER, DIGIT, STOP, MARK, SIGN = range(8)
KINDS = 8
STOPS, MARKS = ".,;:'\"’“”«»()-", "!?¡¿"


def _kind(c: str) -> int:
    if c in "\n\r":
        return LINE
    if c.isspace():
        return SPACE
    if c in STOPS:
        return STOP
    if c in MARKS:
        return MARK
    group = unicodedata.category(c)
    if group in ("Lu", "Lt"):
        return UPPER
    return LOWER if group[0] in "LM" else DIGIT if group[0] == "N" else SIGN


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each code below 65,536; signs above count as SIGN."""
    return np.array([_kind(chr(c)) for c in range(1 << 16)] + [SIGN], np.int8)


NAMES = [
    "length", "words", "word length", "line length", "empty", "lower", "upper", "digits", "stops", "marks", "signs",
    "upper after upper", "sign after letter", "sign after sign", "mark after mark", "stop after letter", "lone signs",
    "same word again", "distinct words", "distinct lines", "stopped lines", "words to a stop",
]


def _word_statistics(text: str) -> tuple[int, int, int, int, int]:
    """Words, words equal to the one before, distinct words, lines, distinct lines."""
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    return len(words), sum(map(eq, words, words[1:])), len(set(words)), len(lines), len(set(lines))


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of len(NAMES) numbers for each text; shares as square roots, which keeps small ones apart."""
    n = len(texts)
    whole = [t or "" for t in texts]
    counted = np.array([_word_statistics(t) for t in whole], np.float64).reshape(n, 5)
    # A line end between texts: pairs of signs never join two texts.
    codes = np.frombuffer("\n".join([*whole, ""]).encode("utf-32-le"), np.uint32)
    kinds = _kinds()[np.minimum(codes, 1 << 16)].astype(np.int64)
    sizes = np.array([len(t) + 1 for t in whole], np.int64)
    of_doc = np.repeat(np.arange(n), sizes)
    before = np.concatenate([[LINE], kinds[:-1]])
    after = np.bincount((of_doc * KINDS + before) * KINDS + kinds, minlength=n * KINDS * KINDS).reshape(n, KINDS, KINDS).astype(np.float64)
    some = np.flatnonzero(sizes > 1)
    # The line end behind each text is not of the text, and all that an empty one has.
    after[some, kinds[np.cumsum(sizes)[some] - 2], LINE] -= 1
    after[sizes == 1] = 0
    signs = after.sum(axis=1)
    length = sizes - 1.0
    words, same, distinct, lines, distinct_lines = counted.T
    letters = signs[:, LOWER] + signs[:, UPPER]

    def share(part: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.sqrt(np.clip(part / np.maximum(of, 1), 0, 1))

    from_letter = after[:, LOWER] + after[:, UPPER]
    blank = [SPACE, LINE]
    lone = after[:, blank, SIGN].sum(axis=1)
    columns = [
        np.log1p(length),
        np.log1p(words),
        np.log1p(letters / np.maximum(words, 1)),
        np.log1p(words / np.maximum(lines, 1)),
        length == 0,
        *(share(signs[:, k], length) for k in (LOWER, UPPER, DIGIT, STOP, MARK, SIGN)),
        share(after[:, UPPER, UPPER], letters),
        share(from_letter[:, SIGN] + after[:, STOP, SIGN], words),
        share(after[:, SIGN, SIGN], length),
        share(after[:, MARK, MARK], words),
        share(from_letter[:, STOP], words),
        share(lone, words),
        share(same, words),
        share(distinct, words),
        share(distinct_lines, lines),
        share(after[:, STOP, LINE], lines),
        np.log1p(words / (1 + signs[:, STOP])),
    ]
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, stats)`` of each row, written once: the texts are read a single time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, held, size = [], [], 0
            for k, text in enumerate(texts_of(batch)):
                held.append(text)
                size += len(text or "")
                if size >= GROUP or k == batch.num_rows - 1:
                    parts.append(statistics(held))
                    held, size = [], 0
            if parts:
                flat = np.concatenate(parts)
                ends = np.arange(len(flat) + 1, dtype=np.int32) * len(NAMES)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return pin(rows.mapInArrow(run, f"doc_id {kind}, stats array<double>"), "quality-statistics")


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index("stats"))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(NAMES))


@dataclass(frozen=True)
class Fourier:
    """Random cosines of standardised statistics."""

    mean: np.ndarray
    scale: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """A constant and FEATURES cosines a row."""
        own = np.random.default_rng(SEED)
        waves, phases = own.normal(size=(len(NAMES), FEATURES)) / WIDTH, own.uniform(0, 2 * np.pi, FEATURES)
        z = np.cos((stats - self.mean) / self.scale @ waves + phases) * np.sqrt(2 / FEATURES)
        return np.hstack([np.ones((len(z), 1)), z])


@dataclass(frozen=True)
class QualityModel:
    """Features, ridge weights and the curve from values to scores; without weights every score is ``share``."""

    share: float
    fourier: Fourier | None = None
    weights: np.ndarray | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None
    penalty: float = 0.0

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.share)
        return np.interp(self.fourier.features(stats) @ self.weights, *self.steps)


def _training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """``(label, fold, stats)``: equal statistics share a fold, so copies are not on both sides."""
    usable = labels.select(F.col("doc_id").alias("__id"), (F.col("quality") > 0).cast("double").alias("label"))
    usable = usable.where(F.col("label").isNotNull() & F.col("__id").isNotNull() & ~held_out(F.col("__id")))
    usable = usable.groupBy("__id").agg(F.max("label").alias("label"))
    fold = F.pmod(F.xxhash64("stats"), F.lit(FOLDS)).cast("int").alias("fold")
    return pin(stats.join(usable, stats["doc_id"] == usable["__id"]).select("label", fold, "stats"), "quality-train")


def _moments(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each statistic; a task sends one row a statistic."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(NAMES)))
        for batch in batches:
            s = _stats_of(batch)
            total += np.stack([np.full(len(NAMES), len(s)), s.sum(axis=0), (s * s).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(NAMES)), pa.int32()), *map(pa.array, total)], ["place", "n", "s", "q"])

    sums = train.select("stats").mapInArrow(add, "place int, n double, s double, q double").groupBy("place").agg(F.sum("n"), F.sum("s"), F.sum("q"))
    rows = np.array(sorted(tuple(r) for r in sums.collect()))
    mean = rows[:, 2] / rows[:, 1]
    spread = np.sqrt(np.maximum(rows[:, 3] / rows[:, 1] - mean**2, 0))
    return mean, np.where(spread > 1e-6, spread, 1.0)


def normal_equations(train: DataFrame, fourier: Fourier) -> list[np.ndarray]:
    """For each fold the sum of outer products of (features, label)."""
    size = FEATURES + 2
    schema = "fold int, task int, gram binary"

    def rows(found: list[tuple[int, int, np.ndarray]]) -> dict:
        folds, tasks, grams = zip(*found)
        return {"fold": pa.array(folds, pa.int32()), "task": pa.array(tasks, pa.int32()), "gram": pa.array([g.tobytes() for g in grams], pa.binary())}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            label, fold = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            z = np.hstack([fourier.features(_stats_of(batch)), label[:, None]])
            for f in np.unique(fold).tolist():
                own = z[fold == f]
                total[f] = total.get(f, 0) + own.T @ own
        if total:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(rows([(f, task, g) for f, g in sorted(total.items())]))

    def stack(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["task"].to_pylist(), table["gram"].to_pylist()))
        total = sum(np.frombuffer(raw, np.float64) for _, raw in parts)
        return pa.table(rows([(table["fold"][0].as_py(), parts[0][0] // FAN_IN, total)]))

    parts = pin(train.select("label", "fold", "stats").mapInArrow(add, schema), "quality-sums")
    most = parts.agg(F.max("task")).first()[0]
    while most is not None and most > 0:  # until one sum a fold is left
        parts = pin(parts.groupBy("fold", F.floor(F.col("task") / FAN_IN)).applyInArrow(stack, schema), "quality-sums")
        most //= FAN_IN
    out = [np.zeros((size, size)) for _ in range(FOLDS)]
    for row in parts.collect():
        out[row["fold"]] = np.frombuffer(bytes(row["gram"]), np.float64).reshape(size, size)
    return out


def _ridge(gram: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of all but the last column for the last; the constant, which is first, is not penalised."""
    k = len(gram) - 1
    weigh = np.full(k, penalty)
    weigh[0] = 1e-9
    return np.linalg.solve(gram[:k, :k] + np.diag(weigh), gram[:k, k])


def _squared_error(gram: np.ndarray, weights: np.ndarray) -> float:
    side = np.append(weights, -1.0)
    return float(side @ gram @ side)


def isotonic(value: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean value and share of label 1 of each block, both rising."""
    blocks: list[list[float]] = []
    for v, m, p in zip(value.tolist(), n.tolist(), positive.tolist()):
        blocks.append([v * m, m, p])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    found = np.array(blocks)
    return found[:, 0] / found[:, 1], found[:, 2] / found[:, 1]


def _calibrated(train: DataFrame, fourier: Fourier, weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The curve of values that each row gets from the weights without its fold."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, fold = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            z = fourier.features(_stats_of(batch))
            value = np.clip(np.einsum("ij,ij->i", z, np.stack(weights)[fold]), LOW, HIGH)
            step = np.round((value - LOW) / (HIGH - LOW) * BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), pa.array(label)], ["step", "label"])

    counted = train.select("label", "fold", "stats").mapInArrow(bins, "step int, label double")
    rows = sorted(tuple(r) for r in counted.groupBy("step").agg(F.count("*"), F.sum("label")).collect())  # BINS + 1 at most
    step, n, positive = np.array(rows, np.float64).T
    return isotonic(LOW + step / BINS * (HIGH - LOW), n, positive)


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Train on the labelled rows of ``with_statistics`` that are not held out."""
    train = _training_rows(stats, labels)
    n = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    share = n.get(1.0, 0) / max(1, sum(n.values()))
    if len(n) < 2:
        return QualityModel(share)
    fourier = Fourier(*_moments(train))
    grams = normal_equations(train, fourier)
    total = sum(grams)

    def left_out(penalty: float) -> float:
        return sum(_squared_error(g, _ridge(total - g, penalty)) for g in grams)

    penalty = min(PENALTIES, key=left_out)
    steps = _calibrated(train, fourier, [_ridge(total - g, penalty) for g in grams])
    return QualityModel(share, fourier, _ridge(total, penalty), steps, penalty)


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``(doc_id, score)`` of each row of ``with_statistics``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_stats_of(batch)))], ["doc_id", "score"])

    return stats.mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")
