"""Toxicity by a subsequence string-kernel support vector machine with Nystrom landmarks.

The kernel of two short strings counts their common subsequences of three
characters; each is weighted by DECAY to the power of the stretch it spans in
either string (up to five characters), so gapped and inserted characters lower a
match instead of breaking it.  A text is the set of its units: windows of up to
eight characters of its words, words with other signs taken out, and letters
written apart joined together.  It has two features for a landmark: the best
normalised kernel value of any unit (values below FLOOR count as zero), and the
values of all its words in proportion to its length, so that a chance match in a
long text weighs less than insults in a short one.

Landmarks are strings that toxic training texts have and others do not, picked
greedily until those texts are covered.  The Nystrom map whitens the features by
the landmarks' own kernel matrix; a linear machine with squared hinge loss is
trained on it, and a logistic curve turns its value into a score.

Fitting takes a bounded sample of the labelled rows, chosen by a hash of the id:
TRAIN_TOXIC and TRAIN_OTHER rows at most (expected values).  Scoring takes every
whole text.

Defined cases: a null text counts as empty and gets the score of a text without
any match; without labels of both kinds every text gets the share of toxic labels
(0 without labels); labels that are null are left out; repeated rows get equal
scores; columns other than id and text never take part in a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tokens import texts_of
from plumbline.session import pin

TRAIN_TOXIC, TRAIN_OTHER = 6_000, 14_000
THRESHOLD = 0.3
UNIT, SPAN, DECAY, FLOOR = 8, 5, 0.6, 0.35
LANDMARKS, CANDIDATES, COVERED, ODDS, ALIKE_MOST = 64, 4_000, 2, 1.5, 0.8
RATE = 50  # words of a text in which one full match has full weight
MEMO = 300_000  # words remembered in a worker
GROUP = 1 << 21  # characters scored together
EDGE = ".,;:!?\"'()[]{}<>…«»“”‘’-_*/\\|"
APART = re.compile(r"(?<!\S)\S(?:[ ._*-]\S){2,}(?!\S)")  # letters written one by one
#: Signs that are often written for a letter (fixed values).
ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Character codes to 31 classes: letters, and the rest by code; 0 is no character."""
    table = np.array([0, *(27 + c % 5 for c in range(1, 0x2000))], np.int64)
    for k in range(26):
        table[ord("a") + k] = k + 1
    for sign, letter in ALIKE.items():
        table[ord(sign)] = ord(letter) - ord("a") + 1
    return table


_TRIPLES = [(i, j, k) for i, j, k in combinations(range(UNIT), 3) if k - i < SPAN]
_WEIGHTS = np.array([DECAY ** (k - i + 1) for i, _, k in _TRIPLES], np.float32)


def _codes(units: list[str]) -> np.ndarray:
    """Codes of the triples of each unit (columns as in _TRIPLES), 0 where one runs past the end."""
    chars = np.array(units, f"U{UNIT}").view(np.uint32).reshape(len(units), UNIT)
    c = _classes()[np.where(chars < 0x2000, chars, 0x1000 + chars % 0x1000)]
    out = np.empty((len(units), len(_TRIPLES)), np.int32)
    for n, (i, j, k) in enumerate(_TRIPLES):
        out[:, n] = np.where(c[:, k] > 0, (c[:, i] * 32 + c[:, j]) * 32 + c[:, k], 0)
    return out


def _norms(codes: np.ndarray) -> np.ndarray:
    """Square root of each unit's kernel value with itself."""
    out = np.empty(len(codes), np.float32)
    for at in range(0, len(codes), 4096):
        part = codes[at : at + 4096]
        order = np.argsort(part, axis=1)
        by = np.take_along_axis(part, order, 1)
        total = np.cumsum(np.where(by > 0, _WEIGHTS[order], 0), axis=1, dtype=np.float64)
        last = np.concatenate([by[:, 1:] != by[:, :-1], np.ones((len(by), 1), bool)], axis=1)
        upto = np.where(last, total, 0)
        before = np.maximum.accumulate(np.concatenate([np.zeros((len(by), 1)), upto[:, :-1]], axis=1), axis=1)
        out[at : at + 4096] = np.sqrt((np.where(last, total - before, 0) ** 2).sum(axis=1))
    return np.maximum(out, 1e-9)


def units_of(word: str) -> list[str]:
    """The units of one lower-cased word."""
    word = word.strip(EDGE)
    letters = "".join(c for c in word if c.isalnum() or c in ALIKE)
    out = []
    for w in (word, letters) if letters != word else (word,):
        if len(w) > 2:
            out += [w] if len(w) <= UNIT else [w[i : i + UNIT] for i in range(len(w) - UNIT + 1)]
    return out


def words_of(text: str | None) -> Counter[str]:
    """How often each word of a text occurs, lower-cased, and runs of letters written apart, joined."""
    low = (text or "").lower()
    words = Counter(low.split())
    words.update(re.sub(r"[ ._*-]", "", m.group()) for m in APART.finditer(low))
    return words


class Kernel:
    """Values of units against fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.n = len(landmarks)
        codes = _codes(landmarks) if landmarks else np.zeros((0, len(_TRIPLES)), np.int32)
        self.norms = _norms(codes) if landmarks else np.ones(0, np.float32)
        self.table = np.zeros((1 << 15, self.n), np.float32)
        for k, row in enumerate(codes):
            np.add.at(self.table[:, k], row, _WEIGHTS / self.norms[k])
        self.table[0] = 0
        self.any = self.table.max(axis=1) if landmarks else np.zeros(1 << 15, np.float32)

    def values(self, units: list[str]) -> np.ndarray:
        """Normalised kernel values, below FLOOR as zero."""
        out = np.zeros((len(units), self.n), np.float32)
        for at in range(0, len(units), 8192):
            codes = _codes(units[at : at + 8192])
            # No landmark can reach FLOOR where the best weight of every triple does not.
            own = np.sqrt(((codes > 0) * _WEIGHTS**2).sum(axis=1))
            able = np.flatnonzero((self.any[codes] * _WEIGHTS).sum(axis=1) >= FLOOR * own)
            if len(able):
                found = np.einsum("utl,t->ul", self.table[codes[able]], _WEIGHTS) / _norms(codes[able])[:, None]
                out[at + able] = np.where(found >= FLOOR, found, 0)
        return out


class Scorer:
    """Features of whole texts, with a bounded memory of words."""

    def __init__(self, landmarks: list[str]):
        self.kernel, self.seen, self.hits = Kernel(landmarks), set(), {}

    def _learn(self, words: list[str]) -> None:
        units, of = [], []
        for k, word in enumerate(words):
            own = units_of(word)
            units += own
            of += [k] * len(own)
        if not units:
            return
        values = self.kernel.values(units)
        some = np.flatnonzero(values.any(axis=1))
        for u in some.tolist():
            word = words[of[u]]
            self.hits[word] = np.maximum(self.hits[word], values[u]) if word in self.hits else values[u]

    def features(self, texts: list[str | None]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        new = set().union(*split).difference(self.seen)
        if len(self.seen) + len(new) > MEMO:
            self.seen, self.hits = set(), {}
            new = set().union(*split)
        self.seen |= new
        self._learn(list(new))
        n, hits = self.kernel.n, self.hits
        out = np.zeros((len(texts), 2 * n), np.float32)
        for k, words in enumerate(split):
            if found := [w for w in words if w in hits]:
                values = np.array([hits[w] for w in found])
                times = np.array([words[w] for w in found], np.float32)
                out[k, :n] = values.max(axis=0)
                out[k, n:] = np.minimum(1, RATE * (times @ values) / (words.total() + RATE))
        return out


@dataclass(frozen=True)
class ToxicityModel:
    """Landmarks, weights of their features, bias, and the logistic curve of the score."""

    landmarks: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    slope: float
    shift: float
    share: float
    info: dict = field(default_factory=dict, compare=False, hash=False)

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.landmarks:
            return np.full(len(features), self.share)
        value = features @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(np.clip(-(self.slope * value + self.shift), -500, 500)))


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(toxic, text)`` of the bounded sample, equal texts once."""
    usable = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IS NOT NULL AND __id IS NOT NULL")
    usable = usable.where(~held_out(F.col("__id"))).groupBy("__id").agg(F.max("toxic").alias("toxic"))
    n = dict(usable.groupBy("toxic").count().collect())
    per_million = F.pmod(F.xxhash64("__id"), F.lit(1_000_000))
    limit = F.when(F.col("toxic") > 0, _share(TRAIN_TOXIC, sum(c for t, c in n.items() if t > 0))).otherwise(_share(TRAIN_OTHER, n.get(0, 0)))
    chosen = usable.where(per_million < limit)
    # At most TRAIN_TOXIC + TRAIN_OTHER rows of two numbers are expected, which bounds the broadcast.
    text = docs.select(F.col(id_col).cast("long").alias("__doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = text.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("toxic", "text")
    return rows.groupBy(F.sha2("text", 256).alias("__sha")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")).drop("__sha")


def _share(most: int, there: int) -> int:
    return 1_000_000 if there <= most else int(1_000_000 * most / there)


def _candidates(words: Counter[str]) -> set[str]:
    """Strings that may become landmarks: units, and the beginnings of words."""
    out = set()
    for word in words:
        units = units_of(word)
        out.update(units)
        out.update(units[0][:n] for n in range(4, UNIT) if units and len(units[0]) > n)
    return {u for u in out if len(u) >= 4}


def _pick_landmarks(train: DataFrame, n_toxic: int, n_other: int) -> list[str]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for label, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                seen[int(label > 0)].update(_candidates(words_of(text)))
            keys = list(seen[0].keys() | seen[1].keys())
            counts = [pa.array([seen[t][k] for k in keys], pa.int64()) for t in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *counts], ["unit", "toxic", "other"])

    counted = train.select("toxic", "text").mapInArrow(count, "unit string, toxic long, other long")
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("other") + 0.5) / (n_other + 1))
    ranked = counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where("toxic >= 3").withColumn("odds", odds)
    # Telling strings first, then frequent ones; CANDIDATES rows reach the driver.
    best = ranked.where(F.col("odds") >= ODDS).orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "unit").limit(CANDIDATES).collect()
    odds_of = {r["unit"]: r["odds"] for r in best}

    def having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [[u for u in _candidates(words_of(t)) if u in odds_of] for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(has, pa.list_(pa.string()))], ["has"])

    rows = train.where("toxic > 0").select("toxic", "text").mapInArrow(having, "has array<string>").collect()
    where: dict[str, set[int]] = {}
    for k, row in enumerate(sorted(sorted(r["has"]) for r in rows)):
        for unit in row:
            where.setdefault(unit, set()).add(k)
    need, chosen = [COVERED] * len(rows), []
    while where and len(chosen) < LANDMARKS:
        gain = {u: sum(need[k] for k in ks) * odds_of[u] for u, ks in where.items()}
        unit = max(sorted(gain), key=gain.get)
        if gain[unit] < 6:
            break
        chosen.append(unit)
        for k in where.pop(unit):
            need[k] = max(0, need[k] - 1)
        kept = Kernel([unit]).values(list(where))[:, 0] if where else []
        where = {u: ks for (u, ks), near in zip(where.items(), kept) if near < ALIKE_MOST}
    return chosen


def _newton(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Squared-hinge machine: weights of ``x`` and of a last, hardly penalised bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w, active = np.zeros(x.shape[1]), np.ones(len(x), bool)
    for _ in range(50):
        part, weight = x[active], cost[active]
        w = np.linalg.solve(part.T @ (part * weight[:, None]) + np.diag(penalty), part.T @ (weight * y[active]))
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _logistic(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's curve: slope and shift by Newton steps on softened targets."""
    n, p = len(y), y.sum()
    target = np.where(y > 0, (p + 1) / (p + 2), 1 / (n - p + 2))
    slope, shift = 1.0, float(np.log((p + 1) / (n - p + 1)))
    for _ in range(100):
        prob = 1 / (1 + np.exp(-np.clip(slope * value + shift, -500, 500)))
        grad, h = prob - target, np.maximum(prob * (1 - prob), 1e-9)
        hess = np.array([[(h * value**2).sum() + 1e-6, (h * value).sum()], [(h * value).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, [(grad * value).sum(), grad.sum()])
        step /= max(1.0, np.abs(step).max())
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Train on the labelled rows that are not held out."""
    train = pin(_training_rows(docs, labels, id_col, text_col), "toxic-train")
    n = dict(train.groupBy((F.col("toxic") > 0).cast("int")).count().collect())
    toxic, other = n.get(1, 0), n.get(0, 0)
    share = toxic / max(1, toxic + other)
    landmarks = _pick_landmarks(train, toxic, other) if toxic and other else []
    if not landmarks:
        return ToxicityModel((), (), 0.0, 1.0, 0.0, share)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(landmarks)
        for batch in batches:
            found = own.features(list(texts_of(batch))).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tobytes() for f in found], pa.binary())], ["toxic", "features"])

    # One row of twice LANDMARKS numbers for each row of the bounded sample.
    rows = sorted((r["toxic"], bytes(r["features"])) for r in train.select("toxic", "text").mapInArrow(features, "toxic int, features binary").collect())
    x = np.array([np.frombuffer(f, "<f4") for _, f in rows], np.float64)
    y = np.array([1.0 if t > 0 else -1.0 for t, _ in rows])
    gram = Kernel(landmarks).values(landmarks).astype(np.float64)
    size, axes = np.linalg.eigh((gram + gram.T) / 2 + 1e-3 * np.eye(len(landmarks)))
    whiten = axes @ np.diag(1 / np.sqrt(np.maximum(size, 1e-3))) @ axes.T
    cost = np.where(y > 0, len(y) / (2 * toxic), len(y) / (2 * other))
    whiten = np.kron(np.eye(2), whiten)  # the same map for both features
    w = _newton(x @ whiten, y, cost)
    weights = whiten @ w[:-1]
    slope, shift = _logistic(x @ weights + w[-1], (y > 0).astype(float))
    return ToxicityModel(tuple(landmarks), tuple(weights.tolist()), float(w[-1]), slope, shift, share, {"toxic": toxic, "other": other})


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of each whole text."""
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    of_text = f"c{names.index(text_col)}"
    schema = ", ".join(f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(names)) + ", __score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(list(model.landmarks))
        for batch in batches:
            parts, held, size = [], [], 0
            for k, text in enumerate(texts_of(batch, of_text)):
                held.append(text)
                size += len(text or "")
                if size >= GROUP or k == batch.num_rows - 1:
                    parts.append(model.scores(own.features(held)))
                    held, size = [], 0
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "__score"])

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)], F.col("__score").alias(name))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, all columns."""
    name = "score" + "_" * max(len(c) for c in docs.columns)  # longer than any column's name, so it cannot clash
    return score(docs, fit(docs, labels), name=name).where(F.col(name) < threshold).drop(name)
