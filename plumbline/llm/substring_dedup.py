"""Repeated passages, found by difference-cover anchors.

A window is WINDOW consecutive words of one document; a window is a repeat when
the same words start in a document with a smaller id.  Only windows of ANCHOR
words at positions that lie in a difference cover modulo PERIOD are hashed first.
Whatever the positions of two equal windows, some offset below PERIOD brings both
onto the cover, and ANCHOR + PERIOD - 1 = WINDOW, so equal windows share an
aligned anchor.  Anchors that occur in one document only rule out all windows
around them; what is left is extended to whole windows, which are hashed to 128
bits, compared over all documents, and every word under a repeat is removed.

Documents are kept in batches, written once and bucketed by batch.  A batch sends
each distinct hash once, with its least document id, to the range of hashes it
belongs to, and gets one bit back for each; so a passage in every document is one
entry per batch, texts never shuffle, and no key gathers rows.

Defined cases: a null text has no words; documents of fewer than WINDOW words
keep all; rows that repeat an id do not remove each other's words; a null id
counts as the largest; an empty table gives an empty result.  Other columns are
carried along as they are, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import shuffle_partitions
from plumbline.session import scratch_path

WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)  # any difference modulo 7 is one of two cover positions
ANCHOR = WINDOW - PERIOD + 1
BATCH_BYTES = 4 << 20
LAST = np.iinfo(np.int64).max  # stands for a null id
KEY_BYTES = 5  # bytes of an anchor's hash that are sent: a false match only costs an extra window


class Words:
    """The words of a text, and hashes of runs of them."""

    def __init__(self, text: str | None):
        self.words = (text or "").encode().split()
        self.joined = b" ".join(self.words)
        self.stops = np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1) - 1
        self.starts = np.concatenate([[0], self.stops[:-1] + 1]) if self.words else self.stops

    def __len__(self) -> int:
        return len(self.words)

    def _runs(self, at: np.ndarray, size: int) -> list[bytes]:
        joined = self.joined
        return [joined[a:b] for a, b in zip(self.starts[at].tolist(), self.stops[at + size - 1].tolist())]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions on the cover, and the hash of the anchor at each."""
        if len(self) < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.arange(len(self) - ANCHOR + 1)
        at = at[np.isin(at % PERIOD, COVER)]
        hashed = xxhash.xxh3_64_intdigest
        return at, np.fromiter(map(hashed, self._runs(at, ANCHOR)), np.uint64, len(at))

    def windows(self, at: np.ndarray) -> np.ndarray:
        """128-bit hashes of the windows at some positions, two columns."""
        digest = xxhash.xxh3_128_digest
        return np.frombuffer(b"".join(map(digest, self._runs(at, WINDOW))), ">u8").astype(np.uint64).reshape(-1, 2)


class Distinct:
    """Distinct keys of a batch: which rows have them, and the least and largest document id of each."""

    def __init__(self, high: np.ndarray, low: np.ndarray | None, ids: np.ndarray):
        order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
        h = high[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        if low is not None:
            new[1:] |= low[order][1:] != low[order][:-1]
        first = np.flatnonzero(new)
        self.high, self.low = h[first], None if low is None else low[order][first]
        self.of_row = np.empty(len(h), np.int64)
        self.of_row[order] = np.cumsum(new) - 1
        sorted_ids = ids[order]
        self.least = np.minimum.reduceat(sorted_ids, first) if len(first) else ids[:0]
        self.most = np.maximum.reduceat(sorted_ids, first) if len(first) else ids[:0]

    def ranges(self, n: int) -> Iterator[tuple[int, int, int]]:
        """``(range, from, to)``: the keys are sorted, so each range of hashes is one stretch."""
        place = ((self.high >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(place)) + 1
        edges = [0, *cuts.tolist(), len(place)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield int(place[a]), a, b


def _anchors_of(ids: np.ndarray, texts: list[Words]) -> tuple[list[np.ndarray], Distinct]:
    found = [w.anchors() for w in texts]
    sizes = [len(a) for a, _ in found]
    none = [np.zeros(0, np.uint64)]
    return [a for a, _ in found], Distinct(np.concatenate([h for _, h in found] or none), None, np.repeat(ids, sizes))


def _bits(n: int, answers: list[dict] | None, ranges: list[tuple[int, int, int]]) -> np.ndarray:
    """The bits that came back, in the order in which the keys were sent."""
    bits, by_range = np.zeros(n, bool), {x["range"]: x["bits"] for x in answers or []}
    for k, a, b in ranges:
        if k in by_range:
            bits[a:b] = np.unpackbits(np.frombuffer(by_range[k], np.uint8), count=b - a, bitorder="little")
    return bits


def _windows_of(ids: np.ndarray, texts: list[Words], answers: list[dict] | None, n: int) -> tuple[list[np.ndarray], Distinct]:
    """Windows with a repeated anchor on the cover, of each text, and their distinct hashes."""
    places, keys = _anchors_of(ids, texts)
    repeated = (_bits(len(keys.high), answers, list(keys.ranges(n))) | (keys.least != keys.most))[keys.of_row]
    at, windows, row = [], [], 0
    for own, words in zip(places, texts):
        here = repeated[row : row + len(own)]
        row += len(own)
        marks = np.zeros(max(0, len(words) + 1), np.int64)
        marks[own[here] + 1] = 1
        seen = np.cumsum(marks)
        starts = np.arange(max(0, len(words) - WINDOW + 1))
        chosen = starts[seen[starts + PERIOD] > seen[starts]] if here.any() else starts[:0]
        at.append(chosen)
        windows.append(words.windows(chosen) if len(chosen) else np.zeros((0, 2), np.uint64))
    both = np.concatenate(windows) if windows else np.zeros((0, 2), np.uint64)
    return at, Distinct(both[:, 0], both[:, 1], np.repeat(ids, [len(a) for a in at]))


def _batch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, list[Words]]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
            ids = np.array([LAST if n is None else n for n in row["ids"].as_py()], np.int64)
            yield row, ids, [Words(t) for t in row["texts"].as_py()]


def _make_batches(batch_bytes: int, rest_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0

        def row(piece: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal count
            count += 1
            offsets = pa.array([0, piece.num_rows], pa.int32())
            rest = pa.StructArray.from_arrays([piece.column(k + 2) for k in range(len(rest_names))], [f"c{k}" for k in range(len(rest_names))])
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (piece.column(0), piece.column(1), rest)]
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + count], pa.int64()), *lists], ["batch", "ids", "texts", "rest"])

        for batch in batches:
            start, held = 0, 0
            for k, size in enumerate(pa.compute.binary_length(batch.column(1)).to_pylist()):
                held += size or 0
                if held >= batch_bytes:
                    yield row(batch.slice(start, k + 1 - start))
                    start, held = k + 1, 0
            if start < batch.num_rows:
                yield row(batch.slice(start))

    return run


def _batched(docs: DataFrame, id_col: str, text_col: str, buckets: int, batch_bytes: int) -> DataFrame:
    """``(batch, ids, texts, rest)``, written once and bucketed by batch, so that answers join without moving texts."""
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    fields = [T.StructField(f"c{k}", docs.schema[c].dataType) for k, c in enumerate(rest)] or [T.StructField("c0", T.BooleanType())]
    columns = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)] or [F.lit(True).alias("c0")]
    schema = T.StructType(
        [
            T.StructField("batch", T.LongType()),
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("texts", T.ArrayType(T.StringType())),
            T.StructField("rest", T.ArrayType(T.StructType(fields))),
        ]
    )
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"), *columns)
    made = rows.mapInArrow(_make_batches(batch_bytes, [f.name for f in fields]), schema)
    name, spark = f"plumbline_batches_{uuid.uuid4().hex}", docs.sparkSession
    writer = made.write.bucketBy(buckets, "batch").option("path", scratch_path(spark, "substring-batches")).option("compression", "zstd")
    writer.saveAsTable(name)
    return spark.table(name)


KEYS = "range int, batch long, keys binary, least binary"


def _send_anchors(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, texts in _batch_rows(batches):
            _, keys = _anchors_of(ids, texts)
            short = keys.high.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            sent = [(k, row["batch"].as_py(), short[a:b].tobytes(), b"") for k, a, b in keys.ranges(n)]
            if sent:
                yield _sent(sent)

    return run


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["range", "batch", "keys", "least"])


def _send_windows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, texts in _batch_rows(batches):
            _, keys = _windows_of(ids, texts, row["answers"].as_py(), n)
            pairs = np.stack([keys.high, keys.low], axis=1).astype("<u8")
            sent = [(k, row["batch"].as_py(), pairs[a:b].tobytes(), keys.least[a:b].astype("<i8").tobytes()) for k, a, b in keys.ranges(n)]
            if sent:
                yield _sent(sent)

    return run


def _answered(table: pa.Table, sizes: list[int], bits: np.ndarray) -> pa.Table:
    ends = np.cumsum([0, *sizes])
    packed = [np.packbits(bits[a:b], bitorder="little").tobytes() for a, b in zip(ends, ends[1:])]
    return pa.table({"batch": table["batch"], "range": table["range"], "bits": pa.array(packed, pa.binary())})


def _answer_anchors(table: pa.Table) -> pa.Table:
    """One bit per key: whether another batch has it too."""
    raw = [k.as_py() for k in table["keys"]]
    wide = np.zeros((sum(map(len, raw)) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, KEY_BYTES)
    _, of, count = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
    return _answered(table, [len(k) // KEY_BYTES for k in raw], (count > 1)[of])


def _answer_windows(table: pa.Table) -> pa.Table:
    """One bit per key: whether another batch has it in a document with a smaller id than the batch."""
    raw = [k.as_py() for k in table["keys"]]
    pairs = np.frombuffer(b"".join(raw), "<u8").reshape(-1, 2)
    least = np.frombuffer(b"".join(x.as_py() for x in table["least"]), "<i8")
    keys = Distinct(pairs[:, 0], pairs[:, 1], least)
    return _answered(table, [len(k) // 16 for k in raw], keys.least[keys.of_row] < least)


def _answers(sent: DataFrame, answer) -> DataFrame:
    """``(batch_id, answers)``: at most one entry per range of hashes for each batch."""
    bits = sent.groupBy("range").applyInArrow(answer, "batch long, range int, bits binary")
    return bits.groupBy(F.col("batch").alias("batch_id")).agg(F.collect_list(F.struct("range", "bits")).alias("answers"))


def _removed(n: int, untouched: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, texts in _batch_rows(batches):
            at, keys = _windows_of(ids, texts, row["answers"].as_py(), n)
            smaller = _bits(len(keys.high), row["found"].as_py(), list(keys.ranges(n)))
            places = np.concatenate(at) if at else np.zeros(0, np.int64)
            of_doc = np.repeat(np.arange(len(at)), [len(a) for a in at])
            repeats = smaller[keys.of_row] | (keys.least[keys.of_row] < ids[of_doc])
            whole, out, begin = row["texts"].as_py(), [], 0
            for k, words in enumerate(texts):
                own = repeats[begin : begin + len(at[k])]
                edges = np.zeros(len(words) + 1, np.int64)
                starts = places[begin : begin + len(at[k])][own]
                begin += len(at[k])
                edges[starts] += 1
                edges[starts + WINDOW] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                n_gone = int(gone.sum())
                if untouched and not n_gone:
                    text = whole[k]
                else:
                    text = b" ".join([w for w, g in zip(words.words, gone.tolist()) if not g]).decode()
                out.append((len(words), n_gone, text))
            counts, removed, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [row["ids"].values, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), row["rest"].values],
                ["id", "n_words", "n_removed", "kept_text", "rest"],
            )

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", untouched: bool = False, ranges: int | None = None, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """One row per row: ``id, n_words, n_removed, kept_text`` (kept words joined by one space) and ``rest`` (a struct of the
    other columns, ``c0`` on).  With ``untouched``, a text that loses no word stays as it was, white space and null too.
    ``ranges`` is into how many ranges hashes are cut (the session's shuffle partitions by default)."""
    n = ranges or shuffle_partitions(docs.sparkSession)
    rows = _batched(docs, id_col, text_col, n, batch_bytes)
    anchors = _answers(rows.select("batch", "ids", "texts").mapInArrow(_send_anchors(n), KEYS), _answer_anchors)
    # Answers are written, as two later passes read them; they are a bit per distinct anchor.
    path = scratch_path(docs.sparkSession, "substring-anchors")
    anchors.write.parquet(path)
    known = docs.sparkSession.read.schema(anchors.schema).parquet(path)
    first = rows.join(known.hint("shuffle_hash"), F.col("batch") == F.col("batch_id"), "left").drop("batch_id")
    windows = _answers(first.select("batch", "ids", "texts", "answers").mapInArrow(_send_windows(n), KEYS), _answer_windows)
    both = first.join(windows.withColumnRenamed("answers", "found").hint("shuffle_hash"), F.col("batch") == F.col("batch_id"), "left")
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_text", T.StringType()),
            T.StructField("rest", rows.schema["rest"].dataType.elementType),
        ]
    )
    return both.select("batch", "ids", "texts", "rest", "answers", "found").mapInArrow(_removed(n, untouched), schema)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, repeats removed from the texts; every row stays."""
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    out = remove_repeats(docs, id_col, text_col, untouched=True)
    by_name = {id_col: F.col("id").cast(docs.schema[id_col].dataType), text_col: F.col("kept_text")}
    by_name |= {c: F.col("rest").getField(f"c{k}") for k, c in enumerate(rest)}
    return out.select(*[by_name[c].alias(c) for c in docs.columns])
