"""Bound-certified best-fit packing of documents into sequences of a fixed length.

Each task encodes its documents, cuts only those longer than a sequence, and counts
its pieces by length.  Best-fit decreasing needs no more than those counts, so every
partition is packed from them, and lower bounds by dual-feasible functions certify its
number of sequences or show its gap.  While all partitions together need more than the
whole table has to, those with room in a sequence exchange documents: FAN_IN of them
become one and best-fit decreasing is run again, round after round, until the total
meets the bound of the whole table, or is as low as one best-fit decreasing over the
whole table gets, which a last round over a single unit always reaches.  Nothing is
capped.  A partition whose sequences are all full has nothing to exchange and is settled.

What is exchanged are pieces by length and number: a piece's number among all pieces of
its length in its unit tells its sequence and offset.  Those numbers are prefix sums over
tasks, taken in Spark, and come to the pieces, which stay in buckets where they were
written, by a join on the task.  The driver holds one row per length and the sums of a
round.  The pieces of a sequence lie where their documents lay; group by
``sequence_id`` to lay them out.

Defined cases: a null text counts as empty and packs as its end id alone; repeated rows
and ids pack each, and a null id stays null; an empty table gives an empty result;
columns other than id and text never take part.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import busy, id_and_text, idle, shuffle_partitions
from plumbline.llm.tokens import encoder, forget_encoder, texts_of
from plumbline.session import pin, scratch_path

FAN_IN = 16  # units that exchange documents in a round
BATCH_BYTES = 1 << 20  # ids of a row of pieces
ROWS_READ = 16  # rows of pieces in a row group, which is read as a whole
LISTS = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "nth": pa.int64()}
BATCHES = "part long, doc_id array<long>, piece array<int>, start array<long>, length array<long>, ids array<binary>, nth array<long>"
PLANS = "unit long, bins long, bound long, spare long, plan binary"
PACKED = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
RANKS = 40  # bits of a piece's number among those of its length
UNITS, BINS = 24, 36  # bits of a unit's number in its round, and of a sequence's in its unit


@dataclass(frozen=True)
class Plan:
    """Where each piece goes, by runs: pieces of one length, numbered on, that fill bins numbered on alike."""

    keys: np.ndarray  # length and number of a run's first piece
    first: np.ndarray  # bin of that piece
    per: np.ndarray  # pieces of the run in a bin
    offset: np.ndarray  # where the first piece of a bin lies
    bins: int

    def packed(self) -> bytes:
        return np.stack([self.keys, self.first, self.per, self.offset]).astype("<i8").tobytes()

    @staticmethod
    def unpacked(raw: bytes, bins: int = 0) -> Plan:
        return Plan(*np.frombuffer(raw, "<i8").reshape(4, -1), bins)

    def places(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of pieces, by length and by number among the pieces of that length."""
        at = np.searchsorted(self.keys, (lengths << RANKS) + numbers, side="right") - 1
        own = numbers - (self.keys[at] & ((1 << RANKS) - 1))
        return self.first[at] + own // self.per[at], self.offset[at] + own % self.per[at] * lengths


def best_fit_plan(count: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing of ``count[n]`` pieces of each length ``n`` (at least 1), by runs of like bins.

    The fullest bin that a piece fits stays the fullest for the next piece of that
    length while that fits as well, so each bin of a run takes as many as it can.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first bin, bins) by the space they have left
    some, bins = 0, 0  # bit r is set while room[r] has a run
    runs: list[tuple[int, int, int, int]] = []
    for size in np.flatnonzero(count)[::-1].tolist():
        done, total = 0, int(count[size])
        while done < total:
            fits = some >> size
            if fits:
                left = size + (fits & -fits).bit_length() - 1
                first, number = room[left].pop()
                if not room[left]:
                    some ^= 1 << left
            else:
                left, first, number = capacity, bins, -((done - total) // (capacity // size))
                bins += number
            per = left // size
            runs.append(((size << RANKS) + done, first, per, capacity - left))
            full = min(number, (total - done) // per)
            done += full * per
            over = total - done if full < number else 0  # fewer than per: the last bin gets them
            done += over
            split = [(full, left - per * size), (int(over > 0), left - over * size), (number - full - int(over > 0), left)]
            for taken, space in split:
                if taken:
                    room[space].append((first, taken))
                    some |= 1 << space
                    first += taken
    keys, first, per, offset = np.array(sorted(runs), np.int64).reshape(-1, 4).T
    return Plan(keys, first, per, offset, bins)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each size, and how full each bin is; ties go by position."""
    count = np.bincount(sizes, minlength=capacity + 1)
    order = np.argsort(sizes, kind="stable")
    numbers = np.empty(len(sizes), np.int64)
    numbers[order] = np.arange(len(sizes)) - (np.cumsum(count) - count)[sizes[order]]
    plan = best_fit_plan(count, capacity)
    bins, offsets = plan.places(sizes, numbers)
    return bins, offsets, np.bincount(bins, sizes, plan.bins).astype(np.int64).tolist()


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of several dual-feasible functions."""
    return _bound(np.bincount(sizes, minlength=capacity + 1)[: capacity + 1].astype(np.int64), capacity)


def _bound(count: np.ndarray, capacity: int) -> int:
    x = np.arange(capacity + 1)
    total_above = np.cumsum(count[::-1])[::-1]  # sizes of at least x
    mass = np.cumsum(count * x)
    best = mass[-1] / capacity
    for low in range(1, capacity // 2 + 1):  # sizes above capacity - low fill a bin, those below low vanish
        best = max(best, total_above[capacity - low + 1] + (mass[capacity - low] - mass[low - 1]) / capacity)
    for k in range(1, 33):  # sizes are rounded down to k-ths unless they are exact (k+1)-ths
        exact = (x * (k + 1)) % capacity == 0
        scaled = np.where(exact, x * k, x * (k + 1) // capacity * capacity)
        best = max(best, int((count * scaled).sum()) / (capacity * k))
    return math.ceil(best - 1e-9)


def pieces_of(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of each piece: whole sequences, the first one shorter."""
    first = (n_tokens - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n_tokens, capacity))]


def _cut_task(path: str, capacity: int, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        busy()
        try:
            yield from cut(batches)
        finally:
            idle(forget_encoder)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)  # pieces of each length so far
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                raw = own.raw(text) + end
                for k, (start, length) in enumerate(pieces_of(len(raw) // 4, capacity)):
                    rows.append((number, k, start, length, raw[4 * start : 4 * (start + length)], seen[length]))
                    seen[length] += 1
                    size += 4 * length + 40
                    if size >= BATCH_BYTES:
                        yield _row(part, rows)
                        rows, size = [], 0
        if rows:
            yield _row(part, rows)

    return run


def _row(part: int, rows: list[tuple]) -> pa.RecordBatch:
    lists = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pa.array(c, kind)) for c, kind in zip(zip(*rows), LISTS.values())]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *lists], names=["part", *LISTS])


def _cut(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces, some megabytes a row, in buckets by the task that cut them, so that answers join without moving them."""
    made, spark = docs.mapInArrow(_cut_task(path, capacity, end_id), BATCHES), docs.sparkSession
    name = f"plumbline_pieces_{uuid.uuid4().hex}"
    writer = made.write.bucketBy(shuffle_partitions(spark), "part").option("path", scratch_path(spark, "pieces")).option("compression", "zstd")
    writer.option("parquet.block.row.count.limit", ROWS_READ).saveAsTable(name)
    return spark.table(name)


def _plan_unit(capacity: int):
    def plan(table: pa.Table) -> pa.Table:
        count = np.zeros(capacity + 1, np.int64)
        count[table["length"].to_numpy()] = table["n"].to_numpy()
        found = best_fit_plan(count, capacity)
        spare = found.bins * capacity - int(count @ np.arange(capacity + 1))
        numbers = [pa.array([v], pa.int64()) for v in (table["unit"][0].as_py(), found.bins, _bound(count, capacity), spare)]
        return pa.table([*numbers, pa.array([found.packed()], pa.binary())], names=["unit", "bins", "bound", "spare", "plan"])

    return plan


def _round(counts: DataFrame, level: int, capacity: int, single: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(part, length, n, unit)`` with the units of a round, and their plans."""
    number = F.lit(0) if single else F.floor(F.col("part") / FAN_IN**level)
    rows = counts.select("part", "length", "n", (F.lit(level << UNITS) + number).cast("long").alias("unit"))
    # At most a row per length reaches the task that packs a unit, however many documents it has.
    of_units = rows.groupBy("unit", "length").agg(F.sum("n").alias("n"))
    return rows, pin(of_units.groupBy("unit").applyInArrow(_plan_unit(capacity), PLANS), "packing-plans")


def exchanged(counts: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rounds over ``(part, length, n)``: the same rows with their last unit, the plans of those, and the certificates.

    Certificates are ``(round, unit, bins, bound, spare)`` of every unit of every round.
    """
    whole = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        whole[row["length"]] = row["n"]
    # The bound of the whole table, or else what one best-fit decreasing over it gets.
    aim = max(_bound(whole, capacity), best_fit_plan(whole, capacity).bins)
    open_, settled, level = counts, 0, 0
    units: list[DataFrame] = []
    plans: list[DataFrame] = []
    certificates: list[DataFrame] = []
    while True:
        rows, found = _round(open_, level, capacity)
        certificates.append(found.select(F.lit(level).alias("round"), "unit", "bins", "bound", "spare"))
        full = F.col("spare") == 0
        number, total, closed = found.agg(F.count("*"), F.sum("bins"), F.sum(F.when(full, F.col("bins")))).first()
        if number <= 1 or settled + total <= aim:
            units.append(rows)
            plans.append(found)
            settled += total or 0
            break
        if closed:
            keys = found.where(full).select("unit")
            units.append(rows.join(keys, "unit", "left_semi").select(rows.columns))
            plans.append(found.where(full))
            open_ = pin(rows.join(keys, "unit", "left_anti").select("part", "length", "n"), "packing-open")
            settled += closed
        level += 1
    if settled > aim:  # settling early cost a sequence: one unit of all
        rows, found = _round(counts, level + 1, capacity, single=True)
        certificates.append(found.select(F.lit(level + 1).alias("round"), "unit", "bins", "bound", "spare"))
        units, plans = [rows], [found]
    return tuple(reduce(DataFrame.unionByName, parts) for parts in (units, plans, certificates))


def _places(units: DataFrame, plans: DataFrame) -> DataFrame:
    """Per task: its unit, that unit's plan, and the number at which its pieces of each length begin."""
    before = Window.partitionBy("unit", "length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = units.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
    of_part = starts.groupBy("part", "unit").agg(F.collect_list(F.struct("length", "before")).alias("starts"))
    return of_part.join(plans.select("unit", "plan"), "unit").withColumnRenamed("part", "of_part")


def pack_certified(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``pack`` and its certificates: sequences and lower bound of every unit in every round."""
    pieces = _cut(id_and_text(docs, id_col, text_col), path, capacity, end_id)
    counts = pin(pieces.select("part", F.explode("length").alias("length")).groupBy("part", "length").agg(F.count("*").alias("n")), "packing-counts")
    units, plans, certificates = exchanged(counts, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        busy()
        forget_encoder()
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
                lists = {name: row[name].values for name in LISTS}
                of_length, first = (f.to_numpy() for f in row["starts"].values.flatten())
                before = np.zeros(capacity + 1, np.int64)
                before[of_length] = first
                length = lists["length"].to_numpy()
                bins, offsets = Plan.unpacked(row["plan"].as_py()).places(length, before[length] + lists["nth"].to_numpy())
                sequence = pa.array((row["unit"].as_py() << BINS) + bins, pa.int64())
                columns = [lists[name] for name in ("doc_id", "piece", "start", "length", "ids")]
                yield pa.RecordBatch.from_arrays([*columns, sequence, pa.array(offsets, pa.int64())], names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    known = _places(units, plans)
    placed = pieces.join(known.hint("shuffle_hash"), F.col("part") == F.col("of_part")).select(*LISTS, "unit", "plan", "starts")
    return placed.mapInArrow(place, PACKED), certificates


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids`` (little-endian 32-bit), ``sequence_id, offset``."""
    return pack_certified(docs, path, capacity, end_id, id_col, text_col)[0]
