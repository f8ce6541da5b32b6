"""Token ids in files of directly addressable codes.

A file holds blocks of whole documents in ascending ``doc_id`` order.  The ids of
a block are split into chunks of eight bits, lowest first.  Level 0 has the first
chunk of every id and a bitmap of the ids that go on; level 1 has the second chunk
of those, with its own bitmap, and so on.  A rank directory counts the set bits
before every 512th, so any id is found by a few look-ups, without decoding what
stands before it.  Files are written and read by Spark, so they can lie in any
store; a block is one row, and a shard is one range of ``doc_id``.

Defined cases: a null text counts as empty and has the end id alone; rows that
repeat a ``doc_id`` are written one after the other, by their ids; null ids come
first; an empty table gives an empty file; other columns never take part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import id_and_text, shuffle_partitions
from plumbline.llm.tokens import encoder, texts_of

BLOCK_TOKENS = 1 << 18  # a block closes with the document that reaches this
SUPER = 512  # bits between two entries of a rank directory
FILE = "shard int, block int, first long, n_tokens long, doc_ids array<long>, starts array<int>, chunks array<binary>, bitmaps array<binary>, ranks array<binary>"


def dac_encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """``(chunks, bitmaps, rank directories)``, one of each per level."""
    chunks, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        chunks.append((rest & 0xFF).astype(np.uint8).tobytes())
        goes_on = rest > 0xFF
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (SUPER // 8), np.uint8)])
        per_super = np.bitwise_count(bits.reshape(-1, SUPER // 8)).sum(axis=1, dtype=np.uint32)
        bitmaps.append(bits.tobytes())
        ranks.append(np.concatenate([[0], np.cumsum(per_super)]).astype("<u4").tobytes())
        if not goes_on.any():
            return chunks, bitmaps, ranks
        rest = rest[goes_on] >> 8


class DacReader:
    """Random access to the ids of one block."""

    def __init__(self, chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.chunks = [np.frombuffer(c, np.uint8) for c in chunks]
        self.bitmaps = [np.frombuffer(b, np.uint8) for b in bitmaps]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    def __len__(self) -> int:
        return len(self.chunks[0])

    def rank(self, level: int, at: int) -> int:
        """Set bits before ``at``: one directory entry and at most 64 bytes."""
        bitmap, block = self.bitmaps[level], at // SUPER
        ones = int(self.ranks[level][block]) + int(np.bitwise_count(bitmap[block * SUPER // 8 : at // 8]).sum(dtype=np.int64))
        return ones + (int(bitmap[at // 8]) & ((1 << at % 8) - 1)).bit_count() if at % 8 else ones

    def get(self, at: int) -> int:
        """The id at a place."""
        value = 0
        for level in range(len(self.chunks)):
            value |= int(self.chunks[level][at]) << 8 * level
            if not self.bitmaps[level][at // 8] >> (at % 8) & 1:
                return value
            at = self.rank(level, at)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range; only its own chunks are touched."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        value = self.chunks[0][start:stop].astype(np.uint32)
        places, at, to = np.arange(stop - start), start, stop
        for level in range(1, len(self.chunks)):
            bits = np.unpackbits(self.bitmaps[level - 1][at // 8 : (to + 7) // 8], bitorder="little")[at % 8 : at % 8 + to - at].astype(bool)
            places = places[bits]
            if not len(places):
                break
            at = self.rank(level - 1, at)
            to = at + len(places)
            value[places] |= self.chunks[level][at:to].astype(np.uint32) << np.uint32(8 * level)
        return value


def _encode_task(path: str, end_id: int, bounds: list[int]):
    end, cuts = int(end_id).to_bytes(4, "little"), np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        width = "<u2" if max(own.size, end_id + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            shards = [0 if n is None else int(np.searchsorted(cuts, n, "right")) for n in numbers]
            packed = [np.frombuffer(own.raw(t) + end, "<u4").astype(width).tobytes() for t in texts_of(batch)]
            wide = pa.array([int(width[-1])] * len(packed), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int32()), pa.array(numbers, pa.int64()), wide, pa.array(packed, pa.binary())], ["shard", "doc_id", "width", "packed"]
            )

    return run


def _block(shard: int, block: int, first: int, docs: list[tuple[int | None, np.ndarray]]) -> pa.RecordBatch:
    ids = np.concatenate([x for _, x in docs])
    starts = np.cumsum([0, *(len(x) for _, x in docs[:-1])])
    schema = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32()))]
        + [(c, pa.list_(pa.binary())) for c in ("chunks", "bitmaps", "ranks")]
    )
    values = [shard, block, first, len(ids), [n for n, _ in docs], starts.tolist(), *dac_encode(ids)]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def _blocks_task(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first, held, docs = None, 0, 0, 0, []
        for batch in batches:
            for row in range(batch.num_rows):
                of = batch.column(0)[row].as_py()
                if docs and (of != shard or held >= block_tokens):
                    yield _block(shard, block, first, docs)
                    block, first, held, docs = block + 1, first + held, 0, []
                if of != shard:
                    shard, block, first = of, 0, 0
                ids = np.frombuffer(batch.column(3)[row].as_py(), f"<u{batch.column(2)[row].as_py()}").astype(np.uint32)
                docs.append((batch.column(1)[row].as_py(), ids))
                held += len(ids)
        if docs:
            yield _block(shard, block, first, docs)

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 2, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write them to ``out`` in ascending ``doc_id`` order.

    Documents are encoded where they are read; only ids are dealt out, to one
    range of ``doc_id`` each.  The ranges come from quantiles of that column alone.
    """
    rows = id_and_text(docs, id_col, text_col)
    shards = shuffle_partitions(docs.sparkSession)
    cuts = rows.agg(F.percentile_approx("doc_id", [k / shards for k in range(1, shards)], 100 * shards)).first()[0] if shards > 1 else None
    encoded = rows.mapInArrow(_encode_task(tokenizer_path, end_id, sorted(set(cuts or []))), "shard int, doc_id long, width int, packed binary")
    dealt = encoded.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "doc_id", "packed")
    dealt.mapInArrow(_blocks_task(block_tokens), FILE).write.parquet(out)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(of_shard, base)``: how many ids stand before each shard.  One row per shard, as many as ranges were made."""
    totals = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    rows, base = [], 0
    for row in totals:
        rows.append((row["shard"], base))
        base += row["n"]
    return spark.createDataFrame(rows, "of_shard int, base long")


def _read_task():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = DacReader(row["chunks"], row["bitmaps"], row["ranks"])
                ends = [*row["starts"][1:], len(reader)]
                found = [reader.slice(a, b).astype("<u4").tobytes() for a, b in zip(row["starts"], ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(ends), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["first"] + s for s in row["starts"]], pa.int64()),
                        pa.array([len(x) // 4 for x in found], pa.int64()),
                        pa.array([zlib.crc32(x) for x in found], pa.int64()),
                        pa.array(found, pa.binary()),
                    ],
                    names=["shard", "doc_id", "in_shard", "n_tokens", "ids_crc32", "ids"],
                )

    return run


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32, ids``."""
    blocks = spark.read.parquet(path).select("shard", "first", "doc_ids", "starts", "chunks", "bitmaps", "ranks")
    docs = blocks.mapInArrow(_read_task(), "shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long, ids binary")
    based = docs.join(F.broadcast(shard_starts(spark, path)), F.col("shard") == F.col("of_shard"))
    return based.select("doc_id", (F.col("base") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32", "ids")


def token_at(spark: SparkSession, path: str, places: list[int]) -> DataFrame:
    """``(place, id)`` for places in the whole stream of ids, each found in its block without decoding it."""
    based = spark.read.parquet(path).join(F.broadcast(shard_starts(spark, path)), F.col("shard") == F.col("of_shard"))
    start = F.col("base") + F.col("first")
    wanted = F.filter(F.array(*[F.lit(int(p)).cast("long") for p in places]), lambda p: (p >= start) & (p < start + F.col("n_tokens")))
    hit = based.withColumn("start", start).withColumn("places", wanted).where(F.size("places") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = DacReader(row["chunks"], row["bitmaps"], row["ranks"])
                ids = [reader.get(p - row["start"]) for p in row["places"]]
                yield pa.RecordBatch.from_arrays([pa.array(row["places"], pa.int64()), pa.array(ids, pa.int64())], ["place", "id"])

    return hit.select("start", "places", "chunks", "bitmaps", "ranks").mapInArrow(run, "place long, id long")
