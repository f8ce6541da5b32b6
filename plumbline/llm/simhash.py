"""Near duplicates by SimHash, from a byte-position inverted index with count filtering.

A fingerprint has 64 bits; a bit is 1 if it is set in more than half of the
XXH64 values (seed 42) of a text's word shingles.  Two fingerprints that differ in
at most four bits share at least four of their eight bytes, position by position.
The index posts every distinct fingerprint under a few triples of byte positions,
chosen so that any four shared bytes contain one of them whole.  Inside a posting
list the shared positional bytes of each pair are tallied, pairs that reach the
guaranteed four are retained, and their distance is verified.  A list emits a
spanning forest of its links, never all its pairs.

Lists longer than LIST_LIMIT are posted again under each fourth byte; lists that
stay longer still are linked exactly by common variants: two fingerprints within
four bits both lie within two bits of some value, so every fingerprint posts its
values within two bits and links to the least fingerprint there.

Defined cases: a null text, like one without words, has fingerprint zero, linked
like any other; fewer words than a shingle make one shingle; repeated rows share
a fingerprint; an empty table gives an empty result; columns other than id and
text never take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import id_and_text
from plumbline.llm.components import components
from plumbline.llm.exact_dedup import FILTER_BITS, marked_bits, possibly_repeated
from plumbline.llm.tokens import texts_of
from plumbline.session import pin

SHINGLE = 4
MAX_BITS = 4
SEED = 42
LIST_LIMIT = 1 << 14  # fingerprints of a posting list compared in one task


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a whole text (A-Z lower-cased, split at ASCII white space)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest, set_bits = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        part = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])])
        set_bits += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_hash, fp)``, one row per row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in texts_of(batch)), np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found)], ["doc_id", "text_hash", "fp"])

    rows = id_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def covering_triples() -> list[tuple[int, ...]]:
    """Triples of byte positions of which any four positions contain one: within a group, or two of it and one of the next."""
    groups = [(0, 1, 2), (3, 4, 5), (6, 7)]
    out = [t for g in groups for t in combinations(g, 3)]
    for k, g in enumerate(groups):
        out += [(*two, one) for two in combinations(g, 2) for one in groups[(k + 1) % 3]]
    return out


def _mask(positions: tuple[int, ...]) -> int:
    """The bits of some byte positions, as a signed long."""
    bits = sum(0xFF << 8 * p for p in positions)
    return bits - (1 << 64) if bits >> 63 else bits


def _posted(fps: DataFrame, lists: list[tuple[int, ...]], numbers: list[int] | None = None) -> DataFrame:
    """``(list, shared, fp)``: each fingerprint under each list of positions."""
    numbers = numbers or list(range(len(lists)))
    posts = [F.struct(F.lit(n).alias("list"), F.col("fp").bitwiseAND(F.lit(_mask(t))).alias("shared")) for n, t in zip(numbers, lists)]
    return fps.select("fp", F.explode(F.array(*posts)).alias("post")).select("post.list", "post.shared", "fp")


def forest(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Spanning forest of the links within one posting list (unsigned, distinct)."""
    rest, links, frontier = fps, [], []
    guaranteed = 8 - max_bits
    while len(rest):
        if not frontier:
            frontier, rest = [rest[0]], rest[1:]
            continue
        node = frontier.pop()
        differ = rest ^ node
        tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # shared positional bytes
        near = tally >= guaranteed
        near[near] = np.bitwise_count(differ[near]) <= max_bits
        if near.any():
            found = rest[near]
            links += [(int(node), int(f)) for f in found]
            frontier += list(found)
            rest = rest[~near]
    return links


def _link_lists(max_bits: int, limit: int):
    """Sorted postings to links ``(a, b)``, and ``(fp, list)`` with ``long`` set for lists beyond the limit."""

    def rows(a, b, lists, long):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(a, np.uint64).view(np.int64)), pa.array(np.asarray(b, np.uint64).view(np.int64)), pa.array(lists, pa.int32()), pa.array(long, pa.bool_())],
            ["a", "b", "list", "long"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, is_long = np.zeros(0, np.uint64), None, False

        def close():
            if not is_long and len(held) > 1 and (links := forest(np.unique(held), max_bits)):
                a, b = zip(*links)
                yield rows(a, b, [key[0]] * len(a), [False] * len(a))

        for batch in batches:
            lists, shared = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fps = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((lists[1:] != lists[:-1]) | (shared[1:] != shared[:-1])) + 1
            edges = np.concatenate([[0], cuts, [len(fps)]])
            # Lists of one row inside the batch have no pair; only the others are looked at.
            wide = np.flatnonzero(np.diff(edges) > 1)
            for k in sorted({0, *wide.tolist(), len(edges) - 2}) if len(fps) else []:
                a, b = int(edges[k]), int(edges[k + 1])
                this = (int(lists[a]), int(shared[a]))
                if this != key:
                    yield from close()
                    held, key, is_long = np.zeros(0, np.uint64), this, False
                held = np.concatenate([held, fps[a:b]])
                if len(held) > limit or is_long:
                    is_long = True
                    yield rows(held, held, [key[0]] * len(held), [True] * len(held))
                    held = np.zeros(0, np.uint64)
        yield from close()

    return run


def _variants(max_bits: int):
    """Every value within half the distance of a fingerprint."""
    half = max_bits - max_bits // 2
    flips = np.array([sum(1 << b for b in c) for n in range(half + 1) for c in combinations(range(64), n)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_numpy().view(np.uint64):
                values = (flips ^ fp).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(np.full(len(values), fp).view(np.int64))], ["value", "fp"])

    return run


def _hubs(max_bits: int):
    """Sorted ``(value, fp)``: a link from each fingerprint to the first one of its value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_value, last_hub = None, 0
        for batch in batches:
            values, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(fps):
                continue
            first = np.concatenate([[last_value is None or values[0] != last_value], values[1:] != values[:-1]])
            place = np.maximum.accumulate(np.where(first, np.arange(len(fps)), -1))
            hubs = np.where(place < 0, np.uint64(last_hub), fps[np.maximum(place, 0)])
            last_value, last_hub = values[-1], hubs[-1]
            near = (hubs != fps) & (np.bitwise_count(hubs ^ fps) <= max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(fps[near].view(np.int64)), pa.array(hubs[near].view(np.int64))], ["a", "b"])

    return run


def links_of(fps: DataFrame, max_bits: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column ``fp``) whose components are those of all pairs within ``max_bits``."""
    if max_bits != 4:
        raise ValueError("the chosen triples of positions guarantee distances of exactly up to four bits")
    schema, triples = "a long, b long, list int, long boolean", covering_triples()

    def listed(posts: DataFrame) -> DataFrame:
        dealt = posts.repartition(F.col("list"), F.col("shared")).sortWithinPartitions("list", "shared", "fp")
        return pin(dealt.mapInArrow(_link_lists(max_bits, limit), schema), "simhash-lists")

    first = listed(_posted(fps, triples))
    links = first.where("NOT long").select("a", "b")
    longer = first.where("long").select(F.col("a").alias("fp"), "list")
    if longer.isEmpty():
        return links
    fourths = [(t, p) for t in triples for p in range(8) if p not in t]
    wanted = F.array(
        *[F.struct(F.lit(n).alias("list"), F.lit(triples.index(t)).alias("of"), F.lit(_mask((*t, p))).alias("mask")) for n, (t, p) in enumerate(fourths)]
    )
    again = longer.select("fp", F.explode(F.filter(wanted, lambda w: w["of"] == F.col("list"))).alias("w"))
    second = listed(again.select(F.col("w.list").alias("list"), F.col("fp").bitwiseAND(F.col("w.mask")).alias("shared"), "fp"))
    links = links.unionByName(second.where("NOT long").select("a", "b"))
    hot = second.where("long").select(F.col("a").alias("fp")).distinct()
    if hot.isEmpty():
        return links
    values = hot.mapInArrow(_variants(max_bits), "value long, fp long").repartition(F.col("value")).sortWithinPartitions("value", "fp")
    return links.unionByName(values.mapInArrow(_hubs(max_bits), "a long, b long"))


def _components(prints: DataFrame, max_bits: int, limit: int) -> DataFrame:
    """``(of_fp, component_id, keep_hash, members)`` per distinct fingerprint of ``fingerprints``."""
    distinct = prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least"), F.count(F.lit(1)).alias("rows")
    )
    distinct = pin(distinct, "simhash-distinct")
    roots = components(links_of(distinct.select("fp"), max_bits, limit), "simhash-components")
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("root"), "fp", "least", "rows")
    rooted = pin(rooted, "simhash-rooted")
    whole = pin(rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("first"), F.sum("rows").alias("members")), "simhash-whole")
    out = rooted.join(whole, F.col("root") == F.col("of")).select(
        F.col("fp").alias("of_fp"), F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("keep_hash"), "members"
    )
    return pin(out, "simhash-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """One row per row: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (least id reachable), ``members`` (rows of the component)."""
    prints = pin(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    classes = _components(prints, max_bits, limit)
    out = prints.join(classes, F.col("fp") == F.col("of_fp"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "members")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the least ``doc_id`` (of repeated rows, one).

    Rows that certainly stay never shuffle: those to go are marked in a filter of
    fixed size, and only rows that hit it meet the list of those to go.
    """
    prints = pin(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    judged = prints.join(_components(prints, max_bits, limit), F.col("fp") == F.col("of_fp"))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("keep_hash"))
    keys = judged.groupBy("doc_id", "text_hash").agg(F.first(stays).alias("stays"), F.count(F.lit(1)).alias("same"))
    met = pin(keys.where("NOT stays OR same > 1").withColumn("key", F.xxhash64("doc_id", "text_hash")), "simhash-met")
    marks = pin(marked_bits(met, "key", FILTER_BITS, least=1), "simhash-bits")
    names = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), F.col(id_col).cast("long").alias("__id"), F.xxhash64(text).alias("__hash"))
    tested = possibly_repeated(keyed.withColumn("__key", F.xxhash64("__id", "__hash")), "__key", marks, FILTER_BITS)
    same_row = F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash"))
    maybe = tested.where("__maybe")
    clear = maybe.join(met, same_row, "left_anti").select("__row")
    repeated = maybe.join(met.where("stays"), same_row).dropDuplicates(["__id", "__hash"]).select("__row")
    whole = tested.where("NOT __maybe").select("__row").unionByName(clear).unionByName(repeated)
    return whole.select(*[F.col("__row").getField(c).alias(c) for c in names])
