"""Ids, token files, packing and counts against the tokenizers library itself."""

import math
import random
import time
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import DOCS, ODD_TEXTS, frame, prose, tokenizer, true_ids, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.llm import packing, token_counts, token_files
from plumbline.llm.common import busy, idle
from plumbline.llm.queries import op4_token_files, op7_token_counts, op9_best_fit_packing, tokenizer_file
from plumbline.llm.tokens import Encoder, encoder, forget_encoder, vocabulary
from plumbline.session import scratch_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_library(name):
    own = encoder(tokenizer_file(name))
    for text in [*ODD_TEXTS, *prose(60)]:
        assert own.ids(text).tolist() == true_ids(name, text), text


@pytest.mark.parametrize("name", FILES)
def test_every_token_of_the_file_merges_back_to_itself(name):
    """What makes merging by the rank of the result equal to merging by pairs."""
    vocab, special, suffix = vocabulary(tokenizer_file(name))
    own = Encoder(tokenizer_file(name))
    model = tokenizer(name).model
    for token, number in vocab.items():
        if token not in special and (not suffix or token.endswith(suffix)):
            body = token[: -len(suffix)] if suffix else token
            assert [t.id for t in model.tokenize(body)] == [number], token
    assert own.size == max([*vocab.values(), *special.values()]) + 1


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x24F, codec="utf-8"), st.sampled_from(" \n\tab.,'s’—")), max_size=60))
def test_ids_equal_the_library_on_any_text(name, text):
    assert encoder(tokenizer_file(name)).ids(text).tolist() == true_ids(name, text)


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr("plumbline.llm.tokens.MEMO", 50)
    own = Encoder(tokenizer_file("word_bpe_49k.json"))
    for text in prose(30):
        assert own.ids(text).tolist() == true_ids("word_bpe_49k.json", text)
    assert len(own.memo) <= 200


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=2000), st.data())
def test_directly_addressable_codes(ids, data):
    ids = np.array(ids, np.uint32)
    reader = token_files.DacReader(*token_files.dac_encode(ids))
    a, b = sorted((data.draw(st.integers(0, len(ids))), data.draw(st.integers(0, len(ids)))))
    assert reader.slice(a, b).tolist() == ids[a:b].tolist()
    at = data.draw(st.integers(0, len(ids) - 1))
    assert reader.get(at) == ids[at]


def expected_files(texts):
    start, out = 0, []
    for number, text in enumerate(texts):
        ids = np.array([*true_ids("word_bpe_49k.json", text), 2], "<u4")
        out.append((number, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_on_odd_texts(spark):
    texts = [*ODD_TEXTS, *prose(40)]
    out = scratch_path(spark, "test-files")
    token_files.write_token_files(with_clashes(frame(spark, texts)), tokenizer_file("word_bpe_49k.json"), out, block_tokens=100)
    read = token_files.read_token_files(spark, out)
    assert sorted(tuple(r) for r in read.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == expected_files(texts)
    stream = np.concatenate([np.array([*true_ids("word_bpe_49k.json", t), 2]) for t in texts])
    places = [0, 5, len(stream) // 2, len(stream) - 1]
    assert sorted(map(tuple, token_files.token_at(spark, out, places).collect())) == [(p, stream[p]) for p in places]


def test_token_files_of_nothing_and_of_repeated_rows(spark):
    out = scratch_path(spark, "test-files")
    token_files.write_token_files(frame(spark, []), tokenizer_file("word_bpe_49k.json"), out)
    assert token_files.read_token_files(spark, out).count() == 0
    out = scratch_path(spark, "test-files")
    same = frame(spark, ["b c"], 7).unionByName(frame(spark, ["b c"], 7)).unionByName(frame(spark, ["a"], 7))
    token_files.write_token_files(same, tokenizer_file("word_bpe_49k.json"), out)
    got = token_files.read_token_files(spark, out).orderBy("start").collect()
    assert [r["n_tokens"] for r in got].count(3) == 2 and [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]


def test_op4(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = sorted(tuple(r) for r in op4_token_files(spark, sf_dir).collect())
    assert got == expected_files([texts[k] for k in sorted(texts)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing_against_the_bound(sizes):
    bins, offsets, fill = packing.best_fit_decreasing(np.array(sizes, np.int64), 64)
    bound = packing.lower_bound(np.array(sizes, np.int64), 64)
    assert all(f <= 64 for f in fill) and sum(fill) == sum(sizes)
    assert bound <= len(fill) <= bound * 11 / 9 + 2
    for b in range(len(fill)):
        at = sorted((int(o), s) for x, o, s in zip(bins, offsets, sizes) if x == b)
        assert [o for o, _ in at] == [0, *np.cumsum([s for _, s in at])[:-1]]


def check_packing(rows, texts, capacity=1024):
    """Pieces rebuild every document; sequences are gapless and within the capacity."""
    of, seq = {}, {}
    for r in rows:
        of.setdefault(r["doc_id"], []).append(r)
        seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    total = 0
    for number, text in texts.items():
        ids = np.array([*true_ids("byte_bpe_50k.json", text), 2], "<u4")
        total += len(ids)
        own = sorted(of[number], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(math.ceil(len(ids) / capacity)))
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]] and sum(r["length"] for r in own) == len(ids)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
            assert r["piece"] == 0 or r["length"] == capacity
    for places in seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seq), total


def test_op9(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    n, total = check_packing(op9_best_fit_packing(spark, sf_dir).collect(), texts)
    assert n <= math.ceil(total / 1024) + 1


def test_packing_over_many_parts_and_odd_texts(spark):
    from pyspark.sql import functions as F

    texts = [*ODD_TEXTS, *prose(300)]
    docs = with_clashes(frame(spark, texts, parts=40))
    packed = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=256).withColumn("ids_crc32", F.crc32("ids"))
    n, total = check_packing(packed.collect(), dict(enumerate(texts)), 256)
    assert n <= 1.02 * total / 256 + 1  # forty parts of a few sequences each, the loosest case
    assert packing.pack(frame(spark, []), tokenizer_file("byte_bpe_50k.json")).count() == 0


def plain_best_fit(sizes, capacity):
    """Bins of best-fit decreasing, by trying every bin for every size."""
    left = []
    for size in sorted(sizes, reverse=True):
        fitting = [k for k, room in enumerate(left) if room >= size]
        if fitting:
            left[min(fitting, key=left.__getitem__)] -= size
        else:
            left.append(capacity - size)
    return len(left)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(1, 40)), max_size=12))
def test_a_plan_by_lengths_is_best_fit_decreasing(runs):
    sizes = np.array([size for size, n in runs for _ in range(n)], np.int64)
    bins, offsets, fill = packing.best_fit_decreasing(sizes, 64)
    assert len(fill) == plain_best_fit(sizes.tolist(), 64)
    for b in range(len(fill)):
        at = sorted((int(o), s) for x, o, s in zip(bins, offsets, sizes) if x == b)
        assert fill[b] <= 64 and [o for o, _ in at] == [0, *np.cumsum([s for _, s in at])[:-1]]


def test_partitions_of_different_lengths_pack_as_one_table(spark):
    from pyspark.sql import functions as F

    n_words = "CAST(IF(id < 600, 36 + id % 5, 18 + id % 3) AS INT)"
    docs = spark.range(0, 1200, 1, 4).selectExpr("id AS doc_id", f"rtrim(repeat('a ', {n_words})) AS text")
    assert docs.select(F.spark_partition_id()).distinct().count() == 4
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sizes = [len(true_ids("byte_bpe_50k.json", t)) + 1 for t in texts.values()]
    assert max(sizes[600:]) + min(sizes[:600]) <= 64 < 2 * min(sizes[:600])
    packed = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=64).withColumn("ids_crc32", F.crc32("ids"))
    n, _ = check_packing(packed.collect(), texts, 64)
    assert n == plain_best_fit(sizes, 64) == packing.lower_bound(np.array(sizes), 64)


def counts_frame(spark, parts):
    rows = [(part, length, n) for part, count in enumerate(parts) for length, n in count.items()]
    return spark.createDataFrame(rows, "part long, length long, n long")


def check_rounds(spark, parts, capacity=64):
    """Bins of the last units, and certificates by round, which must hold of the counts they are of."""
    units, plans, certificates = packing.exchanged(counts_frame(spark, parts), capacity)
    held = sorted((r["part"], r["length"], r["n"]) for r in units.collect())
    assert held == sorted((p, length, n) for p, c in enumerate(parts) for length, n in c.items())  # each count in one unit
    rounds = {}
    for r in certificates.collect():
        level, number = r["unit"] >> packing.UNITS, r["unit"] & ((1 << packing.UNITS) - 1)
        assert level == r["round"] and r["bound"] <= r["bins"]
        rounds.setdefault(level, {})[number] = r
    first = rounds[0]
    for number, r in first.items():
        sizes = [length for length, n in parts[number].items() for _ in range(n)]
        assert r["bins"] == plain_best_fit(sizes, capacity) and r["bound"] == packing.lower_bound(np.array(sizes), capacity)
        assert r["spare"] == r["bins"] * capacity - sum(sizes)
    return sum(r["bins"] for r in plans.collect()), rounds


def all_sizes(parts):
    return [length for c in parts for length, n in c.items() for _ in range(n)]


def test_partitions_that_meet_the_bound_keep_their_documents(spark):
    bins, rounds = check_rounds(spark, [{32: 8, 16: 4}, {64: 3}, {40: 2, 24: 2}])
    assert bins == 5 + 3 + 2 and set(rounds) == {0}


def test_partitions_with_gaps_exchange_and_rerun(spark):
    # 40 and 24 fill a sequence together, each alone leaves room: 20 partitions, so two rounds of exchange.
    parts = [{40: 9} if k < 10 else {24: 9} for k in range(20)]
    bins, rounds = check_rounds(spark, parts)
    assert sum(r["bins"] for r in rounds[0].values()) == 10 * 9 + 10 * 5
    assert set(rounds) == {0, 1, 2} and bins == 90 == packing.lower_bound(np.array(all_sizes(parts)), 64)


def test_full_partitions_are_settled_and_the_rest_goes_on(spark):
    parts = [{64: 5}, {40: 3}, {24: 3}, {32: 2}] + [{40: 1}] * 17 + [{24: 1}] * 17
    bins, rounds = check_rounds(spark, parts)
    assert set(rounds[0]) == set(range(38)) and bins == 5 + 3 + 1 + 17
    # The two full partitions are in no later round.
    assert sum(r["bins"] * 64 - r["spare"] for r in rounds[1].values()) == 3 * 64 + 17 * 64


def test_settling_early_never_costs_a_sequence(spark):
    own = random.Random(3)
    for _ in range(4):
        parts = [{own.randint(1, 64): own.randint(1, 4) for _ in range(own.randint(1, 3))} | ({64: 1} if own.random() < 0.3 else {}) for _ in range(35)]
        bins, rounds = check_rounds(spark, parts)
        assert bins <= plain_best_fit(all_sizes(parts), 64)


def test_certificates_of_a_packing(spark):
    texts = prose(200)
    docs = frame(spark, texts, parts=9)
    packed, certificates = packing.pack_certified(docs, tokenizer_file("byte_bpe_50k.json"), 128)
    used = {r["sequence_id"] for r in packed.collect()}
    last = certificates.collect()
    assert {r["unit"] for r in last} >= {s >> packing.BINS for s in used}
    sizes = [length for t in texts for _, length in packing.pieces_of(len(true_ids("byte_bpe_50k.json", t)) + 1, 128)]
    assert packing.lower_bound(np.array(sizes), 128) <= len(used) <= plain_best_fit(sizes, 128)


def test_packing_null_and_repeated_ids(spark):
    rows = [(1, "to be", "", "", 0), (1, "or not to be", "", "", 0), (None, "that is", "", "", 0), (None, None, "", "", 0)]
    packed = packing.pack(spark.createDataFrame(rows, DOCS).repartition(3), tokenizer_file("byte_bpe_50k.json"), 16).collect()
    lengths = [len(true_ids("byte_bpe_50k.json", r[1])) + 1 for r in rows]
    assert sorted((r["doc_id"] or -1, r["length"]) for r in packed) == sorted((r[0] or -1, n) for r, n in zip(rows, lengths))
    assert {r["sequence_id"] for r in packed} == {packed[0]["sequence_id"]}
    assert sorted(r["offset"] for r in packed)[0] == 0 and sum(r["length"] for r in packed) == sum(lengths)


def test_op7(spark, sf_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sizes = np.array([len(true_ids("byte_bpe_50k.json", t)) for t in texts])
    sums = op7_token_counts(spark, sf_dir)
    for r in sums.collect():
        n = r["n_tokens"]
        assert r["docs"] == (sizes == n).sum() and r["docs_from"] == (sizes >= n).sum() and r["tokens_from"] == sizes[sizes >= n].sum()
        assert r["docs_upto"] == (sizes <= n).sum() and r["tokens_upto"] == sizes[sizes <= n].sum()
        assert r["truncated_total"] == np.minimum(sizes, n).sum()
    limits = [0, 1, 77, 1024, 10**6]
    for r in token_counts.truncated_totals(sums, limits).collect():
        kept = np.minimum(sizes, r["limit"]).sum()
        assert (r["docs_cut"], r["tokens_kept"], r["tokens_lost"]) == ((sizes > r["limit"]).sum(), kept, sizes.sum() - kept)
    for r in token_counts.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert r["n_tokens"] == np.sort(sizes)[math.ceil(r["share"] * len(sizes)) - 1]


def test_counts_of_odd_texts_and_of_nothing(spark):
    hist = token_counts.length_histogram(with_clashes(frame(spark, ODD_TEXTS)), tokenizer_file("byte_bpe_50k.json"))
    sizes = [len(true_ids("byte_bpe_50k.json", t)) for t in ODD_TEXTS]
    assert sorted(map(tuple, hist.collect())) == sorted((n, sizes.count(n)) for n in set(sizes))
    empty = token_counts.with_suffix_sums(token_counts.length_histogram(frame(spark, []), tokenizer_file("byte_bpe_50k.json")))
    assert empty.count() == 0
    assert [tuple(r) for r in token_counts.truncated_totals(empty, [5]).collect()] == [(5, 0, 0, 0)]


def test_pieces_of_long_texts_are_read_some_megabytes_at_a_time(spark):
    """However many rows a task writes: row groups are read as a whole."""
    text = " ".join(str(k % 10) for k in range(5_000_000))
    pieces = packing._cut(spark.createDataFrame([(7, text)], "doc_id long, text string").repartition(1), tokenizer_file("byte_bpe_50k.json"), 1024, 2)
    assert pieces.select(F.max(F.aggregate("length", F.lit(0).cast("long"), lambda s, n: s + n))).first()[0] * 4 <= packing.BATCH_BYTES + 4096 <= (1 << 20) + 4096
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in pieces.inputFiles()]
    assert max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)) <= packing.ROWS_READ < pieces.count()


def test_a_worker_without_tasks_forgets_its_encoder():
    encoder(tokenizer_file("byte_bpe_50k.json"))
    busy()
    idle(forget_encoder, 0.1)
    busy()  # another task
    time.sleep(0.5)
    assert encoder.cache_info().currsize
    idle(forget_encoder, 0.1)
    time.sleep(1)
    assert not encoder.cache_info().currsize
