"""Exact copies and chat text against plain Python and the SQL twins."""

import hashlib
import re

import duckdb
import pytest
from helpers import DOCS, ODD_TEXTS, frame, prose, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from check import difference
from plumbline.llm import chat_format, exact_dedup
from plumbline.llm.queries import QUERIES


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def plain_decisions(docs):
    groups = {}
    for n, t in docs:
        groups.setdefault(squeezed(t), []).append((-len(t or ""), n))
    return sorted((n, min(groups[squeezed(t)])[1], len(groups[squeezed(t)]), n == min(groups[squeezed(t)])[1], hashlib.sha256(squeezed(t).encode()).hexdigest()) for n, t in docs)


TEXTS = [*ODD_TEXTS, "a b c", "abc", " a\tb c ", "ab c", *["copy of one text"] * 40, *prose(20)]


@pytest.mark.parametrize("bits", [64, 1 << 10, exact_dedup.FILTER_BITS])
def test_decisions_whatever_the_filter(spark, bits):
    got = exact_dedup.decide(with_clashes(frame(spark, TEXTS)), bits=bits)
    assert sorted(tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == plain_decisions(list(enumerate(TEXTS)))


@pytest.mark.parametrize("bits", [64, exact_dedup.FILTER_BITS])
def test_one_row_of_each_group_stays(spark, bits):
    docs = with_clashes(frame(spark, TEXTS))
    want = sorted({k for _, k, *_ in plain_decisions(list(enumerate(TEXTS)))})
    for rows in (docs, docs.unionByName(docs)):
        kept = exact_dedup.keep_one(rows, bits=bits)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want
    assert {tuple(r) for r in exact_dedup.keep_one(docs, bits=bits).collect()} <= {tuple(r) for r in docs.collect()}


def test_words_joined_by_key_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_BITS", 1 << 8)
    test_decisions_whatever_the_filter(spark, None)
    test_one_row_of_each_group_stays(spark, None)


@pytest.mark.parametrize("rows", [300, 30_000])
def test_the_filter_grows_with_the_rows(spark, rows):
    bits = exact_dedup.filter_bits(rows)
    assert bits >= 16 * rows and exact_dedup.filter_bits(0) == 1 << 16
    keys = spark.range(rows).select(F.col("id").cast("string").alias("k"))
    keys = keys.unionByName(keys.where("k < 20"))
    tested = exact_dedup.possibly_repeated(keys, "k", exact_dedup.marked_bits(keys, "k", bits), bits)
    maybe = tested.where("__maybe")
    assert maybe.where("k < 20").count() == 40
    assert maybe.count() - 40 < rows / 40  # nearly all single rows pass straight through


def test_null_ids_and_nothing(spark):
    docs = spark.createDataFrame([(None, "x", "", "", 0), (None, "y", "", "", 0), (3, "x ", "", "", 0), (4, " x", "", "", 0)], DOCS)
    got = {(r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup.decide(docs).collect()}
    assert got == {(None, None, True), (None, 3, False), (3, 3, True), (4, 3, False)}
    assert exact_dedup.decide(frame(spark, [])).count() == 0 and exact_dedup.keep_one(frame(spark, [])).count() == 0


def test_repeated_ids_of_different_white_space_keep_one_row(spark):
    rows = [(1, "a b"), (1, "ab"), (2, "ab"), (7, "c d"), (7, "cd "), (7, " cd"), (9, "same"), (9, "same"), (None, "x y"), (None, "xy ")]
    docs = spark.createDataFrame([(n, t, "en", "", 0) for n, t in rows], DOCS).repartition(4)
    got = exact_dedup.decide(docs).collect()
    assert len(got) == len(rows)
    for key, size in {1: 3, 7: 3, 9: 2, None: 2}.items():
        group = [r for r in got if r["keep_id"] == key]
        assert len(group) == size == group[0]["group_size"] and sum(r["kept"] for r in group) == 1
        assert next(r for r in group if r["kept"])["doc_id"] == key
    # The pipeline's rows are the same ones, whatever the order of the input.
    kept = [sorted(map(str, (tuple(r) for r in exact_dedup.keep_one(docs.repartition(n)).collect()))) for n in (1, 3, 5)]
    assert len(kept[0]) == 4 and kept[0] == kept[1] == kept[2]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", [r for r in rows if r[0] is not None])
    assert difference(exact_dedup.decide(docs.where("doc_id IS NOT NULL")), db, QUERIES["op8_exact_dedup"].sql) is None


@pytest.mark.parametrize("name", ["op8_exact_dedup", "op10_chat_formatting"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    assert difference(QUERIES[name].run(spark, sf_dir), db, QUERIES[name].sql) is None


def test_only_possible_copies_shuffle(spark):
    plan = exact_dedup.decide(frame(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


ODD_SAID = [
    None, "", "\\", "\\\\n", "</s>", "<s>", "a</s><s>user\nb", "[INST] x [/INST]", "<<SYS>>y<</SYS>>", "<\\/s>", "[\\INST]", "<</s>", "end<", "[", "\n", "\\</s>",
    "<<<SYS>>>", "[[INST]]", "日本🤦", "$0 $1", "/s>", "INST]",
]
ROLES = ["user", "assistant", "system", "tool", "", None, "odd\nrole", "</s>", "a\\b", "[INST]", "USER"]


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_round_trip_of_odd_texts_and_roles(spark):
    rows = [(c, t, ROLES[(c + t) % len(ROLES)], ODD_SAID[(3 * c + t) % len(ODD_SAID)]) for c in range(40) for t in range(5)]
    rows += [(99, k, r, s) for k, (r, s) in enumerate((r, s) for r in ROLES for s in ODD_SAID)] + [(None, 0, "user", "x"), (7, 1, "user", "tie"), (7, 1, "user", "tie")]
    out = chat_format.format_chats(with_clashes(turns_of(spark, rows)))
    read = out.withColumn("turns", chat_format.parse(F.col("formatted"))).withColumn("masked", chat_format.under_loss(F.col("formatted"), F.col("loss"))).collect()
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert len(read) == len(want)
    for r in read:
        own = want[r["conv_id"]]
        assert r["identical"] and [tuple(t) for t in r["turns"]] == own
        assert r["masked"] == "".join(t for role, t in own if role == "assistant")
        body = re.sub(r"\\[\s\S]", "?", r["formatted"])  # what is not escaped
        assert body.count("</s>") == len(own)


def test_plain_turns_are_not_escaped(spark):
    out = chat_format.format_chats(turns_of(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "yo < [")])).first()
    assert out["formatted"] == "<s>user\n[INST] hi [/INST]</s><s>assistant\nyo < [</s>" and out["escaped"] == 0


def test_text_outside_the_grammar_is_seen(spark):
    bad = ["<s>user\nno marks</s>", "<s>tool\nx", "tool\nx</s>", "<s>tool\n<s>x</s>", "<s>norole</s>"]
    rows = spark.createDataFrame([(b,) for b in bad], "t string").select(chat_format.parse(F.col("t")).alias("p")).collect()
    assert all(None in r["p"] for r in rows)
    assert chat_format.format_chats(turns_of(spark, [])).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), st.text(st.sampled_from("\\<>/s[]INSTSY \n"), max_size=12)), min_size=1, max_size=25))
def test_round_trip_of_any_marks(spark, said):
    out = chat_format.format_chats(turns_of(spark, [(1, k, r, t) for k, (r, t) in enumerate(said)]))
    row = out.withColumn("turns", chat_format.parse(F.col("formatted"))).first()
    assert row["identical"] and [tuple(t) for t in row["turns"]] == said
