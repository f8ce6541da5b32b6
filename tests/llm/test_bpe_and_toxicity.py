"""The lexicon encoder against the tokenizers library; the toxicity model on rows it never saw."""

import hashlib
import zlib

import numpy as np
import pytest
from helpers import ODD_TEXTS, frame, prose, tokenizer, true_ids, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import bpe_lexicon, toxicity
from plumbline.llm.queries import op2_bpe_lexicon, op3_toxicity, tokenizer_file

NAME = "byte_bpe_50k.json"


def test_exact_merges_equal_the_library():
    own = bpe_lexicon.merges(tokenizer_file(NAME))
    for text in [*ODD_TEXTS, *prose(40)]:
        ids = [i for w in own.words(text or "") for i in own.ids(w)]
        assert ids == true_ids(NAME, text), text
        assert own.text_of(ids) == tokenizer(NAME).decode(ids, skip_special_tokens=False) == (text or "")


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\tab.,'s’—")), max_size=60))
def test_exact_merges_on_any_text(text):
    own = bpe_lexicon.merges(tokenizer_file(NAME))
    assert [i for w in own.words(text) for i in own.ids(w)] == true_ids(NAME, text)


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abcdeth "), min_size=65, max_size=200))
def test_long_words_merge_alike(text):
    own = bpe_lexicon.merges(tokenizer_file(NAME))
    word = text.replace(" ", "e")
    assert own.ids(word) == true_ids(NAME, word)


@settings(max_examples=80, deadline=None)
@given(st.sets(st.binary(max_size=6), max_size=60), st.lists(st.binary(max_size=7), max_size=40))
def test_automaton_numbers_its_words_and_no_others(tmp_path_factory, words, others):
    words = sorted(words)
    arrays = bpe_lexicon.compile_automaton(words)
    path = str(tmp_path_factory.mktemp("lexicon") / "x.bin")
    with open(path, "wb") as file:
        file.write(bpe_lexicon.file_of_arrays(arrays | {"offsets": np.zeros(1, np.int64), "outputs": np.zeros(0, np.uint8)}))
    asked = [*words, *others, b"z" * 80]
    got = bpe_lexicon.Transducer(path).rows(asked).tolist()
    assert got == [words.index(w) if w in words else -1 for w in asked]


def test_automaton_shares_endings():
    words = sorted(a + b for a in (b"un", b"re", b"") for b in (b"doing", b"making", b"seeing"))
    arrays = bpe_lexicon.compile_automaton(words)
    trie = {w[:k] for w in words for k in range(len(w) + 1)}
    assert len(arrays["final"]) < len(trie) / 2
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in trie}
    assert len(arrays["final"]) == len(endings)  # minimal: one state for each set of endings


@pytest.mark.parametrize("most", [0, 5, 1 << 18])
def test_encoding_does_not_depend_on_the_lexicon(spark, most):
    texts = [*ODD_TEXTS, *prose(30)]
    docs, path = with_clashes(frame(spark, texts)), tokenizer_file(NAME)
    lexicon = bpe_lexicon.build_lexicon(docs, path, most)
    expected = [(k, true_ids(NAME, t), t or "") for k, t in enumerate(texts)]
    for found in (bpe_lexicon.decode(bpe_lexicon.encode(docs, path, lexicon), path), bpe_lexicon.round_trip(docs, path, lexicon)):
        assert sorted((r["doc_id"], r["ids"], r["decoded"]) for r in found.collect()) == expected


def test_encoding_keeps_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "c"), (None, "a b"), (None, None), (1, "c")], "doc_id long, text string")
    path = tokenizer_file(NAME)
    rows = bpe_lexicon.round_trip(docs, path, bpe_lexicon.build_lexicon(docs, path)).collect()
    got = sorted((str(r["doc_id"]), r["decoded"], r["ids"]) for r in rows)
    assert got == sorted((str(r["doc_id"]), r["text"] or "", true_ids(NAME, r["text"])) for r in docs.collect())


def test_long_texts_decode_in_pieces(monkeypatch):
    monkeypatch.setattr(bpe_lexicon, "PIECE", 3)
    text = "naïve 日本語 " * 9
    assert bpe_lexicon.merges(tokenizer_file(NAME)).text_of(true_ids(NAME, text)) == text


def test_lexicon_holds_the_most_frequent_words(spark):
    texts = ["a a a b b c d"] * 3
    counts = bpe_lexicon.word_counts(frame(spark, texts), tokenizer_file(NAME))
    assert {r["word"]: r["n"] for r in counts.collect()} == {"a": 3, " a": 6, " b": 6, " c": 3, " d": 3}
    assert {r["word"] for r in bpe_lexicon.frequent_words(counts, 3).collect()} == {" a", " b"}
    assert bpe_lexicon.frequent_words(counts, 1).count() == 0


def test_encoding_of_nothing(spark):
    lexicon = bpe_lexicon.build_lexicon(frame(spark, []), tokenizer_file(NAME))
    assert bpe_lexicon.encode(frame(spark, []), tokenizer_file(NAME), lexicon).count() == 0


def test_op2(spark, sf_dir):
    for r in op2_bpe_lexicon(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").collect():
        ids = true_ids(NAME, r["text"])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def plain_kernel(a, b):
    """Common subsequences of three, weighted by the stretches they span."""
    def table(s):
        out = {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    key = s[i] + s[j] + s[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    x, y = table(a), table(b)
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


@settings(max_examples=80, deadline=None)
@given(st.text("abcid", min_size=3, max_size=8), st.text("abcid", min_size=4, max_size=8))
def test_kernel_equals_the_definition(unit, landmark):
    got, want = toxicity.Kernel([landmark]).values([unit])[0, 0], plain_kernel(unit, landmark)
    assert got == pytest.approx(want, abs=1e-4) if want >= toxicity.FLOOR + 1e-4 else got == pytest.approx(0 if want < toxicity.FLOOR - 1e-4 else want, abs=0.4)


def labelled(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_op3_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op3_toxicity(spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    got = rows.join(labelled(spark, sf_dir), "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    right = sum(r["predicted"] == r["toxic"] for r in got) / len(got)
    caught = sum(r["predicted"] for r in got if r["toxic"]) / max(1, sum(r["toxic"] for r in got))
    assert right > 0.97 and caught > 0.8


def test_gapped_and_inserted_characters_are_tolerated(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, labelled(spark, sf_dir))
    assert any(m in "idiot" for m in model.landmarks) and len(model.landmarks) <= toxicity.LANDMARKS
    forms = ["you idiot here", "you idioxt here", "you i-d-i-o-t here", "you i d i o t here", "you IDIOT!! here", "you 1d1ot here", "you idi.ot, here"]
    plain = ["you would here", "", None, " ", "the a of and", "x" * 3000]
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(with_clashes(frame(spark, [*forms, *plain])).drop("score"), model).collect()}
    assert all(scores[k] >= 0.3 for k in range(len(forms))), scores
    assert all(scores[k] < 0.3 for k in range(len(forms), len(forms) + len(plain))), scores


def test_scores_do_not_depend_on_other_columns_or_rows(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, labelled(spark, sf_dir))
    a = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    twice = toxicity.score(docs.unionByName(docs).selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source").repartition(5), model).collect()
    assert {(r["doc_id"], r["score"]) for r in twice} == set(a.items())


def test_without_usable_labels(spark):
    docs = frame(spark, ["a b c", None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    odd = spark.createDataFrame([(0, None), (None, 1), (1, 0)], "doc_id long, toxic int")
    kept = toxicity.keep_clean(with_clashes(docs), odd)
    assert kept.count() == 2 and kept.columns == with_clashes(docs).columns
    assert toxicity.keep_clean(frame(spark, []), none).count() == 0
