import random

from pyspark.sql import functions as F

from plumbline.functions import text


def test_tokenizer_edges(spark):
    df = spark.createDataFrame([(1, " a  b  "), (2, ""), (3, None)], "id int, t string")
    out = {r["id"]: r["tokens"] for r in text.tokenize(df, "t").collect()}
    assert out == {1: ["", "a", "", "b"], 2: [""]}


def test_stop_words_ignore_case(spark):
    df = spark.createDataFrame([(["Number", "of", "red", "THE", "rings"],)], "tokens array<string>")
    assert text.remove_stop_words(df).first()["kept_tokens"] == ["red", "rings"]


def test_short_texts_have_no_ngram(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a", "b", "c", "d"],)], "kept_tokens array<string>")
    assert [r["ngrams"] for r in text.ngrams(df).collect()] == [[], ["a b c", "b c d"]]


def test_leading_ngram_equals_the_chain(spark):
    rng = random.Random(5)
    words = ["The", "number", "of", "a", "b", "C", "", "ü", "rings\tand", "\n", "  ", '"', "\\", "percentage"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(9))) for _ in range(300)] + ["", " ", "a b ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, name string")
    chain = text.ngrams(text.remove_stop_words(text.tokenize(df, "name")))
    slow = {r["id"]: r["g"] for r in chain.select("id", F.get("ngrams", F.lit(0)).alias("g")).collect()}
    fast = {r["id"]: r["leading_ngram"] for r in text.leading_ngram(df, "name").collect()}
    assert len(fast) == len(texts)
    assert {i: g for i, g in fast.items() if i in slow} == slow
    assert fast[len(texts) - 1] is None
