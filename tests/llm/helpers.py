"""Fixtures and plain rebuilds that the tests of this folder share."""

from __future__ import annotations

import random
from functools import lru_cache

from plumbline.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside, to show that they do not clash.
CLASHING = ["__id", "__sha", "__row", "__maybe", "part", "bin", "open", "word", "marks", "shard", "batch", "score", "fp", "n_tokens", "kept"]
ODD_TEXTS = [
    None, "", " ", "\n\t \n", "a", "Ab  c\n\n d", "  two  spaces ", "x y", "naïve café ÀÉ", "日本語 テキスト", "emoji 🤦🏼‍♂️ ok", "I'll've it's DON'T",
    "<|endoftext|> in <|startoftext|>text", "tab\tand\x0bvt\x0cff\rcr", "½ ² ³ ſ ſt İi ǅ", "a\x01b \x1c c", "é Å", "1234567890 12 3", "!!! ... ,;: __x__",
    "word " * 3000, "Z" * 5000, "line one\nline two\nline one\n", "   ​ 　x",
]


def rows(texts, start: int = 0, step: int = 1):
    return [(start + step * k, t, "en", "src0", len(t or "")) for k, t in enumerate(texts)]


def frame(spark, texts, start: int = 0, step: int = 1, parts: int = 3):
    return spark.createDataFrame(rows(texts, start, step), DOCS).repartition(parts)


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in CLASHING})


def prose(n_docs: int, seed: int = 5, words: int = 120) -> list[str]:
    """Texts from a small vocabulary, with line ends."""
    own = random.Random(seed)
    lexicon = ["".join(own.choice("abcdefghilmnoprstu") for _ in range(own.randint(2, 8))) for _ in range(400)]
    return [" ".join(own.choice(lexicon) + own.choice(["", "", "", ",", ".\n"]) for _ in range(own.randint(1, words))) for _ in range(n_docs)]


@lru_cache
def tokenizer(name: str):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_file(name))
    own.no_truncation()
    own.no_padding()
    return own


def true_ids(name: str, text: str | None) -> list[int]:
    return tokenizer(name).encode(text or "", add_special_tokens=False).ids
