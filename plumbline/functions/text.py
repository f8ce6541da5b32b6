"""Tokens, stop words and n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.columns import lowercase_column

# Words that carry no meaning in indicator names.
INDICATOR_STOP_WORDS = [
    "number", "percent", "of", "the", "is", "are", "for", "with", "percentage", "conducted",
    "where", "were", "which", "to", "their", "was", "sessions", "there", "theme",
    "demonstration", "engagement", "meetings", "\\", '"',
]


def tokenize(df: DataFrame, col: str, out: str = "tokens") -> DataFrame:
    """Lower-case words split at each whitespace character.

    Rows without text are dropped first, as the tokenizer fails on null.
    """
    return Tokenizer(inputCol=col, outputCol=out).transform(df.where(F.col(col).isNotNull()))


def remove_stop_words(
    df: DataFrame, col: str = "tokens", words: Sequence[str] = INDICATOR_STOP_WORDS, out: str = "kept_tokens"
) -> DataFrame:
    """Tokens without the listed words, whatever their case."""
    return StopWordsRemover(inputCol=col, outputCol=out, stopWords=list(words)).transform(df)


def ngrams(df: DataFrame, col: str = "kept_tokens", n: int = 3, out: str = "ngrams") -> DataFrame:
    """Runs of ``n`` tokens joined by a blank; empty when there are fewer tokens."""
    return NGram(n=n, inputCol=col, outputCol=out).transform(df)


def leading_ngram(
    df: DataFrame,
    col: str,
    n: int = 3,
    words: Sequence[str] = INDICATOR_STOP_WORDS,
    out: str = "leading_ngram",
) -> DataFrame:
    """The first n-gram of the kept words, null for texts with fewer than ``n`` of them.

    Gives the first element of ``ngrams(remove_stop_words(tokenize(...)))``,
    without building the n-grams behind it.  The text is lower-cased in place.
    """
    df = lowercase_column(df, col)
    # Like the tokenizer: inner blanks give empty tokens, trailing ones do not.
    tokens = F.split(F.regexp_replace(col, r"\s+$", ""), r"\s")
    kept = F.filter(tokens, lambda t: ~t.isin([w.lower() for w in words]))
    return df.withColumn("_first", F.slice(kept, 1, n)).select(
        *df.columns, F.when(F.size("_first") == n, F.array_join("_first", " ")).alias(out)
    )
