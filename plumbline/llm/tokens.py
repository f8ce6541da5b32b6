"""Token ids of whole texts as the ``tokenizers`` library gives them, inside Spark tasks.

A tokenizer file (its path is a parameter) holds ranks of merges.  Texts in the
common scripts go through a rank encoder built from that file; any other text
(rare scripts, control characters, strings of special tokens) goes through the
``tokenizers`` library itself, so every text gets that library's ids.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.llm.common import give_back

#: The pre-tokenizer pattern of byte-level BPE files (fixed value of that public format).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for files with word ends, for texts without any character that RARE finds.
WORD_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Characters outside Latin text and its punctuation, where two Unicode tables might differ.
RARE = re.compile("[^\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ‐-‧‰-⁞]")
WORD_END = "\x01"  # never in a text that takes this way, as RARE finds it
MEMO = 300_000  # words remembered in a worker


def byte_of_symbol() -> dict[str, int]:
    """How byte-level files write each byte as a printable character."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def vocabulary(path: str) -> tuple[dict[str, int], dict[str, int], str]:
    """``(token strings to ids, special strings to ids, word-end suffix)`` of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    return whole["model"]["vocab"], special, whole["model"].get("end_of_word_suffix") or ""


class Encoder:
    """Ids of texts, as 32-bit little-endian bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        vocab, self.special, suffix = vocabulary(path)
        byte = byte_of_symbol()
        ranks = {}
        for token, number in vocab.items():
            if token in self.special:
                continue
            ends = bool(suffix) and token.endswith(suffix)
            body = bytes(byte[c] for c in (token[: -len(suffix)] if ends else token))
            ranks[body + WORD_END.encode() if ends else body] = number
        self.words = bool(suffix)
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.fast = tiktoken.Encoding(
            "own", pat_str=f"[^{WORD_END}]+{WORD_END}" if self.words else BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        self.memo: dict[str, bytes] = {}

    def plain(self, text: str) -> bool:
        return not RARE.search(text) and not any(s in text for s in self.special)

    def raw(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null text counts as empty."""
        if not text:
            return b""
        if not self.plain(text):
            return array("I", self.slow.encode(text, add_special_tokens=False).ids).tobytes()
        if not self.words:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        memo = self.memo
        words = text.lower().split()
        new = set(words).difference(memo)
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = set(words)
        for word in new:
            marked = WORD_END.join([*WORD_PATTERN.findall(word), ""])
            memo[word] = array("I", self.fast.encode_ordinary(marked)).tobytes()
        return b"".join(map(memo.__getitem__, words))

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.raw(text), "<u4")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def forget_encoder() -> None:
    """Free the encoders of a worker."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        give_back()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[str | None]:
    """The texts of a batch, one at a time, so that only one is a Python string at once."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.as_py()


def lengths(docs: DataFrame, path: str) -> DataFrame:
    """``(n_tokens, docs)`` counted per batch: what a histogram of lengths sums up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            sizes = np.fromiter((len(own.raw(t)) // 4 for t in texts_of(batch)), np.int64, batch.num_rows)
            values, counts = np.unique(sizes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["n_tokens", "docs"])

    return docs.select("text").mapInArrow(count, "n_tokens long, docs long")
