"""Byte-level BPE with a lexicon compiled into a minimal acyclic transducer.

Words (pre-tokens) are counted over all documents.  The most frequent ones are
compiled, with the ids they encode to, into an automaton that shares prefixes and
suffixes; each edge adds to an output, and the sum along a word's path is the
number of its ids' row.  The arrays are laid in one file that Spark sends to every
executor, where tasks map it into memory.  Words outside the lexicon are merged
exactly by the ranks of the tokenizer file, so the lexicon changes speed only.

Defined cases: a null text counts as empty and has no ids; texts of any length are
whole (a word of any length merges in n log n); rows that repeat a ``doc_id`` or have
none (null) are rows like others, each with its own result; repeated rows give repeated
results; an empty table gives an empty result; other columns never take part.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import id_and_text
from plumbline.llm.tokens import RARE, byte_of_symbol, texts_of, vocabulary
from plumbline.session import pin, scratch_path

LEXICON = 1 << 18  # words compiled at most; they pass through the driver, so this bounds it
LONGEST = 48  # bytes of the longest compiled word
MEMO = 300_000  # words remembered in a worker
FLUSH = 100_000  # words counted in a worker before they are sent on
GROUP = 2 << 20  # characters of text whose words are looked up together
PIECE = 1 << 20  # ids decoded at once, which bounds the index arrays of a very long text
#: The pre-tokenizer pattern of byte-level BPE files, for texts without any character that RARE finds.
PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class Merges:
    """Exact byte-level BPE by the ranks of a tokenizer file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        vocab, self.special, suffix = vocabulary(path)
        if suffix:
            raise ValueError("a byte-level file without word ends is expected")
        byte = byte_of_symbol()
        self.id_of = {bytes(byte[c] for c in t): n for t, n in vocab.items() if t not in self.special}
        # One word is one piece, so the ranks of the file decide every merge.
        self.whole = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=self.id_of, special_tokens={})
        table = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, number in self.id_of.items():
            table[number] = token
        for token, number in self.special.items():
            table[number] = token.encode()
        self.sizes = np.fromiter(map(len, table), np.int64, len(table))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        library = Tokenizer.from_file(path)
        self.library_split = library.pre_tokenizer.pre_tokenize_str
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text; special strings stand as words of their own."""
        found = any(s in text for s in self.special)
        if not found and not RARE.search(text):
            return PLAIN.findall(text)
        out: list[str] = []
        for part in self.special_pattern.split(text) if found else [text]:
            if found and part in self.special:
                out.append(part)
            else:
                out += [part[a:b] for _, (a, b) in self._split(part)]
        return out

    def _split(self, part: str) -> list:
        return self.library_split(part) if part else []

    def ids(self, word: str) -> list[int]:
        """The ids of one word."""
        return [self.special[word]] if word in self.special else self.whole.encode_ordinary(word)

    def text_of(self, ids: np.ndarray | list[int]) -> str:
        """The text of ids: the bytes of all tokens gathered from one array, a piece at a time."""
        ids, parts = np.asarray(ids, np.int64), []
        for first in range(0, len(ids), PIECE):
            piece = ids[first : first + PIECE]
            sizes = self.sizes[piece]
            ends = np.cumsum(sizes)
            at = np.repeat(self.starts[piece] - ends + sizes, sizes) + np.arange(ends[-1])
            parts.append(self.bytes[at].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def compile_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of sorted distinct words, in arrays.

    States with equal endings are one state.  ``keys`` are ``state * 256 + byte`` in
    order, ``targets`` the states they lead to, ``adds`` how many words come before
    those of the edge; a word's adds sum up to its place in the order of words.
    """
    register: dict[tuple, int] = {}
    counts: list[int] = []  # words that end below a state
    shapes: list[tuple] = []

    def settle(final: bool, edges: list[tuple[int, int]]) -> int:
        shape = (final, *edges)
        number = register.get(shape)
        if number is None:
            number = register[shape] = len(shapes)
            shapes.append(shape)
            counts.append(int(final) + sum(counts[t] for _, t in edges))
        return number

    path: list[list] = [[False, []]]  # the states of the last word that may still get edges
    last = b""
    for word in [*words, None]:
        common = 0
        if word is not None:
            limit = min(len(word), len(last))
            while common < limit and word[common] == last[common]:
                common += 1
        while len(path) - 1 > common:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(final, edges)))
        if word is None:
            break
        path += [[False, []] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    root = settle(*path[0])
    keys, targets, adds = [], [], []
    for state, (final, *edges) in enumerate(shapes):
        before = int(final)
        for byte, target in edges:
            keys.append(state * 256 + byte)
            targets.append(target)
            adds.append(before)
            before += counts[target]
    return {
        "keys": np.array(keys, np.int64),
        "targets": np.array(targets, np.int32),
        "adds": np.array(adds, np.int32),
        "final": np.array([s[0] for s in shapes], np.uint8),
        "root": np.array([root], np.int32),
    }


def file_of_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    """The content of one file: a line that says where each array lies, then the arrays, each at a multiple of 64 bytes."""
    at, places = 4096, {}
    for name, x in arrays.items():
        places[name] = (str(x.dtype), len(x), at)
        at += -(-x.nbytes // 64) * 64
    head = json.dumps(places).encode().ljust(4096)
    return head + b"".join(x.tobytes().ljust(-(-x.nbytes // 64) * 64, b"\0") for x in arrays.values())


class Transducer:
    """A lexicon file mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            places = json.loads(file.read(4096))
        whole = np.memmap(path, np.uint8, "r")
        for name, (kind, n, at) in places.items():
            setattr(self, name, whole[at : at + n * np.dtype(kind).itemsize].view(kind))

    def rows(self, words: list[bytes]) -> np.ndarray:
        """The output row of each word, -1 for words outside; all words walk one byte at a time together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        row, state = np.zeros(len(words), np.int64), np.full(len(words), self.root[0], np.int64)
        alive = np.flatnonzero((lengths <= LONGEST) & (len(self.keys) > 0))
        state[(lengths > LONGEST) | ((lengths > 0) & (len(self.keys) == 0))] = -1
        for step in range(LONGEST):
            alive = alive[lengths[alive] > step]
            if not len(alive):
                break
            key = state[alive] * 256 + text[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[at] == key
            state[alive[~on]] = -1
            alive, at = alive[on], at[on]
            state[alive] = self.targets[at]
            row[alive] += self.adds[at]
        known = state >= 0
        known[known] = self.final[state[known]] == 1
        return np.where(known, row, -1)

    def ids(self, row: int) -> bytes:
        return self.outputs[self.offsets[row] : self.offsets[row + 1]].tobytes()


class LexiconEncoder:
    """Words to ids: the transducer first, exact merges for the rest."""

    def __init__(self, tokenizer_path: str, lexicon_path: str | None):
        self.merges = merges(tokenizer_path)
        self.transducer = Transducer(lexicon_path) if lexicon_path else None
        self.memo: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.merges.words(t) if t else [] for t in texts]
        memo = self.memo
        new = set().union(*split).difference(memo)
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = set().union(*split)
        new = list(new)
        rows = self.transducer.rows([w.encode() for w in new]) if self.transducer and new else np.full(len(new), -1)
        for word, row in zip(new, rows.tolist()):
            memo[word] = self.transducer.ids(row) if row >= 0 else np.array(self.merges.ids(word), "<i4").tobytes()
        return [np.frombuffer(b"".join(map(memo.__getitem__, words)), "<i4") for words in split]


@lru_cache(maxsize=2)
def _lexicon_encoder(tokenizer_path: str, lexicon_file: str | None) -> LexiconEncoder:
    return LexiconEncoder(tokenizer_path, SparkFiles.get(lexicon_file) if lexicon_file else None)


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """``(word, n)`` over all documents; ``docs`` has ``text``.  Counts are summed up per batch before they shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = merges(path), Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in texts_of(batch):
                seen.update(own.words(text) if text else [])
                if len(seen) > FLUSH:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = LEXICON) -> DataFrame:
    """The words above the least count that at most ``most`` words reach.

    The threshold comes from a histogram of counts (exact below 1024, in 64 steps
    per doubling above), so only that histogram reaches the driver.
    """
    level = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.floor(F.log2("n") * 64) + 384)
    short = counts.where(F.octet_length("word") <= LONGEST).withColumn("level", level.cast("long"))
    held, cut = 0, None
    for row in sorted(short.groupBy("level").count().collect(), reverse=True):
        held += row["count"]
        if held > most:
            break
        cut = row["level"]
    return short.where(F.lit(False) if cut is None else F.col("level") >= cut).select("word")


def build_lexicon(docs: DataFrame, path: str, most: int = LEXICON) -> str:
    """Count, compile and send the lexicon of ``docs`` (column ``text``) to the executors; the name of its file."""
    spark = docs.sparkSession
    counts = pin(word_counts(docs, path), "bpe-words")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merges(path)
        for batch in batches:
            ids = [np.array(own.ids(w), "<i4").tobytes() for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["word", "ids"])

    chosen = frequent_words(counts, most).mapInArrow(encode, "word string, ids binary")
    rows = sorted((r["word"].encode(), bytes(r["ids"])) for r in chosen.toLocalIterator())
    arrays = compile_automaton([w for w, _ in rows])
    arrays["offsets"] = np.cumsum([0, *(len(x) for _, x in rows)]).astype(np.int64)
    arrays["outputs"] = np.frombuffer(b"".join(x for _, x in rows), np.uint8)
    return _send(spark, arrays)


def _send(spark: SparkSession, arrays: dict[str, np.ndarray]) -> str:
    """Write a lexicon file (bounded by ``most``) to the shared folder; Spark copies it to each executor, later ones too."""
    path = scratch_path(spark, "lexicon")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(file_of_arrays(arrays)))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """The ids and texts of a batch, about ``GROUP`` characters at a time."""
    held, size, first = [], 0, 0
    for k, text in enumerate(texts_of(batch)):
        held.append(text)
        size += len(text)
        if size >= GROUP or k == batch.num_rows - 1:
            yield batch.column(0).slice(first, len(held)), held
            first, held, size = k + 1, [], 0


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))


def encode(docs: DataFrame, path: str, lexicon: str | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``, the ids of each whole text as ``array<int>``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _lexicon_encoder(path, lexicon)
        for batch in batches:
            for numbers, texts in _groups(batch):
                yield pa.RecordBatch.from_arrays([numbers, _lists(own.encode(texts))], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, lexicon: str | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)``: ``decode`` of ``encode`` in one pass, so that ids do not return to a worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _lexicon_encoder(path, lexicon)
        for batch in batches:
            for numbers, texts in _groups(batch):
                found = own.encode(texts)
                decoded = pa.array(map(own.merges.text_of, found), pa.string())
                yield pa.RecordBatch.from_arrays([numbers, _lists(found), decoded], ["doc_id", "ids", "decoded"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, decoded)``: the text that the ids stand for, special tokens included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merges(path)
        for batch in batches:
            texts = pa.array([own.text_of(ids.values.to_numpy()) if ids.is_valid else None for ids in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
