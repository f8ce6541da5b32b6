"""Exact duplicates by two-pass Bloom filtering, in DataFrame operations only.

Texts are equal when identical after deleting ASCII white space.  Pass one sets
two bits per text in a Bloom filter kept as a relation and marks the bits that
were set more than once.  Pass two tests every row against the marked bits: a
row with an unmarked bit has no equal and passes straight through, only the
others shuffle by their digest.  The filter has sixteen bits a row, so that of the
single rows about one in seventy is taken for possibly repeated, at any number of rows.

The words of the filter (one row per 64 bits) are broadcast up to BROADCAST_BITS,
some 67 million rows.  Beyond, ``decide`` joins its narrow keys with them by word, and
``keep_one``, whose rows carry texts, stays at BROADCAST_BITS: more single rows then
shuffle with the groups.  The result is the same in every case.

Defined cases: a null text counts as empty, and all empty texts are equal; rows
that repeat a ``doc_id`` are separate rows of their group; of equal longest texts
the smallest ``doc_id`` stays (a null id counts as largest), of such rows of one id
the one whose original text has the smallest hash, and of identical rows any: exactly
one row of a group stays.  An empty table gives an empty result.  Columns other than id and text never take part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import pin

#: Bits of a filter whose size is not given: at most FILTER_BITS / 64 rows (16 bytes each) are broadcast.
FILTER_BITS = 1 << 26
BITS_PER_ROW = 16
#: Bits of the largest filter that is broadcast: 2^24 words of 16 bytes.
BROADCAST_BITS = 1 << 30
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def squeezed(text: Column) -> Column:
    """The text without ASCII white space, null as empty."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE, F.coalesce(text, F.lit("")))


def text_digest(text: Column) -> Column:
    return F.sha2(squeezed(text).cast("binary"), 256)


def _bit(digest: Column, which: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(which)), F.lit(bits))


def filter_bits(rows: int) -> int:
    """The bits of a filter for ``rows`` rows: a power of two, at least sixteen a row."""
    return 1 << max(16, (BITS_PER_ROW * rows - 1).bit_length())


def marked_bits(digests: DataFrame, column: str, bits: int = FILTER_BITS, least: int = 2) -> DataFrame:
    """Pass one: the bits that ``least`` or more rows set, as 64-bit words ``(word, marks)``."""
    slots = digests.select(F.explode(F.array(_bit(F.col(column), 0, bits), _bit(F.col(column), 1, bits))).alias("slot"))
    twice = slots.groupBy("slot").count().where(F.col("count") >= least)
    mark = F.expr("shiftleft(1L, cast(slot & 63 AS int))")
    return twice.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(mark).alias("marks"))


def possibly_repeated(rows: DataFrame, column: str, marks: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Pass two: ``rows`` with ``__maybe``, false only where the digest is certainly single.

    ``marks`` has at most ``bits / 64`` rows, which bounds the broadcast; beyond
    BROADCAST_BITS the rows are joined with them by word.
    """
    out = rows
    for which in (0, 1):
        own = marks.select(F.col("word").alias("__word"), F.col("marks").alias("__marks"))
        slot = _bit(F.col(column), which, bits)
        own = F.broadcast(own) if bits <= BROADCAST_BITS else own
        out = out.join(own, F.shiftright(slot, 6) == F.col("__word"), "left")
        test = f"coalesce(shiftright(__marks, cast(pmod(xxhash64(`{column}`, {which}), {bits}) & 63 AS int)) & 1L, 0L) = 1L"
        out = out.withColumn(f"__hit{which}", F.expr(test)).drop("__word", "__marks")
    return out.withColumn("__maybe", F.col("__hit0") & F.col("__hit1")).drop("__hit0", "__hit1")


def _best() -> Column:
    """Of a group: the most code points, then the smallest id (null last), then the smallest hash of the original text."""
    ties = [F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__tie").alias("tie")]
    return F.min(F.struct((-F.col("__chars")).alias("less"), *ties, F.col("__nth").alias("nth")))


def _keys(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.col(id_col).alias("__id"), F.char_length(text).cast("long").alias("__chars"), F.xxhash64(text).alias("__tie"), text_digest(text).alias("__sha")]


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``bits`` of the filter follow the number of rows unless they are given.
    """
    # The number of a row is written with it, and so the same in every later scan.
    keys = pin(docs.select(*_keys(id_col, text_col), F.monotonically_increasing_id().alias("__nth")), "exact-keys")
    bits = bits or filter_bits(keys.count())
    tested = possibly_repeated(keys, "__sha", pin(marked_bits(keys, "__sha", bits), "exact-bits"), bits)
    maybe = tested.where("__maybe")
    # Written, so that the join has an exchange of its own, whose hot groups adaptive execution can split.
    groups = pin(maybe.groupBy("__sha").agg(_best().alias("__best"), F.count(F.lit(1)).alias("__size")), "exact-groups")
    grouped = maybe.join(groups.withColumnRenamed("__sha", "__group"), F.col("__sha") == F.col("__group"))
    kept = F.col("__nth") == F.col("__best.nth")
    together = grouped.select("__id", F.col("__best.id").alias("keep_id"), F.col("__size").alias("group_size"), kept.alias("kept"), "__sha")
    single = tested.where("NOT __maybe").select(
        "__id", F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "__sha"
    )
    return single.unionByName(together).withColumnsRenamed({"__id": "doc_id", "__sha": "text_sha256"})


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: exactly one of each group of equal texts.

    Rows that are certainly single never shuffle.  The row that stays is the one
    ``decide`` marks; of identical rows one stays.
    """
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), *_keys(id_col, text_col))
    keys = pin(keyed.drop("__row").withColumn("__nth", F.lit(0)), "exact-keys")
    bits = bits or min(filter_bits(keys.count()), BROADCAST_BITS)
    marks = pin(marked_bits(keys, "__sha", bits), "exact-bits")
    groups = possibly_repeated(keys, "__sha", marks, bits).where("__maybe").groupBy("__sha").agg(_best().alias("__best"))
    winners = groups.select(F.col("__sha").alias("__group"), F.col("__best.id").alias("__keep"), F.col("__best.tie").alias("__kept_tie"))
    tested = possibly_repeated(keyed, "__sha", marks, bits)
    of_groups = (
        tested.where("__maybe")
        .join(winners, (F.col("__sha") == F.col("__group")) & F.col("__id").eqNullSafe(F.col("__keep")) & (F.col("__tie") == F.col("__kept_tie")))
        .dropDuplicates(["__sha"])
    )
    both = tested.where("NOT __maybe").select("__row").unionByName(of_groups.select("__row"))
    return both.select(*[F.col("__row").getField(c).alias(c) for c in names])
