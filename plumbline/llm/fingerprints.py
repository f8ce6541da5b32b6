"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame operations only.

A text is the set of digests of its paragraphs.  A sketch adds each digest to one
cell in each of three tables: the cell keeps a count, the exclusive or of its
digests and of their check hashes.  Sketches of two versions subtract cell by
cell, which cancels all paragraphs they share.  A cell left with one digest gives
it up; it is taken out of its other two cells, which may leave one there, and so
on, one table after the other, until the differing digests are recovered.  Pairs
that do not peel to nothing are tried again with larger tables and other hashes.

A paragraph is a line; a line is cut at the first space after its first 32
characters, and then after every 96.  The fingerprint is the sketch of a fixed
small size, in hexadecimal; likeness is the shared part of all paragraph digests of
two texts (Jaccard), as the recovered digests tell.

Defined cases: a null text counts as empty; texts without any character but line
ends have no paragraph, and two such texts are alike (1); a paragraph that repeats
counts once; rows that repeat an id follow each other by a hash of the text; a null
id comes last; a single row is its own next; an empty table gives an empty result;
columns other than id and text never take part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import id_and_text, shuffle_partitions
from plumbline.session import pin, scratch_path

PARAGRAPH = r"(?m)^[^\n]{1,32}[^\n ]*+|[^\n]{1,96}[^\n ]*+"
FIXED = 4  # cells per table of the fingerprint itself
ROUNDS = 15  # tables that are peeled one after the other in an attempt
ATTEMPTS = 6  # sizes tried; each doubles the last
SAMPLED = 10  # rows sampled for each group of consecutive rows, to cut the groups evenly


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), 0), lambda p: F.xxhash64(p)))


def sketch_text(digests: Column) -> Column:
    """The sketch of fixed size: count and exclusive or of each of three tables' cells, in hexadecimal."""

    def cell(t: int, c: int) -> list[Column]:
        own = F.filter(digests, lambda d: F.pmod(F.shiftright(d, 20 * t), F.lit(FIXED)) == c)
        mixed = F.aggregate(own, F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(d))
        return [F.lpad(F.hex(F.size(own)), 8, "0"), F.lpad(F.hex(mixed), 16, "0")]

    return F.lower(F.concat(*[x for t in range(3) for c in range(FIXED) for x in cell(t, c)]))


def _group(key: Column, tie: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted ``bounds`` are at most ``(key, tie)``, by bisection."""
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    if not steps:
        return F.lit(0)
    keys, ties = (F.split(F.lit(",".join(str(b[k]) for b in bounds)), ",").cast("array<bigint>") for k in range(2))

    def further(at: Column, step: Column) -> Column:
        place = at + step - 1  # past the end there is null, which is no bound
        return at + F.when((F.get(keys, place) < key) | ((F.get(keys, place) == key) & (F.get(ties, place) <= tie)), step).otherwise(0)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def _next_texts(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id, text``) with the text that follows by descending id (after the last, the first).

    Rows are cut into groups of consecutive rows at keys (id, then hash of the text) of
    sampled rows, so that groups are even however ids are spaced, tied or null; only rows
    that are equal in both stay together.  The first row of a group goes to the group
    before as well, as the one that follows its last; so texts are dealt out once.
    """
    lowest = -(1 << 63)
    keyed = rows.withColumn("key", F.bitwise_not(F.coalesce("doc_id", F.lit(lowest)))).withColumn("tie", F.xxhash64("text"))
    real = keyed.agg(F.min(F.struct("key", "tie")).alias("first"), F.count(F.lit(1)).alias("n")).first()
    if not real["n"]:
        return rows.select("doc_id", "text", F.lit(0).alias("part"), F.lit(0).cast("long").alias("row"), F.col("text").alias("next_text")).limit(0)
    n_groups = min(real["n"], 4 * shuffle_partitions(rows.sparkSession))
    # SAMPLED rows of two numbers for each group reach the driver.
    share = SAMPLED * n_groups / real["n"]
    sampled = sorted(tuple(r) for r in (keyed.sample(share, 1) if share < 1 else keyed).select("key", "tie").collect())
    first = tuple(real["first"])
    bounds = sorted({sampled[len(sampled) * k // n_groups] for k in range(1, n_groups) if sampled} - {first})
    n_groups = len(bounds) + 1
    numbered = keyed.withColumn("own", _group(F.col("key"), F.col("tie"), bounds))
    # A bound is the key of a row, so it is the first key of its group.
    tops = [F.split(F.lit(",".join(str(b[k]) for b in [first, *bounds])), ",").cast("array<bigint>") for k in range(2)]
    is_top = (F.get(tops[0], F.col("own")) == F.col("key")) & (F.get(tops[1], F.col("own")) == F.col("tie"))
    own, before = F.struct(F.col("own").alias("part"), F.lit(0).alias("guest")), F.pmod(F.col("own") - 1, F.lit(n_groups))
    places = F.when(is_top, F.array(own, F.struct(before.alias("part"), F.lit(1).alias("guest")))).otherwise(F.array(own))
    placed = numbered.select("doc_id", "text", "key", "tie", F.explode(places).alias("p"))
    order = Window.partitionBy("part").orderBy("guest", "key", "tie")
    led = placed.select("doc_id", "text", "key", "tie", "p.part", "p.guest").select(
        "doc_id", "text", "part", "guest", F.row_number().over(order).cast("long").alias("row"), F.lead("text").over(order).alias("next_text")
    )
    return led.where("guest = 0").drop("guest")


def with_edit(rows: DataFrame) -> DataFrame:
    """Each text with its next and its edited text: the last half of its code points replaced by the first as many of the next."""
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    return _next_texts(rows).withColumn("edited", F.concat(F.left("text", n - half), F.left("next_text", half)))


def _check(digest: Column, salt: int) -> Column:
    return F.xxhash64(digest, F.lit(salt))


def _cell(digest: Column, table: int, width: Column, salt: int) -> Column:
    return (F.pmod(F.xxhash64(digest, F.lit(salt + 1 + table)), width) + F.lit(table) * width).cast("long")


def _summed(rows: DataFrame) -> DataFrame:
    """Cells with the same place added up; those that cancel go."""
    cells = rows.groupBy("part", "row", "pair", "width", "cell").agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check"))
    return cells.where("n != 0 OR digest != 0 OR `check` != 0")


def differing(pairs: DataFrame, attempt: int) -> DataFrame:
    """``(part, row, pair, differ, left)``: recovered digests and cells that did not peel, of pairs that differ.

    ``pairs`` has ``part, row, pair, ours, theirs`` (arrays of distinct digests); all
    rows of a ``part`` lie in one partition, so cells are summed without a shuffle.
    """
    salt = 16 * attempt
    size = F.size("ours") + F.size("theirs")
    width = (F.ceil(size * (0.54 * 2**attempt)) + 4).cast("long")
    each = pairs.select("part", "row", "pair", width.alias("width"), F.size("ours").alias("mine"), F.posexplode(F.concat("ours", "theirs")).alias("k", "digest"))
    signed = each.withColumn("n", F.when(F.col("k") < F.col("mine"), 1).otherwise(-1).cast("long")).withColumn("check", _check(F.col("digest"), salt))
    placed = F.explode(F.array(*[_cell(F.col("digest"), t, F.col("width"), salt) for t in range(3)]))
    cells = _summed(signed.select("part", "row", "pair", "width", placed.alias("cell"), "n", "digest", "check"))
    for turn in range(ROUNDS):
        t = turn % 3
        alone = (F.abs("n") == 1) & (F.col("check") == _check(F.col("digest"), salt)) & (F.col("cell") >= F.lit(t) * F.col("width")) & (F.col("cell") < F.lit(t + 1) * F.col("width"))
        others = [
            F.struct(_cell(F.col("digest"), o, F.col("width"), salt).alias("cell"), (-F.col("n")).alias("n"), "digest", "check") for o in range(3) if o != t
        ]
        zero = F.lit(0).cast("long")
        found = F.struct(F.lit(-1).cast("long").alias("cell"), F.lit(1).cast("long").alias("n"), zero.alias("digest"), zero.alias("check"))
        as_is = F.array(F.struct("cell", "n", "digest", "check"))
        step = cells.select("part", "row", "pair", "width", F.explode(F.when(alone, F.array(*others, found)).otherwise(as_is)).alias("c"))
        cells = _summed(step.select("part", "row", "pair", "width", "c.cell", "c.n", "c.digest", "c.check"))
    is_found = F.col("cell") == -1
    return cells.groupBy("part", "row", "pair").agg(
        F.sum(F.when(is_found, F.col("n")).otherwise(0)).alias("differ"), F.sum(F.when(is_found, 0).otherwise(1)).alias("left")
    )


def _bucketed(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` written once, bucketed as they already lie, so that later passes need no shuffle."""
    spark, name = rows.sparkSession, f"plumbline_sketches_{uuid.uuid4().hex}"
    rows.write.bucketBy(shuffle_partitions(spark), column).option("path", scratch_path(spark, "sketches")).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    edited = with_edit(id_and_text(docs, id_col, text_col))
    ours, theirs, following = (paragraph_digests(F.col(c)) for c in ("text", "edited", "next_text"))
    made = edited.select(
        "part", "row", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        ours.alias("ours"), theirs.alias("of_edited"), following.alias("of_next"),
    )
    written = _bucketed(made.withColumn("fingerprint", sketch_text(F.col("ours"))).withColumn("edited_fingerprint", sketch_text(F.col("of_edited"))), "part")
    both = F.array(F.struct(F.lit(0).alias("pair"), F.col("of_edited").alias("theirs")), F.struct(F.lit(1).alias("pair"), F.col("of_next").alias("theirs")))
    pairs = written.select("part", "row", "ours", F.explode(both).alias("p")).select("part", "row", "p.pair", "ours", "p.theirs")
    done = pin(differing(pairs, 0), "sketch-differences")
    results = done.where("left = 0")
    for attempt in range(1, ATTEMPTS):
        failed = done.where("left > 0").select("part", "row", "pair")
        if failed.isEmpty():
            break
        done = pin(differing(pairs.join(failed.hint("shuffle_hash"), ["part", "row", "pair"]), attempt), "sketch-differences")
        results = results.unionByName(done.where("left = 0"))
    else:  # what is still tangled after the last size counts by the digests its cells hold at least
        results = results.unionByName(done.where("left > 0").withColumn("differ", F.col("differ") + F.ceil(F.col("left") / 3)))
    by_row = results.groupBy(F.col("part").alias("of_part"), F.col("row").alias("of_row")).agg(
        F.sum(F.when(F.col("pair") == 0, F.col("differ"))).alias("d0"), F.sum(F.when(F.col("pair") == 1, F.col("differ"))).alias("d1")
    )
    joined = written.join(pin(by_row, "sketch-rows").hint("shuffle_hash"), (F.col("part") == F.col("of_part")) & (F.col("row") == F.col("of_row")), "left")

    def likeness(theirs: str, differ: str) -> Column:
        total, d = F.size("ours") + F.size(theirs), F.coalesce(differ, F.lit(0))
        return F.when(total == 0, 1.0).otherwise((total - d) / (total + d))

    return joined.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness("of_edited", "d0").alias("near_edited"), likeness("of_next", "d1").alias("near_next")
    )
