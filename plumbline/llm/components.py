"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import pin


def _least(links: DataFrame) -> DataFrame:
    """The least neighbour of each ``a``."""
    return links.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the least node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("of", F.least("of", "least").alias("least"))
    return both.join(least, F.col("a") == F.col("of")).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node (``a > b`` in every link) and its smaller neighbours link to the least of them."""
    joined = links.join(_least(links), F.col("a") == F.col("of"))
    moved = joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(joined.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``a, b``, longs) but the roots: the least node reachable.

    Each round is a few joins over the links that are left, written to the shared
    folder; the driver sees one count and one checksum a round.
    """
    rows = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = pin(rows, name), None
    while True:
        # Exact sums of two halves: equal sums, hashes and counts mean that nothing moved.
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first())
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, now = state, pin(_small_star(_large_star(now)), name)
