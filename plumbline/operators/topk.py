"""Previews, frequency ranks and recommendation lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import pin


def preview(df: DataFrame, n: int = 20, order_by: list | None = None) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` a stable top-n without a full sort."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def rank_counts(counts: DataFrame, group: str | None = None) -> DataFrame:
    """``(value, n)`` ordered by falling ``n``, then by value: ``(value, n, rank)`` from rank 1, or from 1 in each ``group``.

    Any number of values: they are range-sorted over all tasks, and a rank is
    the place in the task plus the size of the tasks before it, of which only
    the sizes per task (and group) visit the driver.
    """
    by = [group] if group else []
    # The upper 31 bits of the id number the task, the lower 33 the row in it.
    numbered = counts.orderBy(*by, F.desc("n"), F.asc("value")).withColumn("_id", F.monotonically_increasing_id())
    task, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    ordered = pin(numbered.select(*by, "value", "n", task.alias("_task"), row.alias("_row")), "rank")
    of = F.col(group) if group else F.lit(0)
    sizes = ordered.groupBy("_task", of.alias("_group")).agg(F.count("*").alias("size"), F.min("_row").alias("first")).collect()
    before: dict = {}
    starts = []
    for r in sorted(sizes, key=lambda r: (r["_task"], r["first"])):
        held = before.get(r["_group"], 0)
        starts.append((r["_task"], r["_group"], held - r["first"]))
        before[r["_group"]] = held + r["size"]
    offsets = counts.sparkSession.createDataFrame(starts, f"_task long, _group {'int' if not group else counts.schema[group].dataType.simpleString()}, _start long")
    return ordered.withColumn("_group", of).join(F.broadcast(offsets), ["_task", "_group"]).select(
        *by, "value", "n", (F.col("_start") + F.col("_row") + 1).alias("rank")
    )


def index_order_rank(df: DataFrame, col: str) -> DataFrame:
    """Values of a column as text, by frequency: the order behind category indexes."""
    values = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("value"))
    return rank_counts(values.groupBy("value").agg(F.count("*").alias("n")))


def explode_recommendations(recs: DataFrame, key: str, recommendations: str = "recommendations") -> DataFrame:
    """Recommendation arrays as rows ``(key, rank, <fields of the array>)`` from rank 1."""
    return recs.select(key, F.posexplode(recommendations).alias("_pos", "_rec")).select(
        key, (F.col("_pos") + 1).alias("rank"), "_rec.*"
    )
