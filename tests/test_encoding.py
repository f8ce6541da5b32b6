from collections import Counter

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.functions import encoding
from plumbline.operators import joins, topk


@pytest.fixture
def letters(spark):
    return spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")


def test_index_order_and_skip(letters):
    out = encoding.drop_invalid_categories(letters, ["s"], ["i"])
    assert {(r["s"], r["i"]) for r in out.collect()} == {("c", 0.0), ("a", 1.0), ("b", 2.0)}


def test_null_modes(letters):
    keep = encoding.index_strings(letters, ["s"], ["i"], invalid="keep")
    assert {(r["s"], r["i"]) for r in keep.collect()} == {("c", 0.0), ("a", 1.0), ("b", 2.0), (None, 3.0)}
    skip = encoding.index_strings(letters, ["s"], ["i"], invalid="skip")
    assert skip.count() == 4
    with pytest.raises((PySparkException, Py4JJavaError)):
        encoding.index_strings(letters, ["s"], ["i"]).collect()


def test_index_equals_spark_indexer(spark):
    rows = [(i, f"k{i * i % 37}", i % 7) for i in range(500)] + [(1000 + i, "hot", 3) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, s string, n int").repartition(5)
    expected = StringIndexer(inputCols=["s", "n"], outputCols=["si", "ni"]).fit(df).transform(df)
    found = encoding.index_strings(df, ["s", "n"], ["si", "ni"])
    pick = lambda d: sorted(tuple(r) for r in d.select("id", "si", "ni").collect())
    assert pick(found) == pick(expected)


@pytest.mark.parametrize("values", [3, 120_000])
def test_metadata_does_not_depend_on_the_number_of_values(spark, values):
    df = spark.range(values).select(F.concat(F.lit("v"), F.col("id")).alias("s"))
    out = encoding.index_strings(df, ["s"], ["i"])
    assert out.schema["i"].metadata == {"ml_attr": {"type": "nominal", "num_vals": values}}
    assert out.agg(F.countDistinct("i"), F.max("i")).first() == (values, values - 1.0)


def test_encoded_categories_leave_out_the_rarest_and_the_unknown(spark):
    train = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "x"), ("c", "x")], "s string, one string")
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("new", "y"), (None, None)], "s string, one string")
    out, names = encoding.encode_categories(train, df, ["s", "one"], ["sv", "ov"])
    assert names == ["sv"] and out.columns == ["s", "one", "sv"]
    found = {r["s"]: r["v"] for r in out.select("s", vector_to_array("sv").alias("v")).collect()}
    assert found == {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [0.0, 0.0], "new": [0.0, 0.0], None: [0.0, 0.0]}


def test_hashed_index_stays_below_its_buckets(spark):
    out = encoding.hashed_index(spark.range(500).withColumn("s", F.col("id").cast("string")), ["s"], ["i"], 16)
    assert out.agg(F.countDistinct("i"), F.min("i"), F.max("i")).first() == (16, 0.0, 15.0)


def test_one_hot_drops_the_last_category(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",)], "s string")
    df = encoding.one_hot(encoding.index_strings(df, ["s"], ["i"]), ["i"], ["v"])
    out = {r["s"]: r["v"] for r in df.select("s", vector_to_array("v").alias("v")).collect()}
    assert out == {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [0.0, 0.0]}


def test_assemble_null_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises((PySparkException, Py4JJavaError)):
        encoding.assemble(df, ["a", "b"]).collect()
    assert encoding.assemble(df, ["a", "b"], invalid="skip").count() == 1


def test_rank_equals_counter(spark):
    values = [f"v{i % 13}" for i in range(100)] + ["x"] * 7 + [f"once{i}" for i in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(6)
    ranked = topk.index_order_rank(df, "v").orderBy("rank").collect()
    expected = sorted(Counter(values).items(), key=lambda p: (-p[1], p[0]))
    assert [(r["value"], r["n"], r["rank"]) for r in ranked] == [(v, n, i + 1) for i, (v, n) in enumerate(expected)]


def test_lookup_join_with_a_hot_key(spark):
    """A third of the rows share one key, and many of them are copies."""
    rows = [(i % 50, i) for i in range(2000)] + [(7, 1)] * 1500
    big = spark.createDataFrame(rows, "k int, x int").repartition(16)
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(40)], "k int, name string")
    expected = Counter((k, x, f"n{k}") for k, x in rows if k < 40)
    inner = joins.lookup_join(big, lookup, "k").select("k", "x", "name").collect()
    assert Counter(tuple(r) for r in inner) == expected
    left = joins.lookup_join(big, lookup, "k", how="left").select("k", "x", "name").collect()
    assert Counter(tuple(r) for r in left if r["name"]) == expected and len(left) == len(rows)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


def per_task(spark, df, only=None):
    """Rows (of one key, if given) that each task of a plan gives, under small limits for skewed partitions."""
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    try:
        rows = df.withColumn("_task", F.spark_partition_id()).collect()
    finally:
        for key in SKEW:
            spark.conf.unset(key)
    return Counter(r["_task"] for r in rows if only is None or r["k"] == only)


def test_a_hot_key_is_spread(spark):
    """A third of the rows, from many tasks.  What one task sends to one key is as small as that task's input."""
    big = spark.range(40_000).select((F.col("id") % 50 * (F.col("id") % 3 > 0).cast("int")).alias("k"), "id").repartition(8, "id")
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(50)], "k long, name string")
    tasks = per_task(spark, joins.lookup_join(big, lookup, "k"))
    assert sum(tasks.values()) == 40_000 and max(tasks.values()) < 14_000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_in_one_input_task_is_spread(spark, how):
    """All rows of the hot key, a third of the table, come from one input task."""
    hot = F.col("id") < 66_666
    big = spark.range(0, 200_000, 1, 3).select(F.when(hot, 0).otherwise(F.col("id") % 49 + 1).alias("k"), "id")
    assert big.where("k = 0").select(F.spark_partition_id()).distinct().count() == 1
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(50)], "k long, name string")
    tasks = per_task(spark, joins.lookup_join(big, lookup, "k", how, by_key=True), only=0)
    assert sum(tasks.values()) == 66_666 and len(tasks) >= 3 and max(tasks.values()) < 33_333


def test_rows_without_a_key_are_spread(spark):
    big = spark.range(20_000).select(F.lit(None).cast("long").alias("k"), "id").repartition(4)
    lookup = spark.createDataFrame([(1, "one")], "k long, name string")
    left = joins.lookup_join(big, lookup, "k", how="left")
    tasks = per_task(spark, left)
    assert sum(tasks.values()) == 20_000 and max(tasks.values()) < 8_000
    assert left.where("name IS NULL").count() == 20_000 and left.columns == ["k", "id", "name"]
    assert joins.lookup_join(big, lookup, "k").count() == 0


def test_feature_stages_score_unseen_categories(spark):
    from pyspark.ml.regression import LinearRegression

    train = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, 2.0), ("a", 3.0, 3.0)], "c string, x double, label double")
    model = encoding.feature_stages(["c"], ["x"], LinearRegression()).fit(train)
    assert model.transform(spark.createDataFrame([("new", 5.0)], "c string, x double")).count() == 1
