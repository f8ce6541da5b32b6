"""Mergeable moments against Spark's own aggregates, for any nulls, odd numbers and partitions."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.operators import aggregates, merging, moments
from plumbline.plans import tabular

NUMBER = st.one_of(st.none(), st.floats(-1e3, 1e3), st.just(5.0))


def arrays(rows):
    there = np.array([[v is not None for v in row] for row in rows], bool).reshape(len(rows), -1)
    return np.array([[v or 0.0 for v in row] for row in rows], float).reshape(len(rows), -1), there


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(NUMBER, NUMBER, NUMBER), min_size=2, max_size=14), st.integers(1, 13))
def test_merged_parts_equal_the_whole(rows, cut):
    cut = min(cut, len(rows) - 1)
    x, there = arrays(rows)
    one = moments._pair_state(x, x, there, there)
    parts = [moments._pair_state(x[p], x[p], there[p], there[p]) for p in (slice(0, cut), slice(cut, None))]
    two = moments._merge_pairs(*parts)
    shared = one[moments.ROWS] > 0
    for place in range(7):
        assert np.allclose(one[place][shared], two[place][shared], rtol=1e-9, atol=1e-6)
    for i in range(3):
        for j in range(3):
            both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            assert one[moments.ROWS, i, j] == len(both)
            if both:
                a, b = np.array(both).T
                assert two[moments.PRODUCTS, i, j] == pytest.approx(((a - a.mean()) * (b - b.mean())).sum(), abs=1e-6)


ROWS = [(1.0, 2.0, None, 7.0), (2.0, None, 3.0, 7.0), (3.0, 6.5, None, 7.0), (4.0, 7.0, 9.0, None), (5.0, None, 1.0, 7.0), (9.5, -2.0, 4.0, 7.0)]
SCHEMA = "a double, b double, c double, same double"


def test_correlations_equal_spark_pair_by_pair(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    got = {(r["column"], r["other"]): r["correlation"] for r in aggregates.correlation_matrix(df).collect()}
    assert len(got) == 16
    for a in "abc":
        for b in "abc":
            both = df.dropna(subset=[a, b])
            assert got[a, b] == pytest.approx(both.corr(a, b) if a != b else 1.0)
    # A column that does not vary has no correlation, not a chance one.
    assert got["same", "a"] is None and got["same", "same"] is None
    by_label = dict(map(tuple, aggregates.label_correlations(df, "a").collect()))
    assert by_label == pytest.approx({c: got[c, "a"] for c in ["a", "b", "c", "same"]})


def test_description_equals_spark(spark):
    df = spark.createDataFrame([*ROWS, (None, None, None, None)], SCHEMA).repartition(3)
    got = {(r["column"], r["stat"]): r["value"] for r in aggregates.describe_long(df).collect()}
    for row in df.describe().collect():
        for c in df.columns:
            assert got[c, row["summary"]] == pytest.approx(float(row[c]))


def test_means_far_from_zero_keep_their_digits(spark):
    df = spark.range(1000).select((F.col("id") % 7 + 1e9).alias("x"), (F.col("id") % 7 * 2 - 1e9).alias("y")).repartition(5)
    assert aggregates.label_correlations(df, "y", ["x"]).first()["correlation"] == pytest.approx(1.0, abs=1e-12)


def test_odd_numbers_spoil_only_their_pairs(spark):
    rows = [(1.0, float("nan"), 3.0, None), (2.0, 1.0, 5.0, 1.0), (4.0, 2.0, 1.0, None), (5.0, 2.5, 0.0, float("inf")), (7.0, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, nan double, c double, inf double")
    got = {(r["column"], r["other"]): r["correlation"] for r in aggregates.correlation_matrix(df).collect()}
    assert got["a", "c"] == pytest.approx(df.corr("a", "c")) and math.isnan(got["a", "nan"]) and math.isnan(got["inf", "c"])
    stats = {(r["column"], r["stat"]): r["value"] for r in aggregates.describe_long(df).collect()}
    assert math.isnan(stats["nan", "mean"]) and math.isnan(stats["nan", "max"]) and stats["nan", "min"] == 1.0
    assert stats["inf", "mean"] == stats["inf", "max"] == float("inf") and stats["inf", "count"] == 3


def test_columns_of_several_blocks_and_empty_tables(spark, monkeypatch):
    df = spark.range(50).select(*[F.sin(F.col("id") * (k + 1)).alias(f"x.{k}") for k in range(7)])
    whole = sorted(map(tuple, aggregates.correlation_matrix(df).collect()))
    monkeypatch.setattr(moments, "BLOCK", 3)
    monkeypatch.setattr(merging, "FAN_IN", 2)
    parts = sorted(map(tuple, aggregates.correlation_matrix(df.repartition(6)).collect()))
    assert [r[:2] for r in whole] == [r[:2] for r in parts] and len(parts) == 49
    assert [r[2] for r in whole] == pytest.approx([r[2] for r in parts])
    assert aggregates.correlation_matrix(df.where("false")).collect() == []
    assert moments.table_moments(df, df.columns).weaker_than("x.0", 0.9, df.columns[1:]) == df.columns[1:]


def test_screening_reads_the_table_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([*ROWS, (8.0, 1.0, 4.0, 7.0)], SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    report = tabular.screen_features(df, "a", threshold=0.05)
    # Every part of the report is read from merged states, not from the files.
    for part in (report.description, report.correlations, report.matrix):
        assert "FileScan" not in part._jdf.queryExecution().executedPlan().toString()
    assert "a" in report.kept and "same" not in report.kept
    assert {r["column"] for r in report.matrix.collect()} == set(report.kept)
    assert {r["column"] for r in report.correlations.collect()} == {"a", "b", "c", "same"}
