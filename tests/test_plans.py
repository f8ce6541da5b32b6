"""The plans are the ones we want: pruned scans, few shuffles, no Python in the way."""

import pytest
from pyspark.sql import functions as F

from plumbline.catalog import QUERIES
from plumbline.catalog import inputs as src
from plumbline.operators import aggregates, columns
from plumbline.session import pin


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    df = columns.filter_expr(src.table(spark, sf_dir, "orders"), "o_orderstatus = 'F'").select("o_orderkey")
    text = plan(df)
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_pinned_features_are_pruned_and_filtered_at_the_scan(spark):
    frame = pin(spark.range(10).select((F.col("id") < 5).alias("is_training"), "id", (F.col("id") * 2).alias("x")))
    text = plan(frame.where("is_training").select("x"))
    assert "EqualTo(is_training,true)" in text and "id:" not in text.split("ReadSchema")[1]


def test_correlations_take_one_scan_and_shuffle_states_alone(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem")
    text = plan(aggregates.correlation_matrix(df, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
    # No row is multiplied by columns or pairs; what is shuffled are the merged states of tasks.
    assert text.count("FileScan") == 1 and "Generate" not in text
    assert text.count("Exchange hashpartitioning") == 2 and text.index("FlatMapGroupsInArrow") < text.index("Exchange") < text.index("FileScan")


@pytest.mark.parametrize("name", ["group_categories", "leading_ngram", "read_pixel_lines", "null_to_zero"])
def test_expressions_stay_out_of_python(spark, sf_dir, name):
    text = plan(QUERIES[name].run(spark, sf_dir))
    assert "EvalPython" not in text and "UDF" not in text


@pytest.mark.parametrize("name", ["group_categories", "index_strings", "lookup_join", "attach_user_names", "scale_column"])
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name].run(spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_image_pass_runs_once_per_image(spark, sf_dir):
    assert plan(QUERIES["image_pixels"].run(spark, sf_dir)).count("ArrowEvalPython") == 1


def test_pivot_combines_before_it_shuffles(spark, sf_dir):
    text = plan(QUERIES["interaction_totals"].run(spark, sf_dir))
    assert "partial_sum" in text and text.count("Exchange hashpartitioning") == 1
