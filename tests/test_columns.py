import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions.categories import category_group, group_category, register_category_udf
from plumbline.operators import columns


def values(df, col):
    return [r[col] for r in df.collect()]


def test_first_element_of_empty_array_is_null(spark):
    df = spark.createDataFrame([(1, []), (2, ["a b c"])], "id int, arr array<string>")
    assert values(columns.first_element(df, "arr", "first").orderBy("id"), "first") == [None, "a b c"]


def test_ratio_is_null_for_zero_and_null_divisor(spark):
    df = spark.createDataFrame([(1, 6, 3), (2, 5, 0), (3, 5, None)], "id int, num int, den int")
    assert values(columns.ratio_column(df, "num", "den", "r").orderBy("id"), "r") == [2.0, None, None]


def test_null_to_zero_keeps_the_type(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", 4)], "id int, s string, n int")
    out = columns.null_to_zero(df, ["s", "n"]).orderBy("id")
    assert values(out, "s_cleaned") == ["0", "x"]
    assert values(out, "n_cleaned") == [0, 4]
    assert dict(out.dtypes)["s_cleaned"] == "string"
    in_place = columns.null_to_zero(df, ["n"], suffix="").orderBy("id")
    assert in_place.columns == ["id", "s", "n"] and values(in_place, "n") == [0, 4]


def test_threshold_label_puts_null_on_the_other_side(spark):
    df = spark.createDataFrame([(1, 2), (2, 0), (3, None)], "id int, n int")
    assert values(columns.threshold_label(df, "n", ">", 0, 0, 1).orderBy("id"), "label") == [0, 1, 1]
    assert values(columns.threshold_label(df, "n", ">=", 1).orderBy("id"), "label") == [1, 0, 0]


def test_filter_expr_drops_null(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_cancelled boolean")
    assert values(columns.filter_expr(df, "is_cancelled = false"), "id") == [2]


def test_require_columns(spark):
    df = spark.createDataFrame([(1, "number", "a"), (2, None, "a"), (3, "number", None), (4, "percent", "a")], "id int, unit string, s string")
    assert values(columns.require_columns(df, ["unit", "s"], {"unit": "number"}), "id") == [1]


CODES = [("GB", "GB"), ("EL", "EUROPE"), ("GR", "OTHER"), (None, "OTHER"), ("xx", "OTHER"), ("US", "US"), ("EU", "EUROPE")]


def test_country_groups(spark):
    df = spark.createDataFrame([(c,) for c, _ in CODES], "country string")
    out = group_category(df, "country", out="grouped").collect()
    assert [(r["country"], r["grouped"]) for r in out] == CODES


def test_registered_udf_equals_expression(spark):
    register_category_udf(spark, "country_grouping")
    df = spark.createDataFrame([(c,) for c, _ in CODES], "country string")
    out = df.select(F.expr("country_grouping(country)").alias("u"), category_group("country").alias("e")).collect()
    assert all(r["u"] == r["e"] for r in out)


def test_basename_and_drop(spark):
    df = spark.createDataFrame([("file:/a/b/c.png", 1)], "p string, x int")
    assert values(columns.file_basename(df, "p"), "name") == ["c.png"]
    assert columns.drop_columns(df, ["x", "nothing"]).columns == ["p"]


def test_matching_predictions_compares_integers(spark):
    df = spark.createDataFrame([(1.0, 1.9), (1.0, 2.0)], "label double, prediction double")
    assert columns.matching_predictions(df).count() == 1


def test_unknown_comparison_fails(spark):
    with pytest.raises(KeyError):
        columns.threshold_label(spark.createDataFrame(pd.DataFrame({"n": [1]})), "n", "~", 1)
