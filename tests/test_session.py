import os

import pytest
from pyspark.errors import PySparkException

from plumbline.session import balance, checkpoint_folder, pin, release_pins, run_together
from plumbline.sources import tables


def test_pin_and_release(spark):
    pinned = pin(spark.range(10), "t")
    assert pinned.count() == 10
    assert checkpoint_folder(spark).split(":")[-1].lstrip("/") in pinned.inputFiles()[0]
    assert release_pins(spark)
    with pytest.raises(Exception):
        spark.read.parquet(os.path.dirname(pinned.inputFiles()[0])).count()


def test_pin_keeps_ml_metadata(spark):
    from plumbline.functions.encoding import index_strings

    df = index_strings(spark.createDataFrame([("a",), ("b",)], "s string"), ["s"], ["i"])
    assert pin(df).schema["i"].metadata == df.schema["i"].metadata


def test_balance_keeps_the_rows(spark):
    assert balance(spark.range(100).coalesce(1)).count() == 100


def test_run_together_keeps_the_order(spark):
    assert run_together(spark, lambda n: spark.range(n).count(), [3, 1, 2]) == [3, 1, 2]


def test_csv_save_fails_on_an_existing_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    tables.write_csv_table(df, path)
    assert sorted(r["id"] for r in tables.read_csv_table(spark, path).collect()) == [1, 2]
    with pytest.raises(PySparkException):
        tables.write_csv_table(df, path)
    tables.write_csv_table(df, path, mode="append")
    assert tables.read_csv_table(spark, f"{path}/*.csv").count() == 4


def test_interactions_from_json(spark, tmp_path):
    path = str(tmp_path / "j")
    spark.createDataFrame([("ann", 3, 2, 9)], "username string, indicatorId int, count int, extra int").write.json(path)
    assert tables.read_interactions(spark, path, "json").columns == ["username", "indicatorId", "count"]
