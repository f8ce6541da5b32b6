"""Pipelines whose category stage is a distributed table: against Spark's indexer, saved, loaded and very wide."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from plumbline.functions import encoding
from plumbline.functions.stages import CategoryIndexer, CategoryIndexerModel

ROWS = [("a", 1, 2.0, 1.0), ("b", 1, 3.0, 2.0), ("b", 2, 5.0, 4.0), ("c", 2, 8.0, 3.0), ("c", 2, 1.0, 5.0), ("c", None, 1.5, 2.5), (None, 3, 2.5, 1.5)]
SCHEMA = "word string, number int, x double, label double"


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def test_indexes_equal_those_of_spark(rows):
    cols, outs = ["word", "number"], ["i", "j"]
    ours = CategoryIndexer(inputCols=cols, outputCols=outs, invalid="keep").fit(rows)
    theirs = StringIndexer(inputCols=cols, outputCols=outs, handleInvalid="keep").fit(rows)
    a, b = ([tuple(r) for r in m.transform(rows).select("x", *outs).orderBy("x", "i").collect()] for m in (ours, theirs))
    assert a == b and ours.sizes == {"word": 3, "number": 3}


def test_pipeline_equals_one_with_the_indexer_of_spark(rows):
    ours = encoding.feature_stages(["word"], ["x"], LinearRegression(regParam=0.1)).fit(rows)
    stages = [
        StringIndexer(inputCols=["word"], outputCols=["word_index"], handleInvalid="keep"),
        OneHotEncoder(inputCols=["word_index"], outputCols=["word_vector"]),
        VectorAssembler(inputCols=["word_vector", "x"], outputCol="features"),
        LinearRegression(regParam=0.1),
    ]
    theirs = Pipeline(stages=stages).fit(rows)
    a, b = ([r["prediction"] for r in m.transform(rows).orderBy("x").collect()] for m in (ours, theirs))
    assert a == pytest.approx(b)


def test_stage_and_pipeline_save_and_load(spark, rows, tmp_path):
    stage = CategoryIndexer(inputCols=["word"], outputCols=["i"], invalid="skip")
    stage.save(str(tmp_path / "stage"))
    again = CategoryIndexer.load(str(tmp_path / "stage"))
    assert again.getInvalid() == "skip" and again.getInputCols() == ["word"]
    model = again.fit(rows)
    model.save(str(tmp_path / "model"))
    with pytest.raises(Exception, match="exist"):
        model.save(str(tmp_path / "model"))
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = CategoryIndexerModel.load(str(tmp_path / "model"))
    assert loaded.uid == model.uid and loaded.sizes == {"word": 3}
    unseen = spark.createDataFrame([("zz",), ("b",), (None,)], "word string")
    assert [tuple(r) for r in loaded.transform(unseen).select("word", "i").collect()] == [("b", 1.0)]
    with pytest.raises(Exception, match="unknown category"):
        loaded.copy({loaded.invalid: "error"}).transform(unseen).collect()
    pipeline = encoding.feature_stages(["word", "number"], ["x"], LinearRegression(regParam=0.1)).fit(rows)
    pipeline.save(str(tmp_path / "pipeline"))
    same = PipelineModel.load(str(tmp_path / "pipeline"))
    a, b = ([tuple(r) for r in m.transform(rows).select("x", "prediction").orderBy("x").collect()] for m in (pipeline, same))
    assert a == b


def test_lengths_must_agree(rows):
    with pytest.raises(ValueError, match="differ"):
        CategoryIndexer(inputCols=["word"], outputCols=["i", "j"]).fit(rows)


def test_a_million_categories_fit_save_load_and_score(spark, tmp_path):
    n = 1_000_000
    df = spark.range(n, numPartitions=8).select(F.concat(F.lit("key-"), "id").alias("word"), (F.col("id") % 7).cast("double").alias("x"))
    model = encoding.feature_stages(["word"], ["x"]).fit(df)
    model.save(str(tmp_path / "wide"))
    loaded = PipelineModel.load(str(tmp_path / "wide"))
    # The saved model holds no list of labels: its metadata is small, its ranks are rows.
    assert loaded.stages[0].sizes == {"word": n}
    assert sum(len(r[0]) for r in spark.read.text(f"{tmp_path}/wide/stages/0_*/metadata").collect()) < 2000
    chosen = spark.createDataFrame([("key-5", 5.0), ("key-999999", 1.0), ("other", 2.0)], "word string, x double")
    scored = {r["word"]: r["features"] for r in loaded.transform(chosen).select("word", "features").collect()}
    assert {w: v.size for w, v in scored.items()} == dict.fromkeys(scored, n + 1)
    assert [int(scored[w].numNonzeros()) for w in ("key-5", "key-999999", "other")] == [2, 2, 1]
    index = loaded.stages[0].transform(df).agg(F.countDistinct("word_index"), F.max("word_index")).first()
    assert tuple(index) == (n, n - 1.0)
