"""The programs on small made tables with their usual columns."""

import random

import pytest

from plumbline.plans import programs
from plumbline.sources.tables import write_csv_table


@pytest.fixture(scope="module")
def houses(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        living = rng.randrange(500, 4000)
        grade = rng.randrange(5, 10)
        rows.append(
            (i, "2014-05-02", 100.0 * living + 20000 * grade, rng.randrange(1, 6), rng.randrange(1, 8) / 2, living,
             rng.randrange(900, 9000), rng.randrange(1, 4) / 2, i % 2, i % 3, rng.randrange(1, 6), grade,
             living - rng.randrange(0, 300), 1950 + i % 60, 0, 98000 + i % 7, 47.5, -122.2, rng.randrange(900, 9000))
        )
    names = (
        "id date price bedrooms bathrooms sqft_living sqft_lot floors waterfront view condition grade sqft_above "
        "yr_built yr_renovated zipcode lat long sqft_lot15"
    ).split()
    path = str(tmp_path_factory.mktemp("houses") / "csv")
    write_csv_table(spark.createDataFrame(rows, names), path)
    return path


def test_house_programs(spark, houses):
    screening = programs.house_fields(spark, houses)
    assert screening.kept == ["price", "bedrooms", "bathrooms", "sqft_living", "floors", "sqft_above"]
    found = {r["column"]: r["correlation"] for r in screening.correlations.collect()}
    assert found["sqft_living"] > 0.9 > abs(found["sqft_lot"])
    assert screening.matrix.count() == 36
    report = programs.house_prices(spark, houses)
    assert all(r["r2"] > 0.95 for r in report.metrics.collect())
    assert report.grid_scores.count() == 9 and report.best.count() == 2
    sweep = programs.house_segments(spark, houses, ks=[4, 5])
    assert [r["k"] for r in sweep.scores.orderBy("k").collect()] == [4, 5]


@pytest.fixture(scope="module")
def views(spark, tmp_path_factory):
    rng = random.Random(2)
    rows = []
    for i in range(500):
        last = rng.choice([None, *range(1, 20)])
        following = 2 * last if last else None
        rows.append((rng.choice(["card", "paypal"]), rng.choice(["GB", "US", "IN"]), rng.choice([1, 6, 12]), rng.randrange(1, 400),
                     rng.choice([None, 1]), last, (last or 0) + 5, following, i % 9 == 0))
    schema = (
        "payment_method_type string, country string, rebill_period_in_months int, age int, firstSub int, "
        "last_month_views int, all_time_views int, next_month_views int, is_cancelled boolean"
    )
    path = str(tmp_path_factory.mktemp("views") / "csv")
    write_csv_table(spark.createDataFrame(rows, schema).repartition(3), path)
    return path + "/*.csv"


def test_chapter_view_programs(spark, views):
    forecast = programs.chapter_views(spark, views)
    assert forecast.metrics.where("is_training").first()["r2"] > 0.95
    assert forecast.grid_scores.count() == 15
    lapse = programs.chapter_view_lapse(spark, views, grid=([0.01, 0.1], [0.0]))
    total = sum(r["n"] for r in lapse.metrics.collect())
    assert total == spark.read.option("header", True).csv(views).where("is_cancelled = 'false'").count()


def test_free_trials(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        seen = rng.randrange(0, 40)
        rows.append((rng.choice(["US", "GB", "FR", "GR", "UNKNOWN"]), rng.choice([1, 6]), int(seen > 15), seen, seen * 90))
    path = str(tmp_path / "csv")
    names = ["country", "rebill_period", "payments_made", "chapter_access_count", "seconds_watched"]
    write_csv_table(spark.createDataFrame(rows, names), path)
    report = programs.free_trials(spark, path)
    assert all(r["accuracy"] > 0.9 for r in report.accuracies.collect())
    assert set(report.rules) == {"decision_tree", "random_forest"}


def test_recommender_programs(spark, tmp_path):
    rows = [(u, c, ((u * c) % 10) / 10) for u in range(1, 9) for c in range(1, 7) if (u + c) % 3]
    path = str(tmp_path / "courses")
    write_csv_table(spark.createDataFrame(rows, ["userId", "courseId", "proportionWatched"]), path)
    _, recs = programs.course_views(spark, path, k=2)
    assert recs.groupBy("userId").count().where("count > 2").count() == 0 and recs.count() == 16
    found = str(tmp_path / "searches")
    searches = [(f"u{u}", c, 1 + (u * c) % 4) for u in range(6) for c in range(4)]
    spark.createDataFrame(searches, "username string, indicatorId int, count int").write.json(found)
    report = programs.indicator_searches(spark, found, "json", k=2)
    assert report.by_user.count() == 6 and report.by_item.count() == 4 and len(report.matrix().columns) == 5


def test_indicator_names(spark, tmp_path):
    rows = [(i, f"Number of {'girls' if i % 2 else 'boys'} enrolled in {'school' if i % 3 else 'camps'}", "number",
             "all" if i % 5 else None, None, f"n{i % 3}") for i in range(60)]
    path = str(tmp_path / "csv")
    schema = "indicatorNid int, indicatorName string, unit string, subgroup string, formId int, numerator string"
    write_csv_table(spark.createDataFrame(rows, schema), path)
    report = programs.indicator_names(spark, path, k=3, schema=schema)
    grams = {r["leading_ngram"] for r in report.predictions.collect()}
    assert grams == {"girls enrolled in", "boys enrolled in"} and report.predictions.count() == 48
