"""The jobs on their usual inputs: give a path, get the report.

Each program reads one kind of table with known columns and runs the matching
job of this package.  Nothing is printed; reports hold DataFrames.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plumbline.models.clustering import KMeansSweep
from plumbline.plans.recommenders import SearchReport, course_recommender, search_recommender
from plumbline.plans.tabular import (
    ClusterReport,
    Screening,
    TreeReport,
    TunedReport,
    activity_forecast,
    lapse_classifier,
    name_clustering,
    price_regression,
    screen_features,
    segment_by_kmeans,
    trial_conversion,
)
from plumbline.sources.tables import read_csv_table, read_interactions

Schema = T.StructType | str | None

# Columns of the house sales table.
HOUSE_UNUSED = ["id", "date", "waterfront", "view", "condition", "grade", "yr_renovated", "zipcode", "lat", "long"]
HOUSE_WEAK = ["sqft_lot", "yr_built", "sqft_lot15"]
HOUSE_CATEGORIES = ["condition", "grade", "zipcode"]
HOUSE_NUMBERS = ["bedrooms", "bathrooms", "sqft_living", "floors", "waterfront"]
HOUSE_RATIO = ("sqft_above", "sqft_living", "sqft_above_percentage")
HOUSE_SEGMENT = ["bedrooms", "bathrooms", "sqft_living", "price"]

# Columns of the chapter views table.
VIEW_CATEGORIES = ["payment_method_type", "country", "rebill_period_in_months"]
VIEW_NUMBERS = ["age", "firstSub", "last_month_views", "all_time_views"]
VIEW_COUNTS = ["firstSub", "last_month_views", "all_time_views"]
VIEW_LABEL = "next_month_views"

# Numeric columns of the free trials table.
TRIAL_NUMBERS = ["rebill_period", "chapter_access_count", "seconds_watched"]


def house_fields(spark: SparkSession, path: str, schema: Schema = None) -> Screening:
    """Which columns move with the price of a house."""
    return screen_features(read_csv_table(spark, path, schema), "price", HOUSE_UNUSED, HOUSE_WEAK)


def house_prices(spark: SparkSession, path: str, schema: Schema = None, **options) -> TunedReport:
    """Price of a house."""
    df = read_csv_table(spark, path, schema)
    options.setdefault("key", "id" if "id" in df.columns else None)
    return price_regression(df, "price", HOUSE_CATEGORIES, HOUSE_NUMBERS, HOUSE_RATIO, **options)


def house_segments(spark: SparkSession, path: str, schema: Schema = None, **options) -> KMeansSweep:
    """Groups of houses."""
    return segment_by_kmeans(read_csv_table(spark, path, schema), HOUSE_SEGMENT, **options)


def chapter_views(spark: SparkSession, path: str, schema: Schema = None, **options) -> TunedReport:
    """Views of the next month; ``path`` may be a glob over part files."""
    df = read_csv_table(spark, path, schema)
    return activity_forecast(df, VIEW_LABEL, VIEW_CATEGORIES, VIEW_NUMBERS, [*VIEW_COUNTS, VIEW_LABEL], **options)


def chapter_view_lapse(spark: SparkSession, path: str, schema: Schema = None, **options) -> TunedReport:
    """Who watches nothing next month; ``path`` may be a glob over part files."""
    df = read_csv_table(spark, path, schema)
    return lapse_classifier(df, VIEW_LABEL, VIEW_CATEGORIES, ["age"], VIEW_COUNTS, **options)


def free_trials(spark: SparkSession, path: str, schema: Schema = None, **options) -> TreeReport:
    """Who pays after a free trial."""
    return trial_conversion(read_csv_table(spark, path, schema), "country", "payments_made", TRIAL_NUMBERS, **options)


def course_views(spark: SparkSession, path: str, schema: Schema = None, **options) -> tuple[ALSModel, DataFrame]:
    """Courses to recommend."""
    return course_recommender(read_csv_table(spark, path, schema), **options)


def indicator_names(
    spark: SparkSession, path: str, out_path: str | None = None, schema: Schema = None, **options
) -> ClusterReport:
    """Groups of indicators counted in numbers, by name and numerator."""
    return name_clustering(
        read_csv_table(spark, path, schema),
        # Column names and unit of the usual table.
        "indicatorNid",
        "indicatorName",
        "numerator",
        ["subgroup", "unit", "numerator"],
        {"unit": "number"},
        ["formId"],
        out_path=out_path,
        **options,
    )


def indicator_searches(spark: SparkSession, path: str, format: str = "parquet", **options) -> SearchReport:
    """Indicators to recommend to the users who search."""
    return search_recommender(read_interactions(spark, path, format), **options)
