"""Images to pixel tables, and models on them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import LinearSVC, NaiveBayes
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.image_ops import IMAGE_HEIGHT, IMAGE_WIDTH, image_pixels
from plumbline.models.estimators import fit_forest_regression
from plumbline.models.metrics import accuracy
from plumbline.models.tuning import compare_models
from plumbline.operators.splits import holdout_bucket
from plumbline.session import Report, balance, owns_pins, pin
from plumbline.sources.image_folders import drop_undecodable_images, label_image_folders, read_images
from plumbline.sources.pixel_lines import labeled_points, write_pixel_lines

TRAINING = "is_training"
# Every partition shuffles the statistics of every node it splits (at full size 9 MB a node before
# compression, however few its images), so the number of partitions of a fit does not follow the input.
FOREST_TASKS = 8


@dataclass
class ForestReport(Report):
    model: Model
    predictions: DataFrame
    training_rows: DataFrame


def image_features(
    spark: SparkSession,
    path: str,
    label: int,
    width: int = IMAGE_WIDTH,
    height: int = IMAGE_HEIGHT,
    out_path: str | None = None,
) -> DataFrame:
    """Pixel rows ``(name, label, pixels)`` of an image folder; the images stay as they are.

    With ``out_path`` the rows are written there as pixel lines, in place of earlier ones of the label.
    """
    pixels = image_pixels(read_images(spark, path), label, width, height)
    if out_path:
        pixels = pin(pixels, "pixels")
        write_pixel_lines(pixels, out_path, height=height)
    return pixels


def image_model_compare(
    train_pixels: DataFrame, test_pixels: DataFrame, iterations: int = 100
) -> tuple[dict[str, Model], DataFrame]:
    """Naive Bayes and a linear SVM on two-class pixel rows: models and accuracies."""
    # The solver makes up to ``iterations`` passes, a job each: few even partitions cost least.
    train = pin(balance(labeled_points(train_pixels)), "train-points")
    estimators = {
        "naive_bayes": NaiveBayes(smoothing=1.0),
        "linear_svm": LinearSVC(maxIter=iterations, regParam=0.01, fitIntercept=False, standardization=False),
    }
    return compare_models(estimators, train, labeled_points(test_pixels))


def classify_image_batch(model: Model, pixels: DataFrame) -> DataFrame:
    """Score any number of pixel rows with a model trained before."""
    return model.transform(labeled_points(pixels)).select("name", "label", "prediction")


def image_batch_score(
    model: Model,
    images: DataFrame,
    label: int | None = None,
    width: int = IMAGE_WIDTH,
    height: int = IMAGE_HEIGHT,
) -> tuple[DataFrame, DataFrame]:
    """Images through the pixel pass and the model: scored rows and their accuracy."""
    scored = classify_image_batch(model, image_pixels(drop_undecodable_images(images), label, width, height, packed=True))
    return scored, accuracy(scored)


@owns_pins
def image_forest(
    spark: SparkSession,
    folders: Mapping[str, int],
    pct: int = 90,
    width: int = IMAGE_WIDTH,
    height: int = IMAGE_HEIGHT,
    **params,
) -> ForestReport:
    """Forest regression on labelled image folders, split within each class by file."""
    images = label_image_folders(spark, folders).withColumn("_origin", F.col("image.origin"))
    flagged = images.withColumn(TRAINING, holdout_bucket(images, "_origin") < pct)
    # Every image is read and decoded once; both parts are filters over the written pixels, a byte each.
    pixels = pin(image_pixels(flagged, None, width, height, keep=[TRAINING], packed=True), "forest-pixels")
    points = labeled_points(pixels, keep=[TRAINING])
    model = fit_forest_regression(points.where(TRAINING).coalesce(FOREST_TASKS), **params)
    return ForestReport(model, model.transform(points.where(~F.col(TRAINING))), points.where(TRAINING))
