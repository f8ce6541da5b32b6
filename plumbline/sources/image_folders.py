"""Image folders."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from plumbline.operators.columns import constant_column
from plumbline.operators.splits import union_all


def read_images(spark: SparkSession, path: str, keep_undecodable: bool = False) -> DataFrame:
    """Images of a folder and its sub-folders as Spark's image struct.

    Files that do not decode are left out; with ``keep_undecodable`` they stay
    as rows of height -1.
    """
    return (
        spark.read.format("image")
        .option("recursiveFileLookup", True)
        .option("dropInvalid", not keep_undecodable)
        .load(path)
    )


def drop_undecodable_images(images: DataFrame) -> DataFrame:
    """Drop the rows a reader marked as not decodable."""
    return images.where("image.height > 0 AND image.width > 0")


def label_image_folders(spark: SparkSession, folders: Mapping[str, int]) -> DataFrame:
    """One folder per class, read and labelled, as one frame ``(image, label)``."""
    parts = [constant_column(read_images(spark, path), "label", label) for path, label in folders.items()]
    return reduce(union_all, parts)
