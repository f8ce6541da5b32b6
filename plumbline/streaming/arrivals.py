"""Pixel lines that keep arriving, scored by a model trained once.

This takes the place of a request per image: each micro-batch scores all lines
that came in since the last one.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.images import classify_image_batch
from plumbline.sources.pixel_lines import parse_pixel_lines


def pixel_line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of ``(name, label, pixels)`` from text files dropped into a folder."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_pixel_lines(reader.text(path).where(F.length("value") > 0))


def score_arrivals(model: Model, stream: DataFrame) -> DataFrame:
    """Predictions for a stream of pixel rows; row by row, so it keeps no state."""
    return classify_image_batch(model, stream)
