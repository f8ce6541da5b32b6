"""Image features: stretch, gray rule and flattening, in Arrow batches.

Pixel bytes of Spark's image struct run row by row, channels in the order blue,
green, red.  The Arrow passes take only the columns they need, and a row never
depends on another, so the work splits over any number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.columns import file_basename

# Size of the stretched image and the gray weights of each channel.
IMAGE_WIDTH = 180
IMAGE_HEIGHT = 200
RED_WEIGHT = 0.21
GREEN_WEIGHT = 0.72
BLUE_WEIGHT = 0.07

IMAGE_FIELDS = ("origin", "height", "width", "nChannels", "mode", "data")
IMAGES_PER_PIECE = 64
# Number of channels -> OpenCV type code of Spark's image struct.
MODES = {1: 0, 3: 16, 4: 24}


def _pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width, channels)


def _stretch(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """Nearest source pixel at the centre of each target pixel."""
    rows = (2 * np.arange(height) + 1) * pixels.shape[0] // (2 * height)
    cols = (2 * np.arange(width) + 1) * pixels.shape[1] // (2 * width)
    return pixels[rows[:, None], cols[None, :]]


def _gray(pixels: np.ndarray) -> np.ndarray:
    """Each channel weighted and cut to an integer before the sum."""
    if pixels.shape[2] == 1:
        blue = green = red = pixels[:, :, 0]
    else:
        blue, green, red = pixels[:, :, 0], pixels[:, :, 1], pixels[:, :, 2]
    cut = lambda channel, weight: (channel * weight).astype(np.uint8)
    return cut(red, RED_WEIGHT) + cut(green, GREEN_WEIGHT) + cut(blue, BLUE_WEIGHT)


def _each_image(batches: Iterator[tuple], result) -> Iterator[pd.Series]:
    """``result(pixels)`` of every image, in pieces of bounded size.

    Spark limits a batch by its input bytes, and many small images in one batch
    can stretch to far more.
    """
    for batch in batches:
        images = zip(*batch)
        while piece := [result(_pixels(*row)) for row in islice(images, IMAGES_PER_PIECE)]:
            yield pd.Series(piece)


def _image_args(image: str) -> list[Column]:
    return [F.col(f"{image}.{name}") for name in ("data", "height", "width", "nChannels")]


def _image_struct(image: str, data: Column, height: Column, width: Column, channels: Column, mode: Column) -> Column:
    parts = dict(
        origin=F.col(f"{image}.origin"), height=height, width=width, nChannels=channels, mode=mode, data=data
    )
    return F.struct(*[parts[name].alias(name) for name in IMAGE_FIELDS])


def gray_images(df: DataFrame, image: str = "image") -> DataFrame:
    """Images reduced to one gray channel (0..253)."""

    @F.pandas_udf(T.BinaryType())
    def gray(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        return _each_image(batches, lambda pixels: _gray(pixels).tobytes())

    struct = _image_struct(
        image, gray(*_image_args(image)), F.col(f"{image}.height"), F.col(f"{image}.width"), F.lit(1), F.lit(MODES[1])
    )
    return df.withColumn(image, struct)


def resize_images(
    df: DataFrame, width: int = IMAGE_WIDTH, height: int = IMAGE_HEIGHT, image: str = "image"
) -> DataFrame:
    """Images stretched to a fixed size, without keeping the aspect."""

    @F.pandas_udf(T.BinaryType())
    def stretch(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        return _each_image(batches, lambda pixels: _stretch(pixels, width, height).tobytes())

    struct = _image_struct(
        image,
        stretch(*_image_args(image)),
        F.lit(height),
        F.lit(width),
        F.col(f"{image}.nChannels"),
        F.col(f"{image}.mode"),
    )
    return df.withColumn(image, struct)


def unsigned(pixels: Column) -> Column:
    """Packed pixels (``array<tinyint>``, a byte each) as numbers 0..255, without leaving the JVM."""
    return F.transform(pixels, lambda p: p.cast("int").bitwiseAND(F.lit(255)))


def _packed(pixels: np.ndarray) -> np.ndarray:
    """One channel, column by column, in signed bytes: what Arrow carries is a byte a pixel."""
    return np.ascontiguousarray(pixels.T, np.uint8).ravel().view(np.int8)


def pixel_vectors(df: DataFrame, label: int | None = None, image: str = "image") -> DataFrame:
    """``(name, label, pixels)`` with the first channel flattened column by column."""

    @F.pandas_udf(T.ArrayType(T.ByteType()))
    def flatten(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        return _each_image(batches, lambda pixels: _packed(pixels[:, :, 0]))

    packed = _named(df, label, image).select("name", "label", flatten(*_image_args(image)).alias("pixels"))
    return packed.withColumn("pixels", unsigned(F.col("pixels")))


def image_pixels(
    df: DataFrame,
    label: int | None = None,
    width: int = IMAGE_WIDTH,
    height: int = IMAGE_HEIGHT,
    image: str = "image",
    keep: Sequence[str] = (),
    packed: bool = False,
) -> DataFrame:
    """Stretch, gray rule and flattening in a single pass over the image bytes; ``keep`` names further columns to carry.

    ``packed`` leaves the pixels as ``array<tinyint>``, a byte each, for tables that
    are written; ``labeled_points`` and ``unsigned`` read those.
    """

    @F.pandas_udf(T.ArrayType(T.ByteType()))
    def features(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        return _each_image(batches, lambda pixels: _packed(_gray(_stretch(pixels, width, height))))

    found = _named(df, label, image).select("name", "label", *keep, features(*_image_args(image)).alias("pixels"))
    return found if packed else found.withColumn("pixels", unsigned(F.col("pixels")))


def _named(df: DataFrame, label: int | None, image: str) -> DataFrame:
    df = file_basename(df, f"{image}.origin", "name")
    return df if label is None else df.withColumn("label", F.lit(label))
