"""Queries of the image operators."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from plumbline.catalog import inputs as src
from plumbline.catalog.registry import query
from plumbline.functions import image_ops
from plumbline.operators.splits import stratified_holdout
from plumbline.plans import images as plans
from plumbline.session import spread
from plumbline.sources import image_folders


def by_position(df, height, value):
    """Column-major pixel arrays as rows per position."""
    df = df.select("name", F.posexplode_outer("pixels").alias("_at", value))
    return df.select(
        F.regexp_extract("name", r"(\d+)", 1).cast("long").alias("vec_id"),
        F.expr(f"CAST(_at DIV {height} AS INT)").alias("x"),
        (F.col("_at") % height).alias("y"),
        value,
    )


GRAY_SQL = "CAST(floor(r * 0.21::DOUBLE) AS INTEGER) + CAST(floor(g * 0.72::DOUBLE) AS INTEGER) + CAST(floor(b * 0.07::DOUBLE) AS INTEGER)"
SIZE = (image_ops.IMAGE_WIDTH, image_ops.IMAGE_HEIGHT)


def summed(pixels, *by, height=SIZE[1]):
    """Column-major pixel arrays summed by position: plain, and weighted by the number of the image, which tells images apart."""
    vector = array_to_vector(F.transform("pixels", lambda p: p.cast("double")))
    rows = pixels.select(*by, (F.col("image") % 97 + 1).cast("double").alias("weight"), vector.alias("v"))
    sums = rows.groupBy(*by).agg(F.count("*").alias("images"), Summarizer.sum(F.col("v")).alias("plain"), Summarizer.sum(F.col("v"), F.col("weight")).alias("weighted"))
    both = F.arrays_zip(vector_to_array("plain").alias("total"), vector_to_array("weighted").alias("weighted"))
    spots = sums.select(*by, "images", F.posexplode(both).alias("at", "spot"))
    return spots.select(
        *by,
        F.expr(f"CAST(at DIV {height} AS INT)").alias("x"),
        (F.col("at") % height).alias("y"),
        "images",
        F.round("spot.total").cast("long").alias("total"),
        F.round("spot.weighted").cast("long").alias("weighted"),
    )


def stretched_sql(value: str, frame: str, number: str, width: str, height: str, by: str = "") -> str:
    """The same of stretched images: sums by source position, given to every target position whose centre lies over it."""
    by = f"{by}, " if by else ""
    return f"""WITH s AS (SELECT {by}x, y, {width} AS w, {height} AS h, count(*) AS images, sum({value}) AS total, sum(({value}) * ({number} % 97 + 1)) AS weighted
                 FROM ({frame}) GROUP BY ALL)
      SELECT {by}CAST(tx AS INTEGER) AS x, CAST(ty AS INTEGER) AS y, CAST(sum(images) AS BIGINT) AS images,
             CAST(sum(total) AS BIGINT) AS total, CAST(sum(weighted) AS BIGINT) AS weighted
      FROM s JOIN range({SIZE[0]}) u(tx) ON (2 * tx + 1) * w // {2 * SIZE[0]} = x JOIN range({SIZE[1]}) v(ty) ON (2 * ty + 1) * h // {2 * SIZE[1]} = y
      GROUP BY ALL"""


def of_vectors(pixels):
    return pixels.withColumn("image", F.regexp_extract("name", r"(\d+)", 1).cast("long"))


@query("I1", f"SELECT vec_id, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, {GRAY_SQL} AS gray FROM ({src.VECTOR_IMAGES_SQL})")
def gray_images(spark, sf_dir):
    gray = image_ops.gray_images(src.vector_images(spark, sf_dir))
    return by_position(image_ops.pixel_vectors(gray), 8, "gray")


# How often a stretch repeats each of 8 source positions; a line is its pixels repeated, an image its lines.
TIMES_SQL = "(SELECT list(m ORDER BY s) FROM (SELECT (2 * t + 1) * 8 // (2 * {0}) AS s, count(*) AS m FROM range({0}) r(t) GROUP BY s))"
PIXEL_SQL = "printf('%02X%02X%02X', " + ", ".join(f"pixels[(8 * y + x + {d}) % {src.VECTOR_WIDTH} + 1]" for d in range(3)) + ")"
LINE_SQL = f"array_to_string([repeat({PIXEL_SQL}, across[x + 1]) FOR x IN range(8)], '')"


@query(
    "I2",
    f"""SELECT vec_id, label, {SIZE[1]} AS height, {SIZE[0]} AS width, 3 AS channels,
               sha256(unhex(array_to_string([repeat({LINE_SQL}, down[y + 1]) FOR y IN range(8)], ''))) AS data_sha256
        FROM ({src.PIXELS_SQL}), (SELECT {TIMES_SQL.format(SIZE[0])} AS across, {TIMES_SQL.format(SIZE[1])} AS down)""",
)
def resize_images(spark, sf_dir):
    """Every image stretched to full size: its shape and the digest of all its bytes, in all channels."""
    resized = image_ops.resize_images(spread(src.vector_images(spark, sf_dir)))
    return resized.select(
        "vec_id",
        "label",
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.sha2("image.data", 256).alias("data_sha256"),
    )


@query(
    "I3 P13",
    f"""SELECT CAST(vec_id AS VARCHAR) || '.bmp' AS name, label,
               string_agg(CAST(b AS VARCHAR), ' ' ORDER BY x, y) AS pixels
        FROM ({src.VECTOR_IMAGES_SQL}) GROUP BY vec_id, label""",
)
def pixel_vectors(spark, sf_dir):
    df = image_ops.pixel_vectors(src.vector_images(spark, sf_dir))
    return df.select("name", "label", F.array_join(F.transform("pixels", lambda p: p.cast("string")), " ").alias("pixels"))


@query("I1 I2 I3", stretched_sql(GRAY_SQL, src.VECTOR_IMAGES_SQL, "vec_id", "8", "8"))
def image_pixels(spark, sf_dir):
    """Stretch, gray rule and flattening as one pass, at full size."""
    return summed(of_vectors(image_ops.image_pixels(src.vector_images(spark, sf_dir))))


@query(
    "S5 F5",
    f"""SELECT image_id, CAST(max(y) + 1 AS INTEGER) AS height, CAST(max(x) + 1 AS INTEGER) AS width, 3 AS channels,
               string_agg(printf('%02X%02X%02X', v, v, v), '' ORDER BY y, x) AS data
        FROM ({src.IMAGE_FILES_SQL}) GROUP BY image_id""",
)
def read_images(spark, sf_dir):
    images = image_folders.read_images(spark, src.image_folder(spark, sf_dir))
    return images.select(
        src.image_number().alias("image_id"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.hex("image.data").alias("data"),
    )


@query(
    "F5",
    f"SELECT DISTINCT vec_id // {src.ROWS_PER_IMAGE} AS image_id FROM embeddings WHERE (vec_id // {src.ROWS_PER_IMAGE}) % 10 <> 9",
)
def drop_undecodable_images(spark, sf_dir):
    images = image_folders.read_images(spark, src.image_folder(spark, sf_dir), keep_undecodable=True)
    return image_folders.drop_undecodable_images(images).select(src.image_number().alias("image_id"))


def class_folders(spark, sf_dir):
    path = src.image_folder(spark, sf_dir)
    return {f"{path}/label=0": 0, f"{path}/label=1": 1}


@query(
    "I4 P9 U1 U4",
    f"""SELECT DISTINCT image_id, label, {src.bucket_sql('image_id')} < 90 AS is_training FROM ({src.IMAGE_FILES_SQL})""",
)
def label_image_folders(spark, sf_dir):
    images = image_folders.label_image_folders(spark, class_folders(spark, sf_dir))
    numbered = images.select(src.image_number().alias("image_id"), "label")
    training, holdout = stratified_holdout(numbered, "label", {0: 90, 1: 90}, "image_id")
    return training.withColumn("is_training", F.lit(True)).unionAll(holdout.withColumn("is_training", F.lit(False)))


FILE_GRAY_SQL = " + ".join(f"CAST(floor(v * {w}::DOUBLE) AS INTEGER)" for w in (0.21, 0.72, 0.07))
FILES_SQL = f"SELECT *, max(y) OVER (PARTITION BY image_id) + 1 AS h FROM ({src.IMAGE_FILES_SQL})"


@query("C10", stretched_sql(FILE_GRAY_SQL, FILES_SQL, "0", "64", "h", "label"))
def image_features(spark, sf_dir):
    """Full-size pixels of both class folders, summed by position over all images of a class."""
    parts = [plans.image_features(spark, path, label) for path, label in class_folders(spark, sf_dir).items()]
    return summed(parts[0].unionByName(parts[1]).withColumn("image", F.lit(0)), "label")


@query("C13 I4 I3 M5")
def image_forest(spark, sf_dir):
    report = plans.image_forest(spark, class_folders(spark, sf_dir))
    return report.predictions.select("label", F.round("prediction", 6).alias("prediction"))
