"""Pixel lines: one text line ``name,label,p p p ...`` per image.

Images are flattened column by column, and the text form puts a second blank
after every image column.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.image_ops import unsigned


def parse_pixel_lines(lines: DataFrame, legacy: bool = False, value: str = "value") -> DataFrame:
    """``(name, label, pixels)`` out of text lines.

    The pixels follow the last comma, the label stands before it, and the rest
    is the name, which may itself hold commas.  ``legacy`` gives the literal
    older reading: the label is the one character behind the first comma, and
    every doubled blank adds one zero to the end of the pixels.
    """
    line = F.col(value)
    pixel_text = F.substring_index(line, ",", -1)
    tokens = F.split(F.rtrim(F.ltrim(pixel_text)), " ")
    numbers = F.transform(F.filter(tokens, lambda t: t != ""), lambda t: t.cast("int"))
    if legacy:
        blanks = F.size(tokens) - F.size(numbers)
        first_comma = F.instr(line, ",")
        return lines.select(
            F.substring_index(line, ",", 1).alias("name"),
            F.substr(line, first_comma + F.lit(1), F.lit(1)).cast("int").alias("label"),
            F.concat(numbers, F.array_repeat(F.lit(0), blanks)).alias("pixels"),
        )
    tail = F.substring_index(line, ",", -2)
    return lines.select(
        F.substr(line, F.lit(1), F.length(line) - F.length(tail) - F.lit(1)).alias("name"),
        F.substring_index(tail, ",", 1).cast("int").alias("label"),
        numbers.alias("pixels"),
    )


def read_pixel_lines(spark: SparkSession, path: str, legacy: bool = False) -> DataFrame:
    """Pixel lines of a file or of a folder and its sub-folders; of a folder with a manifest only what its runs committed."""
    committed = committed_folders(spark, path)
    if committed == []:
        lines = spark.createDataFrame([], "value string")
    else:
        lines = spark.read.option("recursiveFileLookup", True).text(path if committed is None else committed)
    return parse_pixel_lines(lines.where(F.length("value") > 0), legacy)


def pixel_text(pixels: Column, height: int | None = None) -> Column:
    """Pixels as text; with ``height`` each image column ends in a second blank."""
    words = F.transform(pixels, lambda p: p.cast("string"))
    if height is None:
        return F.array_join(words, " ")
    starts = F.sequence(F.lit(1), F.size(words), F.lit(height))
    columns = F.transform(starts, lambda s: F.concat(F.array_join(F.slice(words, s, F.lit(height)), " "), F.lit("  ")))
    return F.array_join(columns, "")


def format_pixel_lines(df: DataFrame, height: int | None = None) -> DataFrame:
    """``(label, value)`` with the text line of each ``(name, label, pixels)`` row."""
    text = pixel_text(F.col("pixels"), height)
    return df.select("label", F.concat_ws(",", "name", F.col("label").cast("string"), text).alias("value"))


def write_pixel_lines(
    df: DataFrame, path: str, label: int | None = None, height: int | None = None, mode: str = "overwrite"
) -> None:
    """Write pixel lines to ``path``, one folder per label.

    A folder of a label that is written again is replaced, so a job that runs
    twice does not double its lines; ``mode="append"`` adds to it.
    """
    if committed_folders(df.sparkSession, path) is not None:
        raise ValueError("runs were appended to this folder; go on with append_pixel_lines")
    if label is not None:
        df = df.withColumn("label", F.lit(label))
    writer = format_pixel_lines(df, height).write.mode(mode).partitionBy("label")
    writer.option("partitionOverwriteMode", "dynamic").text(path)


MANIFEST = "_manifest"


def append_pixel_lines(df: DataFrame, path: str, run: str, label: int | None = None, height: int | None = None) -> bool:
    """Add the lines of one ``run`` to ``path``; false if that run is there already.

    A run writes a folder of its own, and then one small entry of the manifest names it.
    Readers follow the manifest, so a run that fails half-way adds nothing, one that is
    repeated adds its lines once, and runs side by side do not disturb each other.
    What a failed run wrote is never read.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", run):
        raise ValueError("a run is named by letters, digits, - and _")
    spark = df.sparkSession
    files, entry = _file(spark, f"{path}/{MANIFEST}/{run}")
    if files.exists(entry):
        return False
    if label is not None:
        df = df.withColumn("label", F.lit(label))
    folder = f"run-{run}-{uuid.uuid4().hex}"
    format_pixel_lines(df, height).write.partitionBy("label").text(f"{path}/{folder}")
    # Written aside and renamed, so that an entry is whole or absent.
    _, aside = _file(spark, f"{path}/{MANIFEST}/.{folder}")
    out = files.create(aside)
    try:
        out.write(bytearray(folder.encode()))
    finally:
        out.close()
    return files.rename(aside, entry)


def committed_folders(spark: SparkSession, path: str) -> list[str] | None:
    """The folders that the manifest of ``path`` names, one per run; null without a manifest."""
    files, manifest = _file(spark, f"{path}/{MANIFEST}")
    if not files.exists(manifest):
        return None
    # Each entry by its own name: Spark skips a folder whose name starts with an underscore.
    entries = [s.getPath() for s in files.listStatus(manifest)]
    entries = [e.toString() for e in entries if not e.getName().startswith(".")]
    return sorted(f"{path}/{row['value']}" for row in spark.read.text(entries).collect()) if entries else []


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def labeled_points(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(name, label double, features vector)`` for the estimators, and the columns to ``keep``.

    Packed pixels (``array<tinyint>``) are widened here, so tables hold a byte a pixel.
    """
    packed = isinstance(df.schema["pixels"].dataType.elementType, T.ByteType)
    numbers = F.transform(unsigned(F.col("pixels")) if packed else "pixels", lambda p: p.cast("double"))
    return df.select("name", F.col("label").cast("double").alias("label"), *keep, array_to_vector(numbers).alias("features"))
