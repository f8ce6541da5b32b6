import hashlib
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions import image_ops
from plumbline.models.estimators import fit_naive_bayes
from plumbline.plans import images as plans
from plumbline.sources import image_folders, pixel_lines
from plumbline.streaming.arrivals import pixel_line_stream, score_arrivals


def write_png(path, rgb):
    height, width, _ = rgb.shape
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = b"".join(b"\0" + row.tobytes() for row in rgb)
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b""))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Two class folders with images of several sizes, a sub-folder, and one broken file."""
    root = tmp_path_factory.mktemp("images")
    rng = np.random.default_rng(3)
    pictures = {}
    for name in ["dark/a.one.png", "dark/deep/b.png", "bright/c.png", "bright/d.png"]:
        rgb = rng.integers(0, 100, (rng.integers(2, 9), rng.integers(2, 9), 3)).astype(np.uint8)
        if name.startswith("bright"):
            rgb = rgb + np.uint8(150)
        os.makedirs(root / os.path.dirname(name), exist_ok=True)
        write_png(root / name, rgb)
        pictures[os.path.basename(name)] = rgb
    (root / "dark" / "broken.png").write_bytes(b"not an image")
    return str(root), pictures


def brute_gray(rgb, width, height):
    """Pixel by pixel: stretch, gray rule, column by column."""
    out = []
    for x in range(width):
        for y in range(height):
            r, g, b = (int(v) for v in rgb[int((y + 0.5) * rgb.shape[0] / height), int((x + 0.5) * rgb.shape[1] / width)])
            out.append(int(r * 0.21) + int(g * 0.72) + int(b * 0.07))
    return out


def test_reader_drops_broken_files_and_orders_blue_first(spark, folder):
    root, pictures = folder
    images = image_folders.read_images(spark, root)
    rows = {os.path.basename(r["image"]["origin"]): r["image"] for r in images.collect()}
    assert set(rows) == set(pictures)
    for name, rgb in pictures.items():
        assert (rows[name]["height"], rows[name]["width"]) == rgb.shape[:2]
        assert bytes(rows[name]["data"]) == rgb[:, :, ::-1].tobytes()
    kept = image_folders.read_images(spark, root, keep_undecodable=True)
    assert kept.count() == 5 and image_folders.drop_undecodable_images(kept).count() == 4


@pytest.mark.parametrize("width,height", [(5, 7), (3, 2), (16, 16)])
def test_pixel_pass_equals_brute_force(spark, folder, width, height):
    root, pictures = folder
    images = image_folders.read_images(spark, root)
    fused = {r["name"]: list(r["pixels"]) for r in image_ops.image_pixels(images, 1, width, height).collect()}
    steps = image_ops.pixel_vectors(image_ops.gray_images(image_ops.resize_images(images, width, height)), 1)
    stepped = {r["name"]: list(r["pixels"]) for r in steps.collect()}
    expected = {name: brute_gray(rgb, width, height) for name, rgb in pictures.items()}
    assert fused == expected and stepped == expected


def test_white_is_253_and_default_size(spark, tmp_path):
    write_png(tmp_path / "white.png", np.full((2, 2, 3), 255, np.uint8))
    row = plans.image_features(spark, str(tmp_path), 1).first()
    assert len(row["pixels"]) == 36_000 and set(row["pixels"]) == {253}


def test_lines_round_trip(spark, folder, tmp_path):
    root, _ = folder
    out = str(tmp_path / "lines")
    pixels = plans.image_features(spark, root, 10, 4, 3, out_path=out)
    back = pixel_lines.read_pixel_lines(spark, out)
    pick = lambda df: sorted((r["name"], r["label"], tuple(r["pixels"])) for r in df.collect())
    assert pick(back) == pick(pixels)
    assert os.path.isdir(f"{out}/label=10")


def test_clean_and_legacy_parse(spark):
    lines = spark.createDataFrame([("a.png,10,1 2  3 4  ",), ("b,c.png,1,5 6  7 8  ",)], "value string")
    clean = [(r["name"], r["label"], list(r["pixels"])) for r in pixel_lines.parse_pixel_lines(lines).collect()]
    assert clean == [("a.png", 10, [1, 2, 3, 4]), ("b,c.png", 1, [5, 6, 7, 8])]
    legacy = pixel_lines.parse_pixel_lines(lines.limit(1), legacy=True).first()
    assert (legacy["label"], list(legacy["pixels"])) == (1, [1, 2, 3, 4, 0])


def test_legacy_width_of_the_default_size(spark):
    """200 values in each of 180 columns leave 179 doubled blanks."""
    text = "".join("7 " * 200 + " " for _ in range(180))
    lines = spark.createDataFrame([(f"a.png,1,{text}",)], "value string")
    assert len(pixel_lines.parse_pixel_lines(lines, legacy=True).first()["pixels"]) == 36_179
    assert len(pixel_lines.parse_pixel_lines(lines).first()["pixels"]) == 36_000


def test_written_text_form(spark):
    df = spark.createDataFrame([("a.png", 1, [1, 2, 3, 4])], "name string, label int, pixels array<int>")
    assert pixel_lines.format_pixel_lines(df, height=2).first()["value"] == "a.png,1,1 2  3 4  "
    assert pixel_lines.format_pixel_lines(df).first()["value"] == "a.png,1,1 2 3 4"


def test_compare_score_and_forest(spark, folder):
    root, _ = folder
    folders = {f"{root}/dark": 0, f"{root}/bright": 1}
    pixels = image_ops.image_pixels(image_folders.label_image_folders(spark, folders), None, 4, 4)
    models, scores = plans.image_model_compare(pixels, pixels, iterations=10)
    table = {r["model"]: r for r in scores.collect()}
    assert set(table) == {"naive_bayes", "linear_svm"} and all(r["n"] == 4 for r in table.values())
    scored, accuracy = plans.image_batch_score(
        models["naive_bayes"], image_folders.read_images(spark, f"{root}/dark", keep_undecodable=True), 0, 4, 4
    )
    assert scored.count() == 2 and accuracy.first()["n"] == 2
    report = plans.image_forest(spark, folders, 60, 4, 4, numTrees=3)
    assert report.predictions.count() + report.training_rows.count() == 4


def test_stream_scores_like_the_batch(spark, tmp_path):
    rows = [(f"i{i}.png", i % 2, [10 + 90 * (i % 2), 100 - 80 * (i % 2), i]) for i in range(20)]
    df = spark.createDataFrame(rows, "name string, label int, pixels array<int>")
    model = fit_naive_bayes(pixel_lines.labeled_points(df))
    arriving = str(tmp_path / "arriving")
    pixel_lines.write_pixel_lines(df, arriving)
    stream = score_arrivals(model, pixel_line_stream(spark, arriving, files_per_batch=1))
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    query = stream.writeStream.format("parquet").option("checkpointLocation", mark).trigger(availableNow=True).start(out)
    query.awaitTermination(120)
    pick = lambda d: sorted(tuple(r) for r in d.collect())
    assert pick(spark.read.parquet(out)) == pick(plans.classify_image_batch(model, df))


def test_gray_image_struct_keeps_its_shape(spark, folder):
    root, _ = folder
    gray = image_ops.gray_images(image_folders.read_images(spark, root))
    sizes = gray.select(F.expr("length(image.data) = image.height * image.width AND image.nChannels = 1").alias("ok"))
    assert all(r["ok"] for r in sizes.collect())


def lines_of(spark, numbers):
    return spark.createDataFrame([(f"n{i}", i % 3, [i, i + 1]) for i in numbers], "name string, label int, pixels array<int>")


def test_appended_runs_leave_each_line_once(spark, tmp_path):
    path = str(tmp_path / "lines")
    names = lambda: sorted(r["name"] for r in pixel_lines.read_pixel_lines(spark, path).collect())
    assert pixel_lines.append_pixel_lines(lines_of(spark, range(6)), path, "monday")
    assert not pixel_lines.append_pixel_lines(lines_of(spark, range(6)), path, "monday")
    assert names() == [f"n{i}" for i in range(6)]
    failing = lines_of(spark, range(6, 12)).repartition(6)
    bad = failing.withColumn("name", F.when(F.col("name") == "n11", F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        pixel_lines.append_pixel_lines(bad, path, "tuesday")
    assert names() == [f"n{i}" for i in range(6)]
    assert pixel_lines.append_pixel_lines(failing, path, "tuesday") and len(names()) == 12
    with pytest.raises(ValueError):
        pixel_lines.write_pixel_lines(lines_of(spark, [1]), path)
    with pytest.raises(ValueError):
        pixel_lines.append_pixel_lines(failing, path, "../out")


def test_a_first_run_that_fails_or_is_empty(spark, tmp_path):
    path = str(tmp_path / "lines")
    assert pixel_lines.append_pixel_lines(lines_of(spark, [1]).where("false"), path, "none")
    assert pixel_lines.read_pixel_lines(spark, path).count() == 0


def test_forest_fits_on_few_partitions(spark, folder, monkeypatch):
    root, _ = folder
    seen = []
    fit = plans.fit_forest_regression
    monkeypatch.setattr(plans, "FOREST_TASKS", 1)
    monkeypatch.setattr(plans, "pin", lambda df, name: df.repartition(5))
    monkeypatch.setattr(plans, "fit_forest_regression", lambda df, **params: seen.append(df.rdd.getNumPartitions()) or fit(df, **params))
    plans.image_forest(spark, {f"{root}/dark": 0, f"{root}/bright": 1}, 60, 4, 4, numTrees=3)
    assert seen == [1]


def vectors_table(spark, path, n):
    vector = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (F.sin(i * (F.col("id") + 1))).cast("float"))
    spark.range(n).select(F.col("id").alias("vec_id"), vector.alias("embedding"), (F.col("id") % 3).cast("int").alias("label")).write.parquet(f"{path}/embeddings.parquet")


def test_resize_query_gives_each_whole_image(spark, tmp_path):
    from plumbline.catalog import QUERIES
    from plumbline.catalog import inputs as src

    vectors_table(spark, str(tmp_path), 7)
    rows = QUERIES["resize_images"].run(spark, str(tmp_path)).collect()
    images = {r["vec_id"]: bytes(r["image"]["data"]) for r in src.vector_images(spark, str(tmp_path)).collect()}
    assert {(r["height"], r["width"], r["channels"]) for r in rows} == {(200, 180, 3)}
    for row in rows:
        small = np.frombuffer(images[row["vec_id"]], np.uint8).reshape(8, 8, 3)
        full = b"".join(small[(2 * y + 1) * 8 // 400, (2 * x + 1) * 8 // 360].tobytes() for y in range(200) for x in range(180))
        assert row["data_sha256"] == hashlib.sha256(full).hexdigest()
    assert len(rows) == 7


def test_batch_score_writes_no_pixels(spark, tmp_path, monkeypatch):
    from plumbline import session
    from plumbline.catalog import QUERIES

    vectors_table(spark, str(tmp_path), 25)
    written = []
    monkeypatch.setattr(session, "scratch_path", lambda *_: written.append(1) or str(tmp_path / "pins"))
    assert QUERIES["image_batch_score"].run(spark, str(tmp_path)).first()["n"] == 5 and not written
