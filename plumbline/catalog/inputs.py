"""Input frames of the registered queries, built from the given tables.

Each frame has a SQL twin for the checks.  Detail tables are aggregated before
they are joined, so those joins are one-to-one; joins of detail rows to a
dimension are left to adaptive execution, which splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import scratch_path
from plumbline.sources.pixel_lines import write_pixel_lines

# Nations stand in for countries: three are kept, eight form a group.
KEEP_NATIONS = ["NATION_0", "NATION_1", "NATION_2"]
NATION_GROUPS = {"EUROPE": [f"NATION_{i}" for i in range(3, 11)]}

# Images made of vectors: 16 vectors of 64 values are the rows of one image.
ROWS_PER_IMAGE = 16
VECTOR_WIDTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part: price, numbers and categories."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size", "p_retailprice")
    return table(spark, sf_dir, "lineitem").join(part, "l_partkey").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("retail"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
        F.col("p_brand").alias("brand"),
    )


HOUSES_SQL = """
SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity AS quantity, l_discount AS discount,
       l_tax AS tax, p_size AS size, p_retailprice AS retail, l_returnflag AS returnflag,
       l_linestatus AS linestatus, p_brand AS brand
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: country, order counts and sums."""
    urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    per_customer = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.when(urgent, 1)).alias("payments_made"),
        F.count("*").alias("access_count"),
        F.sum("o_totalprice").alias("amount"),
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    joined = table(spark, sf_dir, "customer").join(per_customer, "c_custkey", "left").join(nation, "c_nationkey")
    return joined.select(
        "c_custkey",
        "country",
        F.coalesce("payments_made", F.lit(0).cast("long")).alias("payments_made"),
        F.coalesce("access_count", F.lit(0).cast("long")).alias("access_count"),
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
        F.length("c_mktsegment").alias("rebill_period"),
    )


def bucket_sql(*keys: str) -> str:
    """The hold-out bucket of one or more key columns."""
    text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'null')" for k in keys)
    return f"CAST('0x' || left(md5({text}), 8) AS BIGINT) % 100"


TRIALS_SQL = """
SELECT c_custkey, n_name AS country, coalesce(payments_made, 0) AS payments_made,
       coalesce(access_count, 0) AS access_count, coalesce(amount, 0) AS amount
FROM customer
LEFT JOIN (SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 END) AS payments_made,
                  count(*) AS access_count, sum(o_totalprice) AS amount
           FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
JOIN nation ON n_nationkey = c_nationkey
"""


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders of its first half-year, of a month, of all time before, and of the next month.

    The next month is the last full one of the data; null stands for none.
    """
    orders = table(spark, sf_dir, "orders")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    first, last = orders.agg(F.min(month), F.max(month)).first()
    start = lambda day, months: F.add_months(F.lit(day), months).cast("timestamp_ntz")
    date = F.col("o_orderdate")
    count_if = lambda cond: F.sum(F.when(cond, 1))
    per_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        count_if(date < start(first, 6)).alias("firstSub"),
        count_if((date >= start(last, -2)) & (date < start(last, -1))).alias("last_month_views"),
        count_if(date < start(last, -1)).alias("all_time_views"),
        count_if((date >= start(last, -1)) & (date < start(last, 0))).alias("next_month_views"),
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    joined = table(spark, sf_dir, "customer").join(per_customer, "c_custkey", "left").join(nation, "c_nationkey")
    return joined.select(
        "c_custkey",
        F.col("c_mktsegment").alias("payment_method_type"),
        "country",
        (F.col("c_nationkey") % 3).alias("rebill_period_in_months"),
        F.floor(F.col("c_acctbal") / 100).cast("int").alias("age"),
        "firstSub",
        "last_month_views",
        "all_time_views",
        "next_month_views",
        (F.col("c_acctbal") < 1000).alias("is_cancelled"),
    )


ACTIVITY_SQL = """
SELECT c_custkey, c_mktsegment AS payment_method_type, n_name AS country, c_nationkey % 3 AS rebill_period_in_months,
       CAST(floor(c_acctbal / 100) AS INTEGER) AS age, CAST(firstSub AS BIGINT) AS firstSub,
       CAST(last_month_views AS BIGINT) AS last_month_views, CAST(all_time_views AS BIGINT) AS all_time_views,
       CAST(next_month_views AS BIGINT) AS next_month_views, c_acctbal < 1000 AS is_cancelled
FROM customer
LEFT JOIN (SELECT o_custkey,
                  sum(CASE WHEN o_orderdate < first_month + INTERVAL 6 MONTH THEN 1 END) AS firstSub,
                  sum(CASE WHEN o_orderdate >= last_month - INTERVAL 2 MONTH AND o_orderdate < last_month - INTERVAL 1 MONTH THEN 1 END) AS last_month_views,
                  sum(CASE WHEN o_orderdate < last_month - INTERVAL 1 MONTH THEN 1 END) AS all_time_views,
                  sum(CASE WHEN o_orderdate >= last_month - INTERVAL 1 MONTH AND o_orderdate < last_month THEN 1 END) AS next_month_views
           FROM orders, (SELECT date_trunc('month', min(o_orderdate)) AS first_month, date_trunc('month', max(o_orderdate)) AS last_month FROM orders)
           GROUP BY o_custkey) ON o_custkey = c_custkey
JOIN nation ON n_nationkey = c_nationkey
"""


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, part and the bought quantity as a share of 100."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, "o_orderkey")
        .groupBy(F.col("o_custkey").cast("int").alias("userId"), F.col("l_partkey").cast("int").alias("courseId"))
        .agg((F.sum("l_quantity") / 100).alias("proportionWatched"))
    )


COURSES_SQL = """
SELECT CAST(o_custkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS courseId, sum(l_quantity) / 100 AS proportionWatched
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey
"""


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User name, searched item and how often."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("username"),
            F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("indicatorId"),
        )
        .agg(F.count("*").alias("count"))
    )


SEARCHES_SQL = r"""
SELECT 'user-' || CAST(user_id AS VARCHAR) AS username, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS indicatorId,
       count(*) AS "count"
FROM events GROUP BY 1, 2
"""


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as named indicators; unit, subgroup and form are partly missing."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("indicatorNid"),
        F.concat(F.lit("Number of "), "p_name", F.lit(" "), "p_type").alias("indicatorName"),
        F.when(size <= 40, F.lit("number")).when(size <= 45, F.lit("percent")).alias("unit"),
        F.when(F.col("p_brand") != "Brand#1", F.col("p_type")).alias("subgroup"),
        F.when(size % 2 == 0, size).alias("formId"),
        F.when(F.col("p_brand") != "Brand#2", F.col("p_brand")).alias("numerator"),
    )


INDICATORS_SQL = """
SELECT p_partkey AS indicatorNid, 'Number of ' || p_name || ' ' || p_type AS indicatorName,
       CASE WHEN p_size <= 40 THEN 'number' WHEN p_size <= 45 THEN 'percent' END AS unit,
       CASE WHEN p_brand <> 'Brand#1' THEN p_type END AS subgroup, CASE WHEN p_size % 2 = 0 THEN p_size END AS formId,
       CASE WHEN p_brand <> 'Brand#2' THEN p_brand END AS numerator
FROM part
"""


def scaled(embedding: str = "embedding") -> Column:
    """Vector values as whole numbers 0..254."""
    return F.transform(embedding, lambda e: F.round((e.cast("double") + 1) * 127).cast("int"))


def pixel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name, label, pixels)`` of every vector."""
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("scan,"), F.col("vec_id").cast("string"), F.lit(".png")).alias("name"), "label", scaled().alias("pixels")
    )


PIXELS_SQL = """
SELECT vec_id, 'scan,' || CAST(vec_id AS VARCHAR) || '.png' AS name, label,
       [CAST(round((CAST(e AS DOUBLE) + 1) * 127) AS INTEGER) FOR e IN embedding] AS pixels
FROM embeddings
"""


def is_training(name: str = "name") -> Column:
    """Which pixel rows train: by the number at the end of the name."""
    return F.regexp_extract(name, r"(\d+)\.\w+$", 1).cast("long") % 5 != 0


def vector_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as an 8x8 colour image: blue is the value, green and red the next two."""
    hex_byte = lambda v: F.lpad(F.hex(v), 2, "0")
    triple = lambda i: F.concat(*[hex_byte(F.get("p", (i + F.lit(d)) % F.lit(VECTOR_WIDTH))) for d in range(3)])
    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(VECTOR_WIDTH - 1)), triple), ""))
    origin = F.concat(F.lit("/images/"), F.col("label").cast("string"), F.lit("/"), F.col("vec_id").cast("string"), F.lit(".bmp"))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", scaled().alias("p")).select(
        "vec_id",
        "label",
        F.struct(
            origin.alias("origin"),
            F.lit(8).alias("height"),
            F.lit(8).alias("width"),
            F.lit(3).alias("nChannels"),
            F.lit(16).alias("mode"),
            data.alias("data"),
        ).alias("image"),
    )


# One row per pixel of vector_images: x runs right, y down.
VECTOR_IMAGES_SQL = f"""
SELECT vec_id, label, i % 8 AS x, i // 8 AS y, pixels[i + 1] AS b,
       pixels[(i + 1) % {VECTOR_WIDTH} + 1] AS g, pixels[(i + 2) % {VECTOR_WIDTH} + 1] AS r
FROM (SELECT vec_id, label, pixels, unnest(range({VECTOR_WIDTH})) AS i FROM ({PIXELS_SQL}))
"""


def _little_endian(value: Column) -> Column:
    """Four-byte little-endian hex of a number below 65,536."""
    text = F.lpad(F.hex(value), 4, "0")
    return F.concat(F.substring(text, 3, 2), F.substring(text, 1, 2), F.lit("0000"))


_FOLDERS: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    """The folder ``write`` fills, made once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _FOLDERS:
        path = scratch_path(spark, kind)
        write(path)
        _FOLDERS[key] = path
    return _FOLDERS[key]


def image_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of BMP files made from the vectors, 16 vectors to an image.

    Below it lie ``label=0``, ``label=1`` and ``label=9``; the files of label 9
    (every image whose number ends in 9) are broken on purpose.
    """

    def write(path: str) -> None:
        hex_pixel = lambda v: F.repeat(F.lpad(F.hex(v), 2, "0"), 3)
        rows = table(spark, sf_dir, "embeddings").select(
            F.expr(f"vec_id div {ROWS_PER_IMAGE}").alias("image_id"),
            "vec_id",
            F.array_join(F.transform(scaled(), hex_pixel), "").alias("line"),
        )
        images = rows.groupBy("image_id").agg(F.collect_list(F.struct("vec_id", "line")).alias("rows"))
        # A BMP file starts with the bottom line.
        height = F.size("rows")
        body = F.array_join(F.transform(F.reverse(F.array_sort("rows")), lambda r: r["line"]), "")
        size = height * F.lit(VECTOR_WIDTH * 3)
        head = F.concat(
            F.when(F.col("image_id") % 10 == 9, F.lit("FFFF")).otherwise(F.lit("424D")),
            _little_endian(size + 54),
            F.lit("00000000" + "36000000" + "28000000"),
            _little_endian(F.lit(VECTOR_WIDTH)),
            _little_endian(height),
            F.lit("0100" + "1800" + "00000000"),
            _little_endian(size),
            F.lit("00" * 16),
        )
        label = F.when(F.col("image_id") % 10 == 9, F.lit(9)).otherwise((F.col("image_id") % 2).cast("int"))
        files = images.select(
            label.alias("label"), "image_id", F.unhex(F.concat(head, body)).cast("string").alias("value")
        )
        files.write.partitionBy("label", "image_id").text(path)

    return _once(spark, sf_dir, "images", write)


# One row per pixel of the decodable files of image_folder.
IMAGE_FILES_SQL = f"""
SELECT vec_id // {ROWS_PER_IMAGE} AS image_id, CAST((vec_id // {ROWS_PER_IMAGE}) % 2 AS INTEGER) AS label,
       CAST(vec_id % {ROWS_PER_IMAGE} AS INTEGER) AS y, i AS x, pixels[i + 1] AS v
FROM (SELECT vec_id, pixels, unnest(range({VECTOR_WIDTH})) AS i FROM ({PIXELS_SQL}))
WHERE (vec_id // {ROWS_PER_IMAGE}) % 10 <> 9
"""


def image_number(path: str = "image.origin") -> Column:
    return F.regexp_extract(path, r"image_id=(\d+)", 1).cast("long")


def pixel_line_folder(spark: SparkSession, sf_dir: str) -> str:
    """Pixel lines of all vectors, with doubled blanks after every 8 values."""
    return _once(spark, sf_dir, "lines", lambda path: write_pixel_lines(pixel_rows(spark, sf_dir), path, height=8))


def csv_folder(spark: SparkSession, sf_dir: str, name: str, files: int | None = None) -> str:
    """A given table as CSV files with headers."""
    from plumbline.sources.tables import write_csv_table

    def write(path: str) -> None:
        df = table(spark, sf_dir, name)
        write_csv_table(df.repartition(files) if files else df, path)

    return _once(spark, sf_dir, f"csv-{name}-{files or 0}", write)
