"""Queries of the readers, writers and relational operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog import inputs as src
from plumbline.catalog.registry import query
from plumbline.functions.categories import group_category, register_category_udf
from plumbline.functions.encoding import drop_invalid_categories
from plumbline.operators import aggregates, columns, joins, splits, topk
from plumbline.session import scratch_path
from plumbline.sources import pixel_lines, tables


def union_sql(parts, frame="", name="t"):
    """The parts joined by UNION ALL over a named frame."""
    return (f"WITH {name} AS ({frame}) " if frame else "") + " UNION ALL ".join(parts)


ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


# ---- sources and sinks


@query("S1 K1", f"SELECT {ORDER_COLUMNS} FROM orders")
def read_csv_table(spark, sf_dir):
    df = tables.read_csv_table(spark, src.csv_folder(spark, sf_dir, "orders"))
    return df.select(
        F.col("o_orderkey").cast("long"),
        F.col("o_custkey").cast("long"),
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
    )


@query("S2 S1", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def read_csv_glob(spark, sf_dir):
    path = src.csv_folder(spark, sf_dir, "customer", files=4) + "/*.csv"
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return tables.read_csv_table(spark, path, schema)


@query("S3", "SELECT user_id, event_type, value FROM events")
def read_interactions(spark, sf_dir):
    return tables.read_interactions(
        spark, f"{sf_dir}/events.parquet", "parquet", columns=("user_id", "event_type", "value")
    )


@query("S4 K2", f"SELECT name, label, array_to_string(pixels, ' ') AS pixels FROM ({src.PIXELS_SQL})")
def read_pixel_lines(spark, sf_dir):
    df = pixel_lines.read_pixel_lines(spark, src.pixel_line_folder(spark, sf_dir))
    return df.select("name", "label", pixel_lines.pixel_text(F.col("pixels")).alias("pixels"))


@query(
    "S4 E6",
    f"""SELECT 'scan' AS name, CAST(substr(CAST(vec_id AS VARCHAR), 1, 1) AS INTEGER) AS label,
               array_to_string(pixels, ' ') || repeat(' 0', 7) AS pixels
        FROM ({src.PIXELS_SQL})""",
)
def read_pixel_lines_legacy(spark, sf_dir):
    """The literal reading: the name ends at the first comma, one-character labels, padded pixels."""
    df = pixel_lines.read_pixel_lines(spark, src.pixel_line_folder(spark, sf_dir), legacy=True)
    return df.select("name", "label", pixel_lines.pixel_text(F.col("pixels")).alias("pixels"))


@query(
    "S6 J1",
    """SELECT r_name, CASE WHEN r_regionkey < 2 THEN 'west' ELSE 'east' END AS side, count(*) AS customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def frame_from_rows(spark, sf_dir):
    rows = [(0, "west"), (1, "west"), (2, "east"), (3, "east"), (4, "east")]
    sides = tables.frame_from_rows(spark, rows, "r_regionkey int, side string")
    per_nation = src.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    nation = src.table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = src.table(spark, sf_dir, "region").join(sides, "r_regionkey")
    joined = per_nation.join(nation, "c_nationkey").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name", "side").agg(F.sum("n").alias("customers"))


@query("K1", f"SELECT c_custkey, country, payments_made, access_count FROM ({src.TRIALS_SQL})")
def write_csv_table(spark, sf_dir):
    path = scratch_path(spark, "trials-csv")
    trials = src.trials(spark, sf_dir).select("c_custkey", "country", "payments_made", "access_count")
    tables.write_csv_table(trials, path)
    return tables.read_csv_table(spark, path, trials.schema)


@query(
    "K2",
    f"""SELECT label, name || ',' || label || ',' || array_to_string(pixels, ' ') AS value FROM ({src.PIXELS_SQL})""",
)
def write_pixel_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    pixel_lines.write_pixel_lines(src.pixel_rows(spark, sf_dir), path)
    return spark.read.text(path).select("label", "value")


@query("K2 S4", f"SELECT name, label, array_to_string(pixels, ' ') AS pixels FROM ({src.PIXELS_SQL})")
def append_pixel_lines(spark, sf_dir):
    """Two runs added to one folder, one of them twice: each line is there once."""
    path = scratch_path(spark, "appended")
    rows = src.pixel_rows(spark, sf_dir)
    for run, part in (("training", src.is_training()), ("holdout", ~src.is_training()), ("training", src.is_training())):
        pixel_lines.append_pixel_lines(rows.where(part), path, run)
    return pixel_lines.read_pixel_lines(spark, path).withColumn("pixels", F.array_join("pixels", " "))


# ---- columns


@query("P1", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def select_columns(spark, sf_dir):
    return columns.select_columns(src.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@query(
    "P2",
    r"SELECT doc_id, upper(source) AS source, regexp_split_to_array(text, ' ')[3] AS third_word FROM documents",
)
def select_exprs(spark, sf_dir):
    return columns.select_exprs(
        src.table(spark, sf_dir, "documents"),
        ["doc_id", "upper(source) AS source", "get(split(text, ' '), 2) AS third_word"],
    )


@query("P3", "SELECT l_orderkey, l_linenumber, l_extendedprice AS label FROM lineitem")
def rename_column(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return columns.rename_column(df, "l_extendedprice", "label")


@query("P4", "SELECT p_partkey, p_name, p_retailprice FROM part")
def drop_columns(spark, sf_dir):
    return columns.drop_columns(src.table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size", "not_there"])


@query("P5", "SELECT l_orderkey, l_linenumber, round(l_tax / nullif(l_discount, 0), 6) AS ratio FROM lineitem")
def ratio_column(spark, sf_dir):
    df = columns.ratio_column(src.table(spark, sf_dir, "lineitem"), "l_tax", "l_discount", "ratio")
    return df.select("l_orderkey", "l_linenumber", F.round("ratio", 6).alias("ratio"))


@query("P6", f"SELECT userId, courseId, round(proportionWatched * 100, 6) AS proportionWatched FROM ({src.COURSES_SQL})")
def scale_column(spark, sf_dir):
    df = columns.scale_column(src.courses(spark, sf_dir), "proportionWatched", 100)
    return df.withColumn("proportionWatched", F.round("proportionWatched", 6))


VIEWS = ["firstSub", "last_month_views", "all_time_views", "next_month_views"]


@query(
    "P7",
    "SELECT c_custkey, " + ", ".join(f"coalesce({c}, 0) AS {c}_cleaned" for c in VIEWS) + f" FROM ({src.ACTIVITY_SQL})",
)
def null_to_zero(spark, sf_dir):
    df = columns.null_to_zero(src.activity(spark, sf_dir), VIEWS)
    return df.select("c_custkey", *[f"{c}_cleaned" for c in VIEWS])


@query(
    "P7",
    f"SELECT indicatorNid, coalesce(formId, 0) AS formId, coalesce(numerator, '0') AS numerator FROM ({src.INDICATORS_SQL})",
)
def null_to_zero_in_place(spark, sf_dir):
    df = columns.null_to_zero(src.indicators(spark, sf_dir), ["formId", "numerator"], suffix="")
    return df.select("indicatorNid", "formId", "numerator")


@query(
    "P8",
    f"""SELECT c_custkey, CASE WHEN payments_made >= 1 THEN 1 ELSE 0 END AS label FROM ({src.TRIALS_SQL})""",
)
def threshold_label(spark, sf_dir):
    df = columns.threshold_label(src.trials(spark, sf_dir), "payments_made", ">=", 1)
    return df.select("c_custkey", "label")


@query(
    "P8",
    f"""SELECT c_custkey, CASE WHEN next_month_views > 0 THEN 0 ELSE 1 END AS label FROM ({src.ACTIVITY_SQL})""",
)
def threshold_label_inverted(spark, sf_dir):
    df = columns.threshold_label(src.activity(spark, sf_dir), "next_month_views", ">", 0, if_true=0, if_false=1)
    return df.select("c_custkey", "label")


@query("P9", "SELECT vec_id, 1 AS class_label FROM embeddings")
def constant_column(spark, sf_dir):
    return columns.constant_column(src.table(spark, sf_dir, "embeddings").select("vec_id"), "class_label", 1)


@query("P10", "SELECT doc_id, lower(text) AS text FROM documents")
def lowercase_column(spark, sf_dir):
    return columns.lowercase_column(src.table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query("P11", r"SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)', 1), '') AS first FROM pages")
def first_element(spark, sf_dir):
    titles = F.filter(F.expr(r"regexp_extract_all(html, '<title>([^<]*)', 1)"), lambda t: t != "")
    df = src.table(spark, sf_dir, "pages").select("page_id", titles.alias("titles"))
    return columns.first_element(df, "titles", "first").select("page_id", "first")


NATION_GROUP_SQL = """CASE WHEN n_name IN ('NATION_0', 'NATION_1', 'NATION_2') THEN n_name
  WHEN CAST(substr(n_name, 8) AS INTEGER) BETWEEN 3 AND 10 THEN 'EUROPE' ELSE 'OTHER' END"""


@query(
    "P12",
    f"SELECT c_custkey, {NATION_GROUP_SQL} AS grouped FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def group_categories(spark, sf_dir):
    df = group_category(src.trials(spark, sf_dir), "country", src.NATION_GROUPS, src.KEEP_NATIONS, out="grouped")
    return df.select("c_custkey", "grouped")


@query(
    "UD1",
    f"SELECT c_custkey, {NATION_GROUP_SQL} AS grouped FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def registered_category_udf(spark, sf_dir):
    register_category_udf(spark, "nation_grouping", src.NATION_GROUPS, src.KEEP_NATIONS)
    return src.trials(spark, sf_dir).selectExpr("c_custkey", "nation_grouping(country) AS grouped")


@query("P13", "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages")
def file_basename(spark, sf_dir):
    return columns.file_basename(src.table(spark, sf_dir, "pages"), "url", "name").select("page_id", "name")


@query(
    "P14",
    """SELECT l_orderkey, l_linenumber, CAST(trunc(l_discount * 100) AS INTEGER) = CAST(trunc(l_quantity) AS INTEGER) AS agrees
       FROM lineitem""",
)
def cast_to_int_equal(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem")
    same = columns.cast_to_int_equal(F.col("l_discount") * 100, "l_quantity")
    return df.select("l_orderkey", "l_linenumber", same.alias("agrees"))


# ---- filters


@query("F1", f"SELECT c_custkey, age, is_cancelled FROM ({src.ACTIVITY_SQL}) WHERE is_cancelled = false")
def filter_expr(spark, sf_dir):
    df = columns.filter_expr(src.activity(spark, sf_dir), "is_cancelled = false")
    return df.select("c_custkey", "age", "is_cancelled")


@query(
    "F2",
    f"""SELECT indicatorNid, unit, subgroup, numerator FROM ({src.INDICATORS_SQL})
        WHERE subgroup IS NOT NULL AND unit IS NOT NULL AND unit = 'number' AND numerator IS NOT NULL""",
)
def require_columns(spark, sf_dir):
    df = columns.require_columns(
        src.indicators(spark, sf_dir), ["subgroup", "unit", "numerator"], {"unit": "number"}
    )
    return df.select("indicatorNid", "unit", "subgroup", "numerator")


@query("F3", "SELECT doc_id, quality, toxic FROM labels WHERE quality = toxic")
def matching_predictions(spark, sf_dir):
    return columns.matching_predictions(src.table(spark, sf_dir, "labels"), "toxic", "quality")


@query(
    "F4",
    f"""WITH i AS ({src.INDICATORS_SQL}),
        r AS (SELECT numerator, row_number() OVER (ORDER BY count(*) DESC, numerator) - 1 AS idx
              FROM i WHERE numerator IS NOT NULL GROUP BY numerator)
        SELECT indicatorNid, CAST(idx AS DOUBLE) AS numerator_index FROM i JOIN r USING (numerator)""",
)
def drop_invalid_category_rows(spark, sf_dir):
    df = src.indicators(spark, sf_dir).select("indicatorNid", "numerator")
    return drop_invalid_categories(df, ["numerator"], ["numerator_index"]).select("indicatorNid", "numerator_index")


# ---- joins


@query(
    "J1 A9",
    """SELECT 'user-' || CAST(user_id AS VARCHAR) AS username, n_items, total FROM
       (SELECT user_id, count(DISTINCT event_type) AS n_items, round(sum(value), 2) AS total FROM events GROUP BY user_id)""",
)
def attach_user_names(spark, sf_dir):
    events = src.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("userId"), F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("username"), "event_type", "value"
    )
    recs = events.groupBy("userId").agg(
        F.count_distinct("event_type").alias("n_items"), F.round(F.sum("value"), 2).alias("total")
    )
    return joins.attach_user_names(recs, events).select("username", "n_items", "total")


@query(
    "J1",
    """SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def lookup_join(spark, sf_dir):
    part = src.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = src.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.lookup_join(lines, part, "l_partkey").select("l_orderkey", "l_linenumber", "p_name")


# ---- aggregates


@query("A1", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return aggregates.row_count(src.table(spark, sf_dir, "lineitem"))


@query("A2", 'SELECT l_linenumber AS prediction, count(*) AS "count" FROM lineitem GROUP BY 1')
def cluster_sizes(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "prediction")
    return aggregates.cluster_sizes(df)


@query("A3", 'SELECT quality AS label, toxic AS prediction, count(*) AS "count" FROM labels GROUP BY 1, 2')
def confusion_counts(spark, sf_dir):
    df = src.table(spark, sf_dir, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    return aggregates.confusion_counts(df)


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "A4",
    "SELECT user_id, "
    + ", ".join(f"round(sum(CASE WHEN event_type = '{t}' THEN value END), 2) AS {t}" for t in EVENT_TYPES)
    + " FROM events GROUP BY user_id",
)
def interaction_matrix(spark, sf_dir):
    df = src.table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    wide = aggregates.interaction_matrix(df, "user_id", "event_type", "value")
    return wide.select("user_id", *[F.round(t, 2).alias(t) for t in EVENT_TYPES])


@query("A4", "SELECT user_id, event_type, round(sum(value), 2) AS value FROM events GROUP BY 1, 2")
def interaction_totals(spark, sf_dir):
    totals = aggregates.interaction_totals(src.table(spark, sf_dir, "events"), "user_id", "event_type", "value")
    return totals.withColumn("value", F.round("value", 2))


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(cols, relation):
    parts = []
    for c in cols:
        for stat, fn in [("count", "count"), ("mean", "avg"), ("stddev", "stddev"), ("min", "min"), ("max", "max")]:
            parts.append(f"SELECT '{c}' AS \"column\", '{stat}' AS stat, round(CAST({fn}({c}) AS DOUBLE), 4) AS value FROM {relation}")
    return union_sql(parts)


@query("A5", _describe_sql(LINE_NUMBERS, "lineitem"))
def describe_long(spark, sf_dir):
    df = aggregates.describe_long(src.table(spark, sf_dir, "lineitem"), LINE_NUMBERS)
    return df.withColumn("value", F.round("value", 4))


@query(
    "A5",
    union_sql(
        f"SELECT '{stat}' AS summary, round(CAST({fn}(p_size) AS DOUBLE), 4) AS p_size, round(CAST({fn}(p_retailprice) AS DOUBLE), 4) AS p_retailprice FROM part"
        for stat, fn in [("count", "count"), ("mean", "avg"), ("stddev", "stddev"), ("min", "min"), ("max", "max")]
    ),
)
def describe_table(spark, sf_dir):
    df = aggregates.describe_table(src.table(spark, sf_dir, "part").select("p_size", "p_retailprice"))
    return df.select("summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ["p_size", "p_retailprice"]])


HOUSE_NUMBERS = ["price", "quantity", "discount", "tax", "size", "retail"]


@query(
    "A6",
    union_sql(
        (f"SELECT '{c}' AS \"column\", round(corr({c}, price), 6) AS correlation FROM t" for c in HOUSE_NUMBERS),
        src.HOUSES_SQL,
    ),
)
def label_correlations(spark, sf_dir):
    df = aggregates.label_correlations(src.houses(spark, sf_dir), "price", HOUSE_NUMBERS)
    return df.withColumn("correlation", F.round("correlation", 6))


@query(
    "A6",
    union_sql(
        (
            f"SELECT '{c}' AS \"column\", round(corr(coalesce({c}, 0), coalesce(next_month_views, 0)), 6) AS correlation FROM t"
            for c in VIEWS
        ),
        src.ACTIVITY_SQL,
    ),
)
def label_correlations_null_as_zero(spark, sf_dir):
    df = aggregates.label_correlations(src.activity(spark, sf_dir), "next_month_views", VIEWS, null_as_zero=True)
    return df.withColumn("correlation", F.round("correlation", 6))


@query(
    "A7",
    union_sql(
        (
            f"SELECT '{a}' AS \"column\", '{b}' AS other, round(corr({a}, {b}), 6) AS correlation FROM t"
            for a in HOUSE_NUMBERS
            for b in HOUSE_NUMBERS
        ),
        src.HOUSES_SQL,
    ),
)
def correlation_matrix(spark, sf_dir):
    df = aggregates.correlation_matrix(src.houses(spark, sf_dir), HOUSE_NUMBERS)
    return df.withColumn("correlation", F.round("correlation", 6))


@query(
    "A8",
    f"SELECT c_custkey, access_count, round(amount, 2) AS amount FROM ({src.TRIALS_SQL})",
)
def drop_low_correlation(spark, sf_dir):
    """Orders and their sum move together; the segment's name length does not and goes."""
    trials = src.trials(spark, sf_dir).select("c_custkey", "access_count", "amount", "rebill_period")
    cols = ["access_count", "amount", "rebill_period"]
    kept = aggregates.drop_low_correlation(trials, "amount", 0.5, cols)
    return kept.withColumn("amount", F.round("amount", 2))


@query("A9", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return aggregates.distinct_rows(src.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"))


# ---- unions and splits


@query(
    "U1",
    """SELECT c_custkey AS id, c_acctbal AS balance, 1 AS label FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, 0 FROM supplier""",
)
def union_all(spark, sf_dir):
    customers = src.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    suppliers = src.table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return splits.union_all(
        columns.constant_column(customers, "label", 1), columns.constant_column(suppliers, "label", 0)
    )


@query("U2", "SELECT o_orderkey, o_totalprice FROM orders")
def random_holdout(spark, sf_dir):
    """The parts of a random split put together again: nothing is lost or doubled."""
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    training, holdout = splits.random_holdout(orders, (0.8, 0.2), seed=7)
    return splits.union_all(training, holdout)


@query("U2", "SELECT count(*) AS n, true AS share_is_near, true AS apart FROM orders")
def random_holdout_shares(spark, sf_dir):
    """Whether the training share lies within five standard deviations of 0.8, and no key is in both parts."""
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey")
    training, holdout = splits.random_holdout(orders, (0.8, 0.2), seed=7)
    both = splits.union_all(columns.constant_column(training, "part", 1), columns.constant_column(holdout, "part", 0))
    keys = both.groupBy("o_orderkey").agg(F.countDistinct("part").alias("parts"), F.count("*").alias("n"), F.sum("part").alias("in_training"))
    near = F.abs(F.sum("in_training") - 0.8 * F.sum("n")) <= 5 * F.sqrt(0.16 * F.sum("n"))
    return keys.agg(F.sum("n").alias("n"), near.alias("share_is_near"), (F.max("parts") == 1).alias("apart"))


@query(
    "U3",
    f"""WITH k AS (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey * 100 END AS key FROM orders),
        b AS (SELECT key, {src.bucket_sql('key')} < 80 AS is_training FROM k)
        SELECT is_training, count(*) AS n, count(*) - count(key) AS without_key FROM b GROUP BY is_training""",
)
def holdout_with_null_keys(spark, sf_dir):
    """A third of the keys are null and the others are a hundred apart: every row is in one part."""
    key = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") * 100).alias("key")
    training, holdout = splits.key_holdout(src.table(spark, sf_dir, "orders").select(key), "key", 80)
    both = splits.union_all(columns.constant_column(training, "is_training", True), columns.constant_column(holdout, "is_training", False))
    return both.groupBy("is_training").agg(F.count("*").alias("n"), (F.count("*") - F.count("key")).alias("without_key"))


@query(
    "U3",
    f"SELECT o_orderkey, {src.bucket_sql('o_orderkey')} < 80 AS is_training FROM orders",
)
def key_holdout(spark, sf_dir):
    training, holdout = splits.key_holdout(src.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 80)
    return splits.union_all(
        columns.constant_column(training, "is_training", True), columns.constant_column(holdout, "is_training", False)
    )


@query(
    "U4",
    f"""SELECT vec_id, label, {src.bucket_sql('vec_id')} < (CASE WHEN label < 5 THEN 90 ELSE 60 END) AS is_training
       FROM embeddings""",
)
def stratified_holdout(spark, sf_dir):
    df = src.table(spark, sf_dir, "embeddings").select("vec_id", "label")
    shares = {label: 90 if label < 5 else 60 for label in range(10)}
    training, holdout = splits.stratified_holdout(df, "label", shares, "vec_id")
    return splits.union_all(
        columns.constant_column(training, "is_training", True), columns.constant_column(holdout, "is_training", False)
    )


# ---- top-k


@query("L1", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def preview(spark, sf_dir):
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return topk.preview(orders, 20, [F.desc("o_totalprice"), "o_orderkey"])


@query(
    "L4",
    f"""SELECT vec_id, CAST(i AS INTEGER) AS rank, pixels[i] AS itemId FROM
        (SELECT vec_id, pixels, unnest(range(1, {src.VECTOR_WIDTH + 1})) AS i FROM ({src.PIXELS_SQL}))""",
)
def explode_recommendations(spark, sf_dir):
    items = F.transform(src.scaled(), lambda p: F.struct(p.alias("itemId")))
    recs = src.table(spark, sf_dir, "embeddings").select("vec_id", items.alias("recommendations"))
    return topk.explode_recommendations(recs, "vec_id")


@query(
    "L5",
    """SELECT CAST(l_partkey AS VARCHAR) AS value, count(*) AS n,
              row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) AS rank
       FROM lineitem GROUP BY l_partkey""",
)
def index_order_rank(spark, sf_dir):
    return topk.index_order_rank(src.table(spark, sf_dir, "lineitem"), "l_partkey")
