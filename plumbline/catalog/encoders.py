"""Queries of the text operators and feature encoders."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.catalog import inputs as src
from plumbline.catalog.registry import query
from plumbline.catalog.relational import union_sql
from plumbline.functions import encoding, text
from plumbline.operators.topk import index_order_rank
from plumbline.sources.pixel_lines import labeled_points as points_of

# The tokenizer keeps leading and inner empty tokens and drops trailing ones.
TOKENS_SQL = r"""SELECT doc_id, CASE WHEN regexp_replace(text, '\s+$', '') = '' THEN ['']
  ELSE regexp_split_to_array(lower(regexp_replace(text, '\s+$', '')), '\s') END AS tokens FROM documents"""
STOP_SQL = ", ".join("'" + w + "'" for w in text.INDICATOR_STOP_WORDS)
KEPT_SQL = f"SELECT doc_id, [t FOR t IN tokens IF t NOT IN ({STOP_SQL})] AS kept FROM ({TOKENS_SQL})"
TRIGRAM_SQL = "[kept[i] || ' ' || kept[i + 1] || ' ' || kept[i + 2] FOR i IN range(1, len(kept) - 1)]"


def documents(spark, sf_dir):
    return src.table(spark, sf_dir, "documents").select("doc_id", "text")


@query("X1", f"SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n, array_to_string(tokens, '|') AS tokens FROM ({TOKENS_SQL})")
def tokenize(spark, sf_dir):
    df = text.tokenize(documents(spark, sf_dir), "text", "tokens")
    return df.select("doc_id", F.size("tokens").alias("n"), F.array_join("tokens", "|").alias("tokens"))


@query("X2", f"SELECT doc_id, CAST(len(kept) AS INTEGER) AS n, array_to_string(kept, '|') AS kept FROM ({KEPT_SQL})")
def remove_stop_words(spark, sf_dir):
    df = text.remove_stop_words(text.tokenize(documents(spark, sf_dir), "text", "tokens"), "tokens", out="kept")
    return df.select("doc_id", F.size("kept").alias("n"), F.array_join("kept", "|").alias("kept"))


@query(
    "X3",
    f"""SELECT doc_id, CAST(len(grams) AS INTEGER) AS n, array_to_string(grams, '|') AS grams
        FROM (SELECT doc_id, {TRIGRAM_SQL} AS grams FROM ({KEPT_SQL}))""",
)
def ngrams(spark, sf_dir):
    kept = text.remove_stop_words(text.tokenize(documents(spark, sf_dir), "text", "tokens"), "tokens", out="kept")
    df = text.ngrams(kept, "kept", 3, "grams")
    return df.select("doc_id", F.size("grams").alias("n"), F.array_join("grams", "|").alias("grams"))


@query("X4 P11", f"SELECT doc_id, ({TRIGRAM_SQL})[1] AS leading_ngram FROM ({KEPT_SQL})")
def leading_ngram(spark, sf_dir):
    return text.leading_ngram(documents(spark, sf_dir), "text").select("doc_id", "leading_ngram")


def index_sql(frame, col, name):
    """The frequency index of a column as a named subquery."""
    return f"""{name} AS (SELECT CAST({col} AS VARCHAR) AS value,
        row_number() OVER (ORDER BY count(*) DESC, CAST({col} AS VARCHAR)) - 1 AS idx FROM {frame} GROUP BY {col})"""


@query(
    "E1",
    f"""WITH h AS ({src.HOUSES_SQL}), {index_sql('h', 'brand', 'b')}, {index_sql('h', 'returnflag', 'r')}, {index_sql('h', 'size', 's')}
        SELECT l_orderkey, l_linenumber, CAST(b.idx AS DOUBLE) AS brand_index, CAST(r.idx AS DOUBLE) AS flag_index,
               CAST(s.idx AS DOUBLE) AS size_index
        FROM h JOIN b ON b.value = brand JOIN r ON r.value = returnflag JOIN s ON s.value = CAST(size AS VARCHAR)""",
)
def index_strings(spark, sf_dir):
    outs = ["brand_index", "flag_index", "size_index"]
    df = encoding.index_strings(src.houses(spark, sf_dir), ["brand", "returnflag", "size"], outs)
    return df.select("l_orderkey", "l_linenumber", *outs)


@query(
    "E1",
    f"""WITH {index_sql('lineitem', 'l_partkey', 'p')}
        SELECT l_orderkey, l_linenumber, CAST(idx AS DOUBLE) AS part_index
        FROM lineitem JOIN p ON value = CAST(l_partkey AS VARCHAR)""",
)
def index_many_strings(spark, sf_dir):
    """A column with as many values as there are parts: a join with the distributed rank table."""
    df = src.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    indexed = encoding.index_strings(df, ["l_partkey"], ["part_index"])
    return indexed.select("l_orderkey", "l_linenumber", "part_index")


@query(
    "E2",
    f"""WITH s AS ({src.SEARCHES_SQL}), {index_sql('s', 'username', 'u')}
        SELECT username, indicatorId, CAST(idx AS INTEGER) AS userId FROM s JOIN u ON value = username""",
)
def index_users(spark, sf_dir):
    return encoding.index_users(src.searches(spark, sf_dir)).select("username", "indicatorId", "userId")


def one_hot_sql(idx, size):
    return f"array_to_string([CASE WHEN i = {idx} THEN '1' ELSE '0' END FOR i IN range({size} - 1)], '')"


@query(
    "E3",
    f"""WITH {index_sql('lineitem', 'l_returnflag', 'f')}, {index_sql('lineitem', 'l_linenumber', 'n')}
        SELECT l_orderkey, l_linenumber, {one_hot_sql('f.idx', '(SELECT count(*) FROM f)')} AS flag_vector,
               {one_hot_sql('n.idx', '(SELECT count(*) FROM n)')} AS number_vector
        FROM lineitem JOIN f ON f.value = l_returnflag JOIN n ON n.value = CAST(l_linenumber AS VARCHAR)""",
)
def one_hot(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    df = encoding.index_strings(df, ["l_returnflag", "l_linenumber"], ["flag_index", "number_index"])
    df = encoding.one_hot(df, ["flag_index", "number_index"], ["flag_vector", "number_vector"])
    digits = lambda v: F.array_join(F.transform(vector_to_array(v), lambda x: x.cast("int").cast("string")), "")
    return df.select(
        "l_orderkey", "l_linenumber", digits("flag_vector").alias("flag_vector"), digits("number_vector").alias("number_vector")
    )


@query(
    "E4",
    union_sql(
        (
            f"SELECT l_orderkey, l_linenumber, {i} AS position, round(CAST({c} AS DOUBLE), 6) AS value FROM lineitem"
            for i, c in enumerate(["l_quantity", "l_extendedprice", "l_linenumber"])
        )
    ),
)
def assemble(spark, sf_dir):
    df = encoding.assemble(src.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"])
    df = df.select("l_orderkey", "l_linenumber", F.posexplode_outer(vector_to_array("features")).alias("position", "value"))
    return df.withColumn("value", F.round("value", 6))


@query(
    "E5",
    f"""WITH h AS ({src.HOUSES_SQL}), {index_sql('h', 'linestatus', 's')}, {index_sql('h', 'returnflag', 'f')}
        SELECT CAST(idx AS INTEGER) AS position, CAST(count(*) AS DOUBLE) AS total FROM h JOIN s ON value = linestatus GROUP BY idx
        UNION ALL SELECT CAST(idx + (SELECT count(*) FROM s) AS INTEGER), CAST(count(*) AS DOUBLE) FROM h JOIN f ON value = returnflag GROUP BY idx
        UNION ALL SELECT CAST((SELECT count(*) FROM s) + (SELECT count(*) FROM f) AS INTEGER), round(sum(quantity), 2) FROM h
        UNION ALL SELECT CAST((SELECT count(*) FROM s) + (SELECT count(*) FROM f) + 1 AS INTEGER), CAST(sum(size) AS DOUBLE) FROM h""",
)
def feature_stages(spark, sf_dir):
    """Column sums of the vectors that the fitted stages give."""
    df = src.houses(spark, sf_dir)
    fitted = encoding.feature_stages(["linestatus", "returnflag"], ["quantity", "size"]).fit(df)
    values = fitted.transform(df).select(F.posexplode_outer(vector_to_array("features")).alias("position", "value"))
    return values.groupBy("position").agg(F.round(F.sum("value"), 2).alias("total"))


@query(
    "E6",
    f"SELECT name, CAST(label AS DOUBLE) AS label, array_to_string(pixels, ' ') AS features FROM ({src.PIXELS_SQL})",
)
def labeled_points(spark, sf_dir):
    df = points_of(src.pixel_rows(spark, sf_dir))
    words = F.transform(vector_to_array("features"), lambda x: x.cast("int").cast("string"))
    return df.select("name", "label", F.array_join(words, " ").alias("features"))


@query(
    "L5 E1",
    """SELECT brand AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, brand) AS rank
       FROM (SELECT p_brand AS brand FROM part) GROUP BY brand""",
)
def brand_rank(spark, sf_dir):
    return index_order_rank(src.table(spark, sf_dir, "part"), "p_brand")
