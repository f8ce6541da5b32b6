"""Queries of the whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog import inputs as src
from plumbline.catalog.images import GRAY_SQL, SIZE
from plumbline.catalog.models import NB_TRAINING
from plumbline.catalog.registry import query
from plumbline.catalog.relational import VIEWS
from plumbline.functions.image_ops import image_pixels
from plumbline.models.estimators import fit_naive_bayes
from plumbline.plans import images, recommenders, tabular
from plumbline.session import spread
from plumbline.sources.pixel_lines import labeled_points

SCREENED = ["price", "quantity", "discount", "tax", "size", "retail"]


# All correlations in one row of one pass, then a row per pair.
PAIRS_SQL = f"""WITH t AS ({src.HOUSES_SQL}),
  one AS (SELECT [{", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': corr({a}, {b})}}" for a in SCREENED for b in SCREENED)}] AS pairs FROM t),
  p AS (SELECT u.a AS "column", u.b AS other, u.r AS correlation FROM (SELECT unnest(pairs) AS u FROM one)),
  strong AS (SELECT "column" FROM p WHERE other = 'price' AND abs(correlation) >= 0.1)"""
NOT_RATED = ["l_orderkey", "l_linenumber", "returnflag", "linestatus", "brand"]


@query(
    "C1 A8",
    f"""{PAIRS_SQL} SELECT "column", other, round(correlation, 6) AS correlation FROM p
        WHERE "column" IN (FROM strong) AND other IN (FROM strong)""",
)
def screen_features(spark, sf_dir):
    screening = tabular.screen_features(src.houses(spark, sf_dir), "price", drop=NOT_RATED)
    return screening.matrix.withColumn("correlation", F.round("correlation", 6))


@query("C1 A6", f"""{PAIRS_SQL} SELECT "column", round(correlation, 6) AS correlation FROM p WHERE other = 'price'""")
def screen_correlations(spark, sf_dir):
    screening = tabular.screen_features(src.houses(spark, sf_dir), "price", drop=NOT_RATED)
    return screening.correlations.withColumn("correlation", F.round("correlation", 6))


STATS_SQL = ", ".join(
    f"{{'c': '{c}', 's': '{stat}', 'v': CAST({fn}({c}) AS DOUBLE)}}"
    for c in ["l_orderkey", "l_linenumber", *SCREENED]
    for stat, fn in [("count", "count"), ("mean", "avg"), ("stddev", "stddev"), ("min", "min"), ("max", "max")]
)


@query(
    "C1 A5",
    f"""SELECT u.c AS "column", u.s AS stat, round(u.v, 4) AS value FROM (SELECT unnest([{STATS_SQL}]) AS u FROM ({src.HOUSES_SQL}))""",
)
def screen_description(spark, sf_dir):
    screening = tabular.screen_features(src.houses(spark, sf_dir), "price", drop=NOT_RATED)
    return screening.description.withColumn("value", F.round("value", 4))


@query("C2")
def price_regression(spark, sf_dir):
    report = tabular.price_regression(
        src.houses(spark, sf_dir),
        "price",
        ["returnflag", "linestatus", "brand"],
        ["quantity", "discount", "tax", "size", "retail"],
        ratio=("tax", "discount", "tax_share"),
        key=["l_orderkey", "l_linenumber"],
    )
    return report.metrics


@query("C3")
def segment_by_kmeans(spark, sf_dir):
    sweep = tabular.segment_by_kmeans(src.houses(spark, sf_dir), ["quantity", "size", "retail", "price"])
    return sweep.scores


@query("C4")
def activity_forecast(spark, sf_dir):
    report = tabular.activity_forecast(
        src.activity(spark, sf_dir),
        "next_month_views",
        ["payment_method_type", "country", "rebill_period_in_months"],
        ["age", "firstSub", "last_month_views", "all_time_views"],
        VIEWS,
        key="c_custkey",
    )
    return report.metrics


@query("C5")
def lapse_classifier(spark, sf_dir):
    report = tabular.lapse_classifier(
        src.activity(spark, sf_dir),
        "next_month_views",
        ["payment_method_type", "country", "rebill_period_in_months"],
        ["age"],
        ["firstSub", "last_month_views", "all_time_views"],
        key="c_custkey",
    )
    return report.extra["confusion"]


@query("C6")
def trial_conversion(spark, sf_dir):
    report = tabular.trial_conversion(
        src.trials(spark, sf_dir),
        "country",
        "payments_made",
        ["rebill_period", "access_count", "amount"],
        src.NATION_GROUPS,
        src.KEEP_NATIONS,
        key="c_custkey",
    )
    return report.accuracies


@query("C7")
def course_recommender(spark, sf_dir):
    return recommenders.course_recommender(src.courses(spark, sf_dir))[1]


@query("C8")
def search_recommender(spark, sf_dir):
    report = recommenders.search_recommender(src.searches(spark, sf_dir))
    return report.by_user.select("username", F.inline("recommendations"))


@query("C9")
def name_clustering(spark, sf_dir):
    report = tabular.name_clustering(
        src.indicators(spark, sf_dir),
        "indicatorNid",
        "indicatorName",
        "numerator",
        ["subgroup", "unit", "numerator"],
        {"unit": "number"},
    )
    return report.predictions


@query("C11")
def image_model_compare(spark, sf_dir):
    pixels = src.pixel_rows(spark, sf_dir).withColumn("label", (F.col("label") >= 5).cast("int"))
    return images.image_model_compare(pixels.where(src.is_training()), pixels.where(~src.is_training()))[1]


# A stretched image repeats each source pixel m times, so the weights of full size follow from the source pixels.
FULL_BAYES_SQL = f"""WITH m AS (SELECT (2 * tx + 1) * 8 // {2 * SIZE[0]} AS x, (2 * ty + 1) * 8 // {2 * SIZE[1]} AS y, count(*) AS m
                                FROM range({SIZE[0]}) u(tx), range({SIZE[1]}) v(ty) GROUP BY ALL),
  e AS (SELECT vec_id, label, x, y, {GRAY_SQL} AS v, m FROM ({src.VECTOR_IMAGES_SQL}) JOIN m USING (x, y)),
  tr AS (SELECT DISTINCT vec_id, label FROM e WHERE {NB_TRAINING}),
  pi AS (SELECT label, ln(count(*) + 1) - ln((SELECT count(*) + count(DISTINCT label) FROM tr)) AS pi FROM tr GROUP BY label),
  sums AS (SELECT label, x, y, m, sum(v) AS s FROM e WHERE {NB_TRAINING} GROUP BY ALL),
  th AS (SELECT label, x, y, ln(s + 1) - ln(sum(s * m) OVER (PARTITION BY label) + {SIZE[0] * SIZE[1]}) AS theta FROM sums),
  c AS (SELECT e.vec_id, e.label, pi.label AS guess, any_value(pi) + sum(v * theta * m) AS score
        FROM e JOIN th USING (x, y) JOIN pi ON pi.label = th.label WHERE NOT ({NB_TRAINING}) GROUP BY ALL),
  b AS (SELECT vec_id, label, arg_max(guess, score) AS prediction FROM c GROUP BY ALL)"""


@query("C12 I5", f"{FULL_BAYES_SQL} SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM b")
def image_batch_score(spark, sf_dir):
    """A Bayes model trained on full-size gray pixels scores the images it has not seen."""
    frame = spread(src.vector_images(spark, sf_dir))
    training = src.is_training("image.origin")
    # The fit is one pass, so pixels go straight into it: a written table would be read back by thousands of rows at once.
    model = fit_naive_bayes(labeled_points(image_pixels(frame.where(training), packed=True)))
    _, score = images.image_batch_score(model, frame.where(~training))
    return score.withColumn("accuracy", F.round("accuracy", 6))
