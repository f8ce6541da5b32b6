"""Trees as tables: one row per node, and one SQL predicate per leaf."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from plumbline.session import scratch_path

CLASSIFIERS = (DecisionTreeClassificationModel, RandomForestClassificationModel)
REGRESSIONS = (DecisionTreeRegressionModel, RandomForestRegressionModel)
RULE_SCHEMA = "tree int, leaf int, rule string, tests array<string>, support long, prediction double, votes array<double>"


def tree_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """One row per node of a tree or forest: ``(tree, node, parent, feature, cut, categories, support, value, prediction)``.

    ``cut`` sends values up to it to the left, ``categories`` those listed; both are
    null in leaves, and ``parent`` is in roots.  ``support`` is the number of training
    rows, ``value`` the statistics behind the prediction (rows per class of a classifier).
    The rows are read from the model as Spark saves it, in the shared folder.
    """
    if not isinstance(model, CLASSIFIERS + REGRESSIONS):
        raise TypeError("a tree or a random forest is expected")
    path = scratch_path(spark, "tree")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.select(F.lit(0).alias("tree"), "*")
    links = data.where("leftChild >= 0").select(
        "tree", F.col("id").alias("parent"), F.explode(F.array("leftChild", "rightChild")).alias("id")
    )
    inner, ordered = F.col("leftChild") >= 0, F.col("split.numCategories") < 0
    return data.join(links, ["tree", "id"], "left").select(
        "tree",
        F.col("id").alias("node"),
        "parent",
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ordered, F.col("split.leftCategoriesOrThreshold")[0]).alias("cut"),
        F.when(inner & ~ordered, F.col("split.leftCategoriesOrThreshold")).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.col("rawCount").alias("support"),
        F.col("impurityStats").alias("value"),
        "prediction",
    )


def leaf_rules(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """``(tree, leaf, rule, tests, support, prediction, votes)``: per leaf the SQL predicate over the columns ``names`` that leads to it.

    ``names`` are the columns behind the feature vector, in its order.  The predicates
    of a tree exclude each other and cover every row without nulls (NaN counts as
    largest, as in the model).  ``tests`` are its parts from the
    root down, ``votes`` a leaf's class shares, null in regressions.
    The nodes pass through the driver, where the model itself lies.
    """
    voting = isinstance(model, CLASSIFIERS)
    trees: dict[int, dict[int, Row]] = {}
    for row in tree_nodes(spark, model).collect():
        trees.setdefault(row["tree"], {})[row["node"]] = row
    rows = []
    for tree, nodes in sorted(trees.items()):
        for leaf, tests in _leaves(nodes, names):
            total = sum(leaf["value"])
            votes = [v / total for v in leaf["value"]] if voting else None
            rows.append((tree, leaf["node"], " AND ".join(tests) or "TRUE", tests, leaf["support"], leaf["prediction"], votes))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _leaves(nodes: dict[int, Row], names: Sequence[str]) -> Iterator[tuple[Row, list[str]]]:
    right = {n["parent"]: n["node"] for n in nodes.values() if n["parent"] is not None and nodes[n["parent"]]["left"] != n["node"]}
    open_: list[tuple[int, list[str]]] = [(n["node"], []) for n in nodes.values() if n["parent"] is None]
    while open_:
        at, path = open_.pop()
        node = nodes[at]
        if node["left"] is None:
            yield node, path
            continue
        yes, no = _tests(f"`{names[node['feature']]}`", node)
        open_ += [(right[at], [*path, no]), (node["left"], [*path, yes])]


def _tests(name: str, node: Row) -> tuple[str, str]:
    if node["cut"] is not None:
        return f"{name} <= {_literal(node['cut'])}", f"{name} > {_literal(node['cut'])}"
    some = ", ".join(_literal(c) for c in sorted(node["categories"]))
    return (f"{name} IN ({some})", f"{name} NOT IN ({some})") if some else ("FALSE", "TRUE")


def _literal(number: float) -> str:
    """A double that SQL reads back bit for bit."""
    text = repr(float(number))
    return text.upper() if "e" in text else f"{text}E0"


def score_by_rules(df: DataFrame, rules: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``df`` with the prediction its rules give: shares summed over the trees for classes, else the mean of the trees.

    Rules that share their first tests share them here too, so a row goes through one
    test per level and tree, in built-in expressions and without the model.  A row with a null
    in a column that a rule names has a null prediction.
    """
    trees: dict[int, list[Row]] = {}
    for row in rules.orderBy("tree", "leaf").collect():
        trees.setdefault(row["tree"], []).append(row)
    tests = {test for own in trees.values() for r in own for test in r["tests"]}
    whole = [F.col(f"`{c}`").isNotNull() for c in df.columns if any(f"`{c}`" in test for test in tests)]
    placed = df.select("*", *[F.expr(_nested(list(enumerate(own)))).alias(f"__leaf{t}") for t, own in trees.items()])

    def summed(values: dict[int, list[float]]) -> Column:
        return sum((F.get(F.lit(own), F.col(f"__leaf{t}")) for t, own in values.items()), F.lit(0.0))

    classes = len(next(iter(trees.values()))[0]["votes"] or ())
    if classes:
        shares = F.array(*[summed({t: [r["votes"][c] for r in own] for t, own in trees.items()}) for c in range(classes)])
        # The first of equal classes, as in the model.
        found = (F.array_position("__shares", F.array_max("__shares")) - 1).cast("double")
        scored = placed.withColumn("__shares", shares).withColumn(prediction, found)
    else:
        scored = placed.withColumn(prediction, summed({t: [r["prediction"] for r in own] for t, own in trees.items()}) / len(trees))
    known = F.when(reduce(and_, whole, F.lit(True)), F.col(prediction))
    return scored.withColumn(prediction, known).drop("__shares", *[f"__leaf{t}" for t in trees])


def _nested(leaves: list[tuple[int, Row]], level: int = 0) -> str:
    """The number of the leaf a row belongs to, by the tests of the leaves from ``level`` down."""
    if len(leaves) == 1:
        return str(leaves[0][0])
    test = leaves[0][1]["tests"][level]
    yes = [at for at in leaves if at[1]["tests"][level] == test]
    no = [at for at in leaves if at[1]["tests"][level] != test]
    return f"CASE WHEN {test} THEN {_nested(yes, level + 1)} ELSE {_nested(no, level + 1)} END"
