"""Every query with SQL gives exactly what DuckDB gives; the others give sound rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import database, difference
from plumbline.catalog import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, db, name):
    assert difference(queries()[name](spark, sf_dir), db, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = {r["model"]: r for r in entry(spark).collect()}
    assert set(rows) == {"decision_tree", "random_forest"}
    assert all(0 <= r["accuracy"] <= 1 for r in rows.values())


def test_every_inventory_line_is_covered():
    covered = {part for q in QUERIES.values() for part in q.covers.split()}
    lines = {"S": 6, "K": 2, "P": 14, "F": 5, "J": 1, "A": 9, "U": 4, "L": 5, "X": 4, "E": 6, "I": 5, "M": 13, "V": 10, "C": 13}
    wanted = {f"{kind}{i}" for kind, n in lines.items() for i in range(1, n + 1)} | {"UD1"}
    assert wanted - covered == set()
