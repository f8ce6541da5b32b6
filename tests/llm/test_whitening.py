"""The qd solver against numpy, and the whitened rows against a plain rebuild in exact sums."""

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import whitening
from plumbline.llm.queries import op11_embedding_whitening

ROWS = "vec_id long, embedding array<float>, label int"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 24), st.integers(0, 6), st.integers(0, 10_000))
def test_solver_equals_numpy(dims, decades, seed):
    own = np.random.default_rng(seed)
    rows = own.normal(size=(dims + 9, dims)) * 10.0 ** -np.linspace(0, decades, dims)
    a, b, v = whitening.bidiagonal(whitening._triangle(rows))
    values = whitening.squared_singular_values(a, b)
    true = np.linalg.svd(rows, compute_uv=False) ** 2
    assert np.allclose(values, true, rtol=1e-6, atol=1e-14 * true[0])
    z, refined = whitening.directions(a, b, values, dims)
    axes = v @ z
    assert np.abs(axes.T @ axes - np.eye(dims)).max() < 1e-10
    spread = axes.T @ rows.T @ rows @ axes
    assert np.abs(spread - np.diag(refined)).max() <= 1e-12 * true[0]


def test_small_singular_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(0, 60, 4.0), np.zeros(14)
    assert np.allclose(whitening.squared_singular_values(a, b), a**2, rtol=1e-14, atol=0)
    # All entries known to the last digit: dqds loses none in the tiny values.
    b = a[1:] * 0.5
    got = np.sqrt(whitening.squared_singular_values(a, b))
    assert math.isclose(math.prod(got.tolist()), math.prod(a.tolist()), rel_tol=1e-12)


def test_equal_singular_values_give_orthogonal_directions():
    rows = np.vstack([np.eye(9) * 3, np.eye(9)])
    a, b, v = whitening.bidiagonal(whitening._triangle(rows))
    values = whitening.squared_singular_values(a, b)
    z, _ = whitening.directions(a, b, values, 9)
    assert np.allclose(values, 10) and np.abs(z.T @ z - np.eye(9)).max() < 1e-12


def plain(rows, most=16):
    """The contract in exact sums and numpy."""
    usable = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    length = max(Counter(len(x) for _, x in usable).items(), key=lambda p: (p[1], p[0]), default=(0, 0))[0]
    usable = [(i, x) for i, x in usable if len(x) == length]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    if not n:
        return {}, np.zeros(0), 0.0
    centred = np.array([[float(Fraction(v * n - s, n)) for v, s in zip(x, sums)] for x in fit])
    value, axes = np.linalg.eigh(centred.T @ centred / n)
    value, axes = value[::-1], axes[:, ::-1]
    kept = int((value[:most] > 1e-9 * max(value[0], 1e-300)).sum())
    out = {}
    for i, x in usable:
        off = [float(Fraction(v * n - s, n)) for v, s in zip(x, sums)]
        z = np.array(off) @ axes[:, :kept] / np.sqrt(value[:kept])
        out.setdefault(i, []).append((n, sum((n * v - s) ** 2 for v, s in zip(x, sums)), z))
    return out, value[:kept], value.sum()


def check(got, rows):
    expected, value, trace = plain(rows)
    found = {}
    for r in got:
        found.setdefault(r["vec_id"], []).append(r)
    if not len(value):
        assert got == []
        return
    assert set(found) == set(expected)
    for i in sorted(expected, key=str):
        assert len(found[i]) == len(value) * len(expected[i])
        if len(expected[i]) > 1:
            continue
        n, deviation, z = expected[i][0]
        own = sorted(found[i], key=lambda r: r["component"])
        assert [r["component"] for r in own] == list(range(1, len(value) + 1))
        assert {r["n"] for r in own} == {n} and {r["deviation"] for r in own} == {deviation}
        assert np.allclose([r["explained"] for r in own], value / trace, rtol=1e-9)
        white = np.array([r["whitened"] for r in own])
        assert np.allclose(np.abs(white), np.abs(z), atol=1e-7)
    assert got[0]["identity_error"] < 1e-9


def test_query_equals_a_plain_rebuild(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = op11_embedding_whitening(spark, sf_dir).collect()
    check(got, rows)
    # One sign for all rows: components of the fit list are uncorrelated, which mixed signs would not be.
    wide = np.zeros((len(rows), 16))
    for r in got:
        wide[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(16)).max() < 1e-9


def test_odd_rows(spark):
    own = np.random.default_rng(1)
    rows = [(k, own.normal(size=5).tolist(), 1) for k in range(60)]
    rows += [(100, None, 1), (101, [], 1), (102, [1.0, None, 0.0, 0.0, 0.0], 1), (103, [float("nan")] * 5, 1), (104, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1)]
    rows += [(105, [1.0, 2.0], 1), (None, [0.5] * 5, None), (7, [0.25] * 5, 1), (7, [0.25] * 5, 1), (106, [1e30, 0.0, 0.0, 0.0, 0.0], 1)]
    got = whitening.whiten(spark.createDataFrame(rows, ROWS).repartition(7)).collect()
    check(got, [r for r in rows if r[0] != 106])
    # The id column may have any name, others may clash.
    renamed = spark.createDataFrame(rows[:60], ROWS).selectExpr("vec_id AS x", "embedding AS component", "label AS n")
    assert len(whitening.whiten(renamed, 3, "x", "component").collect()) == 180


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 4, [[None]], [[1.0, 5.0], [1.0, 7.0], [1.0, 6.0]]])
def test_small_and_flat_tables(spark, vectors):
    rows = [(k, v, 0) for k, v in enumerate(vectors)]
    got = whitening.whiten(spark.createDataFrame(rows, ROWS)).collect()
    check(got, rows)


def test_deviations_are_exact_and_null_beyond_a_long():
    x = np.array([[2**40, 1], [5, -(2**40)]])
    n, sums = 2, (2**40 + 5, 1 - 2**40)
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    assert whitening._deviations(x, n, sums) == [d if d < 2**63 else None for d in exact] == [None, None]
    x = np.array([[2**30, 1], [5, 7]])
    sums = tuple(x.sum(axis=0).tolist())
    assert whitening._deviations(x, 2, sums) == [sum((2 * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]


def test_triangles_are_stacked_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    own = np.random.default_rng(2)
    rows = [(k, own.normal(size=4).tolist(), 1) for k in range(90)]
    fit = whitening.vectors_of(spark.createDataFrame(rows, ROWS)).select("x").repartition(31)
    n, sums = whitening._sums(fit)
    centre = whitening._centre(n, sums)
    r = whitening.reduced_triangle(fit, 4, centre)
    centred = whitening._centred(np.array([x["x"] for x in fit.collect()]), centre)
    assert n == 90 and np.allclose(r.T @ r, centred.T @ centred)
