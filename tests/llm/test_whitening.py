import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from paperledger.llm.bidiagonal import bidiagonalise, dqds, right_singular
from paperledger.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, label int, n string, x int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "n", 1) for i, v in rows], SCHEMA)


def brute(rows, components=32):
    """Exact sums and deviations in whole numbers; the covariance from exact centred rows, its eigenvectors by numpy."""
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*(v for _, v in x))]
    y = [[n * a - s for a, s in zip(v, sums)] for _, v in x]
    centred = np.array([[float(Fraction(a, n)) for a in v] for v in y])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return x, n, [sum(a * a for a in v) for v in y], centred, values[::-1][:components], vectors[:, ::-1][:, :components]


def compare(found, rows, k):
    x, n, deviations, centred, values, vectors = brute(rows)
    found = sorted(found, key=lambda r: (r.vec_id, r.component))
    assert len(found) == len(rows) * k and {r.n for r in found} == {n}
    assert [r.deviation for r in found[::k]] == deviations
    z = np.array([r.whitened for r in found]).reshape(-1, k)
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    signs = np.sign((z * want).sum(axis=0))
    assert np.abs(z * signs - want).max() < 1e-7 * np.abs(want).max()
    assert np.allclose([r.explained for r in found[:k]], values[:k] / (centred**2).sum() * n, rtol=1e-9)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-10


def test_given_embeddings(spark):
    given_rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given_rows.orderBy("vec_id").collect()]
    compare(whiten(given_rows.repartition(7)).collect(), rows, 32)


def test_scales_far_apart(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(a) for a in rng.normal(size=5) * [1000, 30, 30, 1, 0.05]]) for i in range(200)]
    compare(whiten(table(spark, rows)).collect(), rows, 5)


def test_rows_that_take_no_part(spark):
    good = [(1, [1.0, 2.0]), (2, [3.0, -1.0]), (2, [3.0, -1.0]), (None, [0.0, 0.5])]
    bad = [(5, None), (6, []), (7, [1.0, None]), (8, [math.nan, 1.0]), (9, [math.inf, 0.0]), (10, [1.0, 2.0, 3.0]), (11, [3e38, 0.0])]
    found = whiten(table(spark, good + bad)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in found) == [
        (False, 1, 1), (False, 1, 2), (False, 2, 1), (False, 2, 1), (False, 2, 2), (False, 2, 2), (True, 0, 1), (True, 0, 2)]
    assert {r.n for r in found} == {4}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance_gives_no_rows(spark, rows):
    assert whiten(table(spark, rows)).collect() == []


def test_dependent_dimensions_are_no_components(spark):
    rows = [(i, [float(i % 7), float(2 * (i % 7)), 5.0, float(i % 3)]) for i in range(40)]
    found = whiten(table(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2} and found[0].identity_error < 1e-10


def test_deviation_beyond_a_long_is_null(spark):
    found = whiten(table(spark, [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 2.0])])).collect()
    assert {r.vec_id: r.deviation for r in found if r.component == 1}[1] is None
    assert {r.vec_id: r.deviation for r in found if r.component == 1}[3] is not None


def check(r):
    squares, v = right_singular(r)
    want = np.linalg.svd(r, compute_uv=False)
    k = len(squares)
    assert np.allclose(np.sqrt(squares), want[:k], rtol=1e-10, atol=1e-14 * want[0])
    assert np.all(want[k:] <= 1e-10 * want[0])
    assert np.abs(v.T @ v - np.eye(k)).max() < 1e-9
    assert np.abs(r.T @ (r @ v) - v * squares).max() <= 1e-9 * want[0] ** 2


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 130])
def test_random_triangles(n):
    rng = np.random.default_rng(n)
    check(np.linalg.qr(rng.normal(size=(3 * n, n)), mode="r"))


def test_equal_and_clustered_values():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for values in ([1.0] * 40, [2.0] * 20 + [1.0] * 20, [1 + i * 1e-9 for i in range(40)], [10.0**-i for i in range(10)] + [1e-3] * 30):
        check(np.linalg.qr((np.linalg.qr(rng.normal(size=(40, 40)))[0] * values) @ q.T, mode="r"))
    check(np.eye(8))
    check(np.diag([3.0, 0.0, 2.0]))


def test_small_values_keep_their_relative_accuracy():
    d, f = [1.0, 1e-4, 1e-8], [1e-3, 1e-6]
    b = np.diag(d) + np.diag(f, 1)
    found = dqds([v * v for v in d], [v * v for v in f])
    exact = np.linalg.svd(b, compute_uv=False)[::-1]
    assert math.isclose(math.prod(found), math.prod(v * v for v in d), rel_tol=1e-13)
    assert np.allclose(np.sqrt(found), exact, rtol=1e-7)


def test_bidiagonal_form():
    r = np.triu(np.random.default_rng(1).normal(size=(12, 12)))
    d, f, p = bidiagonalise(r)
    b = np.diag(d) + np.diag(f, 1)
    assert np.allclose(p @ b.T @ b @ p.T, r.T @ r) and np.allclose(p.T @ p, np.eye(12))


@settings(deadline=None, max_examples=150)
@given(st.integers(1, 9).flatmap(lambda n: st.lists(st.lists(st.integers(-3, 3), min_size=n, max_size=n), min_size=n, max_size=n)))
def test_any_small_triangle(rows):
    r = np.triu(np.array(rows, dtype=np.float64))
    if np.any(r):
        check(r)
