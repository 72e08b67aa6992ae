"""The qd solver against numpy's eigenvectors of the plain covariance, and the query against loops."""

import math

import numpy as np
import pytest

from atrium.llm.whitening import bidiagonal, deviations, directions, dqds, whitened


def plain(rows, most=4):
    """rows: vec_id, vector. By loops, with the covariance formed from exact integers."""
    usable = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fits = sorted({tuple(x) for _, x in usable})
    n, d = len(fits), len(fits[0])
    total = [sum(x[j] for x in fits) for j in range(d)]
    centred = np.array([[(n * x[j] - total[j]) / n for j in range(d)] for x in fits])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in usable:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, total, strict=True))
        y = np.array([(n * a - s) / n for a, s in zip(x, total, strict=True)]) @ vectors
        for k in range(min(most, int((values > 1e-9 * values[0]).sum()))):
            out.setdefault((i, k + 1), []).append((n, dev, abs(y[k]) / math.sqrt(values[k]), values[k] / values.sum()))
    return out


def same(df, rows):
    got = {}
    for r in df.collect():
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
        assert r.identity_error < 1e-9
    want = plain(rows)
    assert got.keys() == want.keys()
    for key, values in want.items():
        for g, w in zip(sorted(got[key]), sorted(values), strict=True):
            assert g[:2] == w[:2]
            assert g[2:] == pytest.approx(w[2:], rel=1e-8, abs=1e-8)


def test_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    same(whitened(df.repartition(40)), [(r.vec_id, r.embedding) for r in df.collect()])


def test_signs_are_one_for_all_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    found = whitened(df).where("component = 1").collect()
    fits = {tuple(math.floor(256 * c) for c in r.embedding): r.vec_id for r in df.collect()}
    chosen = [r.whitened for r in found if r.vec_id in set(fits.values())]
    assert abs(sum(chosen)) < 1e-9 and abs(sum(x * x for x in chosen) / len(chosen) - 1) < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2, 0.3]), (1, [0.1, 0.2, 0.3]), (2, None), (3, [nan, 0.0, 0.0]), (4, [inf, 0.0, 0.0]), (5, [None, 0.0, 0.0]), (None, [0.5, -0.2, 0.3]), (7, [-0.0, 0.001, 0.3]), (8, [0.9, 0.4, 0.3])]
    df = spark.createDataFrame([(*r, "a", 2.0) for r in rows], "vec_id long, embedding array<double>, component string, x double")
    same(whitened(df), rows)  # the third dimension is constant, so that there are two components
    other = whitened(df.unionByName(spark.createDataFrame([(9, [1.0]), (10, [])], "vec_id long, embedding array<double>"), allowMissingColumns=True))
    assert {(r.vec_id, r.n, r.whitened) for r in other.where("component is null").collect()} == {(9, 4, None), (10, 4, None)}
    same(other.where("component is not null"), rows)
    assert whitened(df.limit(0)).count() == 0
    assert whitened(df.where("vec_id = 1")).count() == 0  # all equal: no direction
    assert whitened(df.where("vec_id = 2")).count() == 0


def test_exact_deviations():
    x = np.array([[3, -4], [1 << 40, 5]])
    assert deviations(x, 7, [1, 2]) == [(21 - 1) ** 2 + (-28 - 2) ** 2, None]
    assert deviations(x[1:], 1, [0, 1 << 20]) == [None]
    assert deviations(np.array([[1 << 31, 5]]), 1, [0, 0]) == [(1 << 62) + 25]


@pytest.mark.parametrize("seed", range(6))
def test_solver(seed):
    rng = np.random.default_rng(seed)
    n = [1, 2, 5, 64, 40, 130][seed]
    r = np.triu(rng.standard_normal((n, n))) * np.logspace(0, -seed, n)
    d, e, _ = bidiagonal(r)
    want = np.linalg.svd(r)[1]
    assert np.sqrt(dqds(d, e)) == pytest.approx(want, rel=1e-10)
    values, vectors = directions(r)
    assert vectors @ vectors.T == pytest.approx(np.eye(len(vectors)), abs=1e-12)
    assert np.abs(vectors @ (r.T @ r) - values[:, None] * vectors).max() < 1e-12 * values[0]


def test_solver_of_equal_and_missing_values():
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((30, 30)))
    for sigma in ([5.0, 5.0, 5.0, 5.0, *[1.0] * 26], [3.0, 3.0 * (1 + 1e-13), 2.0, *[0.0] * 27], [1.0] * 30, [0.0] * 30):
        r = np.linalg.qr(np.diag(sigma) @ q, mode="r")
        values, vectors = directions(r)
        assert len(values) == min(4, sum(s > 0 for s in sigma))
        assert vectors @ vectors.T == pytest.approx(np.eye(len(vectors)), abs=1e-10)
        if len(values):
            assert np.abs(vectors @ (r.T @ r) - values[:, None] * vectors).max() < 1e-11 * values[0]


def test_small_singular_values_are_accurate():
    # A graded bidiagonal matrix; its determinant is the product of its diagonal.
    d, e = np.array([1.0, 1e-5, 1e-10, 1e-20]), np.array([1.0, 1e-4, 1e-12])
    assert np.prod(dqds(d, e)) == pytest.approx(1e-70, rel=1e-13)
