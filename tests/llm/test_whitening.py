import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dictspark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def covariance(rows):
    """Distinct whole-number vectors, their exact sums and the covariance."""
    x = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in e) for e in rows})
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
    return n, sums, centred.T @ centred / n


def rows_of(n=700, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 2, dim)) * np.linspace(0.3, 2, dim)
    rows = [(i, base[0 if i % 3 == 0 else int(rng.integers(len(base)))].tolist(), 1) for i in range(n)]  # a third are equal
    return rows


def test_against_dense_eigenvectors(spark):
    rows = rows_of()
    n, sums, v = covariance([e for _, e, _ in rows])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    odd = [(900, None, 1), (901, [None] * 24, 1), (902, [math.nan] * 24, 1), (903, [1.0] * 23 + [math.inf], 1), (904, [], 1), (None, rows[1][1], 1), (2, rows[1][1], 1), (2, rows[1][1], 1)]
    table = spark.createDataFrame(rows + odd, SCHEMA).withColumns({"x": F.lit("x"), "N": F.lit(1), "whitened": F.lit(0)})
    whole = whitening.whiten(table)
    got = whole.collect()
    taking = rows + [r for r in odd if r[0] in (None, 2)]
    assert sorted((str(r.vec_id) for r in got)) == sorted(str(r[0]) for r in taking)
    by_id = {r.vec_id: r for r in got}
    z = np.array([by_id[i].whitened for i, _, _ in rows if i != 2])
    x = np.array([[(n * (math.floor(64 * c) + 1_000_000) - s) / n for c, s in zip(e, sums, strict=True)] for i, e, _ in rows if i != 2])
    want = x @ vectors / np.sqrt(values)
    signs = np.sign((z * want).sum(0))
    np.testing.assert_allclose(z, want * signs, atol=1e-9)
    for i, e, _ in rows[5:60]:
        r = by_id[i]
        assert r.n == n and int(r.deviation) == sum((n * (math.floor(64 * c) + 1_000_000) - s) ** 2 for c, s in zip(e, sums, strict=True))
        np.testing.assert_allclose(r.explained, values / np.trace(v), rtol=1e-10)
        assert r.identity_error < 1e-9
    flat = whitening.by_component(whole)
    assert flat.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert flat.count() == 16 * len(taking) and flat.agg(F.min("component"), F.max("component")).first()[:] == (1, 16)


def test_few_dimensions_little_variance_empty(spark):
    make = lambda rows: spark.createDataFrame([(i, e, 1) for i, e in enumerate(rows)], SCHEMA)
    assert whitening.by_component(whitening.whiten(make([]))).collect() == []
    assert whitening.whiten(make([[1.0, 2.0]] * 5)).select("whitened", "n").distinct().collect() == [([], 1)]
    line = whitening.whiten(make([[float(i), 2.0 * i, 0.0] for i in range(30)])).collect()
    assert {len(r.whitened) for r in line} == {1} and abs(line[0].explained[0] - 1) < 1e-12
    two = whitening.whiten(make([[1.0, 2.0], [2.0, 1.0], [5.0, 5.0], [1.0], [2.0], [1e300], [1e15]]))  # two lengths, and numbers too large or nearly
    assert {r.vec_id: len(r.whitened) for r in two.collect()} == {0: 2, 1: 2, 2: 2, 3: 1, 4: 1, 6: 1}


def test_exact_beyond_longs(spark):
    rows = [[3e14 * k, 1.0 * k] for k in range(4)]
    n, sums, _ = covariance(rows)
    got = whitening.whiten(spark.createDataFrame([(i, e, 1) for i, e in enumerate(rows)], SCHEMA)).collect()
    assert {r.vec_id: int(r.deviation) for r in got} == {i: sum((n * (math.floor(64 * c) + 1_000_000) - s) ** 2 for c, s in zip(e, sums, strict=True)) for i, e in enumerate(rows)}


@pytest.mark.parametrize(("dim", "k", "kind"), [(1, 4, ""), (5, 16, ""), (120, 10, ""), (64, 16, "flat"), (60, 7, "equal"), (90, 16, "repeated")])
def test_eigenpairs(dim, k, kind):
    rng = np.random.default_rng(dim)
    q, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
    values = {"": np.sort(rng.uniform(1, 2, dim)), "flat": np.r_[np.zeros(max(dim - 5, 0)), 1:6], "equal": np.ones(dim), "repeated": np.repeat(np.arange(1, 10), 10)}[kind].astype(float)
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    widest = []

    def product(block):
        widest.append(block.shape[1])
        return v @ block

    got, vectors = whitening.eigenpairs(product, dim, k)
    np.testing.assert_allclose(got, values[::-1][:k], atol=1e-11)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(min(k, dim)), atol=1e-12)
    assert np.linalg.norm(v @ vectors - vectors * got, axis=0).max() < 1e-11
    assert max(widest) <= k + 4


def test_corrections_solve_their_equations():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(40, 40))
    v = a @ a.T / 40
    u, _ = np.linalg.qr(rng.normal(size=(40, 5)))
    locked, u = u[:, :2], u[:, 2:]
    theta = (u * (v @ u)).sum(0)
    r = v @ u - u * theta
    r -= locked @ (locked.T @ r)
    t = whitening.corrections(lambda b: v @ b, theta, u, r, locked, steps=200)
    np.testing.assert_allclose(locked.T @ t, 0, atol=1e-10)
    for j in range(3):
        p = np.eye(40) - np.outer(u[:, j], u[:, j]) - locked @ locked.T
        left = p @ (v - theta[j] * np.eye(40)) @ p @ t[:, j]
        assert np.linalg.norm(left + p @ r[:, j]) < 2e-3 * np.linalg.norm(p @ r[:, j])
