import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dictspark.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=50, k=5, scale=256):
    good = [(v, [math.floor(scale * c) for c in e], i) for i, (v, e, _) in enumerate(rows) if v is not None and e is not None and all(c is not None and math.isfinite(c) for c in e)]
    out = []
    for q, x, i in good:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), v, j) for v, y, j in good if j != i and len(x) == len(y))
            out += [(q, rank, v, -s) for rank, (s, v, _) in enumerate(scores[:k], 1)]
    return sorted(out)


def rows_of(seed, n=900, dim=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = base[0] if i % 3 == 0 else base[int(rng.integers(12))]  # a third of the rows crowd around one vector, many of them equal
        rows.append((i, (v + rng.normal(size=dim) * rng.choice([0, 0, 0.05, 0.5])).tolist(), i % 10))
    return rows


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(("seed", "group", "asked", "boxes"), [(0, 4096, 1024, 1024), (1, 40, 7, 3), (2, 150, 1024, 1024)])
def test_against_all_pairs(spark, monkeypatch, seed, group, asked, boxes):
    monkeypatch.setattr(topk, "QUERY_ROWS", asked)
    monkeypatch.setattr(topk, "BOXES", boxes)
    rows = rows_of(seed)
    got = topk.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, group_rows=group)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert result(got) == brute(rows)


def test_odd_vectors(spark):
    v, w = [1.0, 2.0, -3.0], [0.5, 0.25, 1.0]
    rows = [
        (0, v, 1), (0, v, 1), (50, v, 1), (50, w, 2), (3, v, 1), (3, v, 1), (4, w, 1), (None, v, 1), (5, None, 1), (100, None, 1), (6, [None, 1.0, 2.0], 1), (7, [math.nan, 1.0, 2.0], 1), (150, [math.inf, 1.0, 1.0], 1),
        (8, [1.0, 2.0], 1), (200, [3.0, 4.0], 1), (250, [7.0], 1), (300, [], 1), (9, [], 1), (350, [0.0, 0.0, 0.0], 1), (10, [-1.0, 5.0, 0.0], None), (-50, w, 3), (400, [1e12, -1e12, 1e12], 1), (11, [2e12, 1.0, 3e12], 1),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit("x"), "X": F.lit(1), "query": F.lit(None).cast("int"), "class": F.lit(2)})
    clipped = [(q, rank, v, max(min(s, 2**63 - 1), -(2**63))) for q, rank, v, s in brute(rows)]
    assert result(topk.search(vectors, F.col("vec_id") % 50 == 0)) == clipped
    assert topk.search(vectors, F.col("vec_id") % 50 == 0, k=1).count() < len(clipped)
    assert topk.search(vectors.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert topk.search(vectors, F.col("vec_id") < -999).collect() == []
    assert topk.search(vectors.where("vec_id = 250"), F.col("vec_id") % 50 == 0).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for dim in (1, 2, 5, 16, 64, 100):
        x, q = rng.normal(size=(200, dim)) * rng.choice([0.01, 1, 100], size=(200, 1)), rng.normal(size=(50, dim)) + 0.3
        exact = q @ x.T
        last = None
        for m in topk.LEVELS:
            s, t = topk.statistics(x, m), topk.statistics(q, m)
            np.testing.assert_allclose(np.linalg.norm(s, axis=1), np.linalg.norm(x, axis=1))
            bound = t @ s.T
            assert (bound >= exact - 1e-9 * np.abs(bound)).all()
            assert (topk.box_bound(s.min(0)[None], s.max(0)[None], t)[:, 0] >= bound.max(1) - 1e-9).all()
            if dim == 64:  # halves of segments bound closer
                assert last is None or (bound <= last + 1e-9).all()
            last = bound


def test_bounds_leave_few(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.cumsum(rng.normal(size=(3000, 64)), axis=1)  # smooth, so that segments say much
    x = np.floor(256 * x).astype(np.int64)
    group, seen = topk.Group(x), []
    exact = group.exact
    monkeypatch.setattr(group, "exact", lambda at, q: seen.append(len(at)) or exact(at, q))
    for i in range(20):
        at, scores = group.best(x[i], [topk.statistics(x[i : i + 1].astype(float), m)[0] for m in topk.LEVELS], 6, -np.inf)
        want = np.sort(x @ x[i])[::-1][:6]
        assert np.array_equal(np.sort(scores)[::-1][:6], want)
    assert sum(seen) < 0.1 * 20 * len(x)
