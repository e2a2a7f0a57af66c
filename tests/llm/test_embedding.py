import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dictspark.llm import blocks, embedding

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    def good(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = {i: 0 for i in range(len(rows))}
    root = {i: i for i in range(len(rows))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if la == lb and good(a, la) and good(b, lb) and len(a) == len(b):
                x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[find(i)] = min(least.get(find(i), vec_id), vec_id)
    return sorted(((v, n[i], least.get(find(i)), v is not None and v == least.get(find(i))) for i, (v, _, _) in enumerate(rows)), key=str)


def rows_of(seed=0, n=500, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(25, dim))
    rows = []
    for i in range(n):
        # a third of the rows crowd around one vector
        v = base[0] if i % 3 == 0 else base[int(rng.integers(25))]
        v = v + rng.normal(size=dim) * rng.choice([0, 0.02, 0.05, 0.1, 0.15])
        rows.append((i, (v * rng.choice([1, 1, 3])).astype(np.float32).tolist(), int(i % 5 == 0)))
    return rows


@pytest.mark.parametrize(("seed", "chunk", "met"), [(0, 1024, 128), (1, 17, 128), (2, 1024, 2)])
def test_against_all_pairs(spark, monkeypatch, seed, chunk, met):
    monkeypatch.setattr(blocks.dealt, "__defaults__", (chunk,))
    monkeypatch.setattr(embedding, "MET", met)  # fewer met: finer buckets, more tables
    rows = rows_of(seed)
    got = embedding.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == brute(rows)


def test_odd_vectors(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [
        (9, v, 1), (5, v, 1), (5, v, 1), (7, [2.0, 4.0, 6.0], 1), (1, v, 2), (None, w, 1), (None, w, 1), (20, w, 3), (None, w, 3), (30, v, None), (31, v, None), (32, None, 1), (33, [0.0, 0.0, 0.0], 1),
        (34, [0.0, 0.0, 0.0], 1), (35, [float("nan"), 1.0, 1.0], 1), (36, [float("inf"), 1.0, 1.0], 1), (37, [None, 1.0, 2.0], 1), (38, [1.0, 2.0], 1), (39, [], 1), (None, None, 1), (40, [1e-30, 2e-30, 3e-30], 4), (41, [1e30, 2e30, 3e30], 4),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("N", F.lit(1))
    got = embedding.near_duplicates(vectors).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == brute(rows)
    assert embedding.near_duplicates(vectors.limit(0)).count() == 0


def test_plan_reaches_its_recall():
    for n in (10, 10_000, 10**9):
        k, tables = embedding.plan_tables(n, 0.98)
        near, far = embedding.collision(0.2), embedding.collision(math.sqrt(2))
        assert (1 - near**k) ** tables <= embedding.MISSED
        assert n * far**k <= embedding.MET
