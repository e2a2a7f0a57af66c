import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dictspark.llm import blocks, simhash
from dictspark.llm.components import components

DOCS = "doc_id long, text string"


def brute_fingerprint(text, width=4):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One two", "a b c d", "A b\tC d\ne f g", "é Ê x y z y z é Ê x", "one " * 3000])
def test_fingerprint(text, monkeypatch):
    assert simhash.fingerprint(text, 4) == brute_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 7)
    assert simhash.fingerprint(text, 4) == brute_fingerprint(text)


@pytest.mark.parametrize(("n", "distance"), [(10, 4), (300_000, 4), (10**9, 4), (10**9, 3), (50, 0), (10**6, 7)])
def test_plan_finds_all(n, distance):
    rng = np.random.default_rng(5)
    bits = rng.random((2000, 64)) < rng.uniform(0.1, 0.9, 64)
    parts = simhash.plan_parts(n, (bits.T.astype(float) @ bits) * n / 2000, distance)
    assert sum(t + 1 for _, t in parts) == distance + 1
    assert len({b for own, _ in parts for b in own}) == sum(len(own) for own, _ in parts)
    for _ in range(300):
        differ = set(rng.choice(64, distance, replace=False).tolist())
        assert any(len(differ & set(own)) <= t for own, t in parts)


@pytest.mark.parametrize("chunk", [3, 1024])
@pytest.mark.parametrize("parts", [None, [(list(range(21)), 1), (list(range(21, 42)), 1), (list(range(42, 64)), 0)]])
def test_links_against_brute_force(spark, monkeypatch, chunk, parts):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {0, *base}
    for i in range(260):
        x = rng.choice(base[:2] if i % 2 else base)
        for _ in range(rng.randrange(1, 7)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    monkeypatch.setattr(blocks, "CHUNK", chunk)
    monkeypatch.setattr(blocks.dealt, "__defaults__", (chunk,))
    monkeypatch.setattr(simhash, "SMALL", 5)
    if parts:
        monkeypatch.setattr(simhash, "plan_parts", lambda *_: parts)
    nodes = [int(np.uint64(x).view(np.int64)) for x in fps]
    links = [(a, b) for a in nodes for b in nodes if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    expected = brute_components(nodes, links)
    found = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in nodes], "fp long"), 4)
    rows = {r.node: r.root for r in components(found).collect()}
    assert {n: rows.get(n, n) for n in nodes} == expected


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 3, 60, 200]))) for _ in range(40)]
    texts += [" ".join(w if rng.random() > 0.01 else "X" for w in t.split()) for t in texts] + [None, "", " ", texts[5].upper()]
    rows = list(enumerate(texts))
    fp = {i: brute_fingerprint(t) for i, t in rows}
    expected = brute_components(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    docs = spark.createDataFrame(rows, DOCS).withColumn("FP", F.lit("x")).withColumn("root", F.lit(1))
    found = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.fp & (2**64 - 1) for r in found} == fp
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_null_ids_repeats_and_empty(spark):
    text = "one two three four five six"
    rows = [(1, text), (1, text), (None, text), (None, "other words stand here now"), (None, "other words stand here now"), (7, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert found == sorted([(1, 1), (1, 1), (None, 1), (None, None), (None, None), (7, 7)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_first(docs).collect()), key=str)
    assert kept == sorted([(1, text), (None, "other words stand here now"), (7, None)], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_an_id_that_repeats_with_other_texts(spark):
    one, two, three = "one two three four five six", "other words stand here now again", "a third text that is like no other"
    fps = [brute_fingerprint(t) for t in (one, two, three)]
    assert all((a ^ b).bit_count() > 4 for a in fps for b in fps if a != b)
    rows = [(5, one), (5, two), (5, two), (6, one), (3, three), (5, three), (None, two)]
    kept = simhash.keep_first(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(5, one), (5, two), (3, three)])


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (501, 501), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(301), 0), 500: 500, 501: 500}
