import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dictspark.llm import decontaminate as dc


def brute(docs, items, similarity=0.8):
    """The most similar item-sized window anywhere, without SimHash or seeds."""
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = set()
    for item_id, item in items:
        item = split(item)
        if not item:
            continue
        width = min(5, len(item))
        want = Counter(tuple(item[i : i + width]) for i in range(len(item) - width + 1))
        for doc_id, text in docs:
            words = split(text)
            all_shingles = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
            n = sum(want.values())
            if want.keys().isdisjoint(all_shingles):
                continue
            for s in range(-n + 1, len(all_shingles)):
                window = Counter(all_shingles[max(s, 0) : s + n])
                if sum((want & window).values()) / sum((want | window).values()) >= similarity:
                    out.add((doc_id, item_id))
                    break
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    words = [f"w{i}é" for i in range(60)]
    item = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, item(rng.choice([15, 20, 40, 40, 59]))) for i in range(25)] + [(100, "Red, green blue!"), (101, ""), (102, None), (103, items_repeat := "go go go go go go go go"), (None, item(30))]
    assert items_repeat
    docs = []
    for i in range(60):
        own = rng.choice([t for _, t in items if t]).split()
        edits = rng.choice([0, 0, 0, 1, 1, 2, 4])
        for _ in range(edits):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[], ["new"], ["new", own[at]]])
        docs.append((i, f"{item(rng.choice([0, 3, 80]))}\n{', '.join(own).upper() if i % 2 else ' '.join(own)} {item(rng.choice([0, 50]))}"))
    docs += [(200, None), (201, ""), (202, item(500)), (203, "so red green; BLUE it is"), (204, "go " * 300)]
    # edits that shift the text: the most similar window begins between the places where shared shingles stand in the item
    long = [f"u{i}" for i in range(104)]
    items += [(500, " ".join(long)), (501, " ".join(f"u{i % 9} v{i}" for i in range(40)))]
    for n, inserted in enumerate([0, 2, 6, 10]):
        for m, dropped in enumerate([0, 4]):
            own = [*long[:2], "x2", *long[3:52], *(f"new{k}" for k in range(inserted)), *long[52 + dropped : 101], "x101", *long[102:]]
            docs.append((1000 + 10 * n + m, " ".join([*(["before"] * (m * 7)), *own, *(["after"] * (n * 5))])))
    docs += [(1100 + i, " ".join([*long[i:], "end"])) for i in range(0, 25, 6)] + [(1200 + i, " ".join(["begin", *long[: 104 - i]])) for i in range(0, 25, 6)]  # clipped by the ends
    docs += [(1300, " ".join(long * 3)), (1301, " ".join([*long, *long[50:], *long[:60]]))]
    return docs, items


def test_against_brute_force(spark, data):
    docs, items = data
    expected = brute(docs, items)
    found = dc.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    assert len(found) == len(expected) > 20
    assert all(r.similarity >= 0.8 for r in found)


def test_shuffled_benchmark_gives_the_same(spark, data, monkeypatch):
    docs, items = data
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    small = sorted(map(tuple, dc.matches(docs, items).collect()), key=str)
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(dc, "SALTS", 3)
    assert sorted(map(tuple, dc.matches(docs, items).collect()), key=str) == small


def test_clean_keeps_columns_and_rows(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string")
    rows = [(1, "x ONE two, three four five six seven eight y", "a"), (2, "clean text", "b"), (2, "clean text", "b"), (None, "clean too", "c"), (None, "one two three four five six seven eight", "d"), (4, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key string").withColumn("item", F.lit(1)).withColumn("WIDTH", F.lit(2))
    left = dc.clean(docs, items)
    assert left.columns == docs.columns
    assert sorted((r.text_key for r in left.collect())) == ["b", "b", "c", "e"]
    assert dc.clean(docs.limit(0), items).count() == 0
    assert dc.clean(docs, items.limit(0)).count() == len(rows)
    assert dc.matches(docs, items.limit(0)).collect() == []
    assert dc.matches(docs, items).columns == ["doc_id", "item_id", "start", "n_words", "similarity"]


def test_simhash_is_the_majority(spark):
    rng = random.Random(2)
    for n in (1, 2, 7, 300, 70_000):
        hashes = [rng.getrandbits(64) for _ in range(n)]
        signed = [h - 2**64 if h >> 63 else h for h in hashes]
        got = spark.createDataFrame([(signed,)], "h array<long>").select(F.expr(dc.simhash_sql("h"))).first()[0]
        assert got & (2**64 - 1) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)
