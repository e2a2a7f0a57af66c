import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from dictspark.llm import fim

SCHEMA = "doc_id long, text string"


def expected(doc_id, text, seed=1, rate=90, spm=20):
    """One document by the plain rules: ``n, form, prefix_chars, middle_chars, output``."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    parts = ["word", "Other", "é", "𝄞", " ", "  ", "\n", "\x00", "1", "23", ".", "<", ">", "<P", "S>", "<M", "ß", "a", "Zz"]
    out = [(i, "".join(rng.choices(parts, k=rng.choice([0, 1, 2, 5, 30, 400])))) for i in range(600)]
    out += [(1000 + i, f"a text with {m} in it") for i in range(30) for m in ("<P>", "<S>", "<M>", "<p>", "<<P", "M>>")]
    out += [(2000, None), (2001, ""), (None, "no id"), (None, "no id"), (None, None), (5, "again an id"), (5, "again an id"), (-3, "negative id"), (3000, "long word " * 60_000), (3001, "x" * 500_000), (3002, "é𝄞" * 100_000)]
    return out


@pytest.mark.parametrize("chunk", [3, 1024])
def test_against_plain_rules(spark, rows, chunk):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"N": F.lit(1), "place": F.lit("x"), "row": F.lit(None).cast("string")})
    some = docs if chunk > 3 else docs.where("length(text) < 10000 OR text IS NULL")
    want = [(doc_id, *expected(doc_id, text), text or "") for doc_id, text in rows if chunk > 3 or len(text or "") < 10_000]
    made = fim.transform(some, chunk=chunk)
    got = made.select("*", fim.restore(F.col("output"), F.col("form")).alias("restored")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = fim.digests(fim.pieces(some, chunk=chunk)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(*w[:5], sha(w[5]), sha(w[6])) for w in want], key=str)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_parameters_and_pieces(spark, rows):
    texts = {i: t for i, t in rows if i is not None and i < 600 and t}
    docs = spark.createDataFrame(list(texts.items()), SCHEMA)
    cut = fim.pieces(docs, seed=7, rate=50, spm=80, chunk=10)
    assert cut.where("length(regexp_replace(body, '[A-Za-z]+', 'a')) > 10").count() == 0
    for r in fim.outputs(cut).collect():
        assert tuple(r)[1:] == expected(r.doc_id, texts[r.doc_id], 7, 50, 80)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert fim.transform(docs).collect() == [] and fim.digests(fim.pieces(docs)).collect() == []


def test_one_exchange_sorted_twice(spark, rows):
    plan = fim.digests(fim.pieces(spark.createDataFrame(rows, SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2
