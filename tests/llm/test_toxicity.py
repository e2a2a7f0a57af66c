import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dictspark.llm import toxicity
from dictspark.llm.common import held_out

SF_DIR = f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.01"


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"))
    n = label.sum()
    return (rank[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def toy(n=240, seed=0):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abdefghilmnorstu"), rng.integers(2, 8))) for _ in range(500)]
    bad = ["scumbag", "worthless", "pathetic", "disgusting"]
    texts, labels = [], []
    for i in range(n):
        own = rng.choice(words, int(rng.choice([5, 40, 400]))).tolist()
        if i % 4 == 0:
            own[int(rng.integers(len(own)))] = str(rng.choice(bad))
        texts.append(" ".join(own))
        labels.append(int(i % 4 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*toy(), prior=0.25)


def test_finds_one_insult_in_a_long_text(model):
    texts, labels = toy(200, seed=1)
    assert auc(model.scores(texts), np.array(labels)) > 0.95
    clean = toy(400, seed=2)[0][1]
    long = " ".join([clean] * 20)
    assert model.scores([long + " scumbag"])[0] >= 0.6 > model.scores([long])[0]


def test_unseen_misspellings_score_higher(model):
    clean, *bad = model.scores(["the road is long", "the road is w0rthless", "the road is worthlesss", "the road is disgustting", "the road is DISGUSTING"])
    assert min(bad) > clean


def test_scores_do_not_depend_on_batches(model, monkeypatch):
    texts = toy(60, seed=3)[0] + [None, "", "!!!", "é" * 50]
    whole = model.scores(texts)
    assert np.allclose([model.scores([t])[0] for t in texts], whole)
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 900)
    assert np.allclose(model.scores(["x " * 3000 + "scumbag"]) >= 0.3, True)
    assert whole[-4] == whole[-3] == whole[-2] == model.empty


def test_repeated_words_count_once(model):
    assert np.isclose(model.scores(["the the the the road"])[0], model.scores(["the road"])[0])


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1]])
def test_degenerate_labels(labels):
    model = toxicity.train(["a b"] * len(labels), labels, prior=1.0 if 1 in labels else 0.0)
    score = model.scores(["some text", None])
    assert (score >= 0).all() and (score <= 1).all()
    assert (score >= 0.3).all() == (1 in labels)


def test_tables_with_nulls_and_repeats(spark):
    texts, labels = toy(80)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, texts[3]), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("Y", F.lit(1))
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (5, None), (4, 1), (12345, 0)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, marks)).collect()
    assert len(scored) == len(rows)
    for r in scored:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), marks)).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, marks.limit(0))).where("score > 0.01").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where(held_out("doc_id")).select("score", "toxic").toPandas()
    assert auc(scored.score.to_numpy(), scored.toxic.to_numpy()) > 0.85
