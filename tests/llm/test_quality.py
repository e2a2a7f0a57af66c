import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from dictspark.llm import quality
from dictspark.llm.common import held_out

SF_DIR = f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.01"


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"))
    n = label.sum()
    return (rank[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def toy(n=200, seed=0):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeghilnorst"), rng.integers(2, 9))) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        own = rng.choice(words, int(rng.choice([8, 50, 300]))).tolist()
        if i % 3 == 0:
            own = [f"{w}{rng.choice(['$$$', '###'])}" for w in own] if i % 2 else [own[0]] * len(own)
        texts.append(" ".join(own))
        labels.append(int(i % 3 != 0))
    return texts, labels


def test_tokens_do_not_cross_texts():
    word, shape, owner = quality.tokens([b"", b"The the THE", b"the!! 12", b"  "])
    assert owner.tolist() == [1, 1, 1, 2, 2]
    assert word[0] == word[1] == word[2] == word[3] != word[4]
    assert len({*shape.tolist()}) == 5
    assert quality.tokens([b"the"])[1][0] == quality.tokens([b"the", b"x"])[1][0]


def test_word_vectors_count_every_document(spark):
    texts = toy(60)[0] + [None, "", "one"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert np.array_equal(quality.word_vectors(docs.repartition(7)), quality.word_vectors(docs.coalesce(1)))
    index, sums = quality.index_vectors(), np.zeros((quality._N, quality.DIMENSIONS))
    for t in texts:
        word, shape, _ = quality.tokens([(t or "").encode()])
        for i in range(len(word)):
            near = index[shape[i]] + sum((index[word[j]] + index[shape[j]] for j in range(max(0, i - 2), min(len(word), i + 3)) if j != i), np.zeros(quality.DIMENSIONS))
            sums[word[i]] += near
            sums[shape[i]] += near
    got = quality.word_vectors(docs)
    seen = np.abs(sums).sum(1) > 0
    count = np.zeros(quality._N)
    for t in texts:
        word, shape, _ = quality.tokens([(t or "").encode()])
        np.add.at(count, np.concatenate([word, shape]), 1)
    mean = sums / np.maximum(count, 1)[:, None] - sums.sum(0) / count.sum()
    assert np.allclose(got[seen], (mean / np.linalg.norm(mean, axis=1)[:, None])[seen], atol=1e-5)


def test_pooling_covers_whole_texts(monkeypatch):
    vectors = quality.index_vectors()
    texts = toy(20)[0] + [None, "", " \n"]
    whole = quality.pooled(vectors, texts)
    assert np.allclose(np.vstack([quality.pooled(vectors, [t]) for t in texts]), whole)
    assert not whole[-3:].any()


def test_tables_with_nulls_and_repeats(spark):
    texts, labels = toy()
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, texts[3]), (900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("Y", F.lit(1))
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (5, None), (12345, 0)], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, marks)).collect()
    assert len(scored) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored)
    own = {r.doc_id: r.score for r in scored if r.held_out}
    ids = [i for i in own if i is not None and i < len(labels)]
    assert auc(np.array([own[i] for i in ids]), np.array([labels[i] for i in ids])) > 0.9
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), marks)).count() == 0
    assert {round(r.score, 6) for r in quality.score(docs, quality.fit(docs, marks.limit(0))).collect()} == {0.5}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").where(held_out("doc_id")).select("score", "quality").toPandas()
    assert auc(scored.score.to_numpy(), scored.quality.to_numpy()) > 0.9
