import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dictspark.llm import packing
from dictspark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def encoder():
    return packing.WordIds(tokenizer_path())


def ids_of(encoder, *texts):
    ids, sizes = encoder.ids(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "", " ", "Hello, World! it's don't we'll 'sixty 12.5%", "É élan ÇA straße ÷×", "日本語 テキスト 한국어", "é café İİ", "a\x1cb\x85c d e",
    "<|endoftext|> x<|startoftext|>y <| |>", "ΑΣ ΟΔΟΣ σας", "x" * 3000, "!!!'s ''t '' 's", "tab\tnew\nline\r\x0b\x0c end", "ﬁ ½ ² ª º µ ß ẞ", "𝄞 😀😀 a😀b", "​ zero​width ﻿ bom",
]


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_ids_are_the_tokenizers(encoder, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK_CHARS", block)
    rng = random.Random(3)
    alphabet = "abcXYZ éÀß'.,!<|>0123-\n"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    for text in texts:
        assert ids_of(encoder, text) == [plain(encoder, text)], text
    assert ids_of(encoder, *texts) == [plain(encoder, text) for text in texts]
    assert ids_of(encoder, *(t for t in texts if t.isascii())) == [plain(encoder, t) for t in texts if t.isascii()]


def test_ids_without_room_to_remember(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    small = packing.WordIds(tokenizer_path())
    for text in TEXTS * 2:
        assert ids_of(small, text) == [plain(small, text)]


def test_another_tokenizer_is_taken_as_it_is():
    import public_tokenizers

    other = packing.WordIds(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    assert ids_of(other, "Hello,  World", "") == [plain(other, "Hello,  World"), []]


def test_piece_lengths():
    sizes = np.array([1, 2, 3, 15, 16, 17, 100, 4095, 4096, 4097, 9000])
    all_lengths, docs = packing.piece_lengths(sizes, 16)
    assert sorted(docs) == docs.tolist()
    for i, n in enumerate(sizes):
        lengths = all_lengths[docs == i].tolist()
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        assert all(x <= 16 and x & (x - 1) == 0 for x in lengths)
        assert len([x for x in lengths if x < 16]) == len({x for x in lengths if x < 16})


def test_pieces_hold_every_id_once(spark, encoder):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "again"), (3, "again"), (99, None), (50, "word " * 10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(0)).withColumn("LENGTH", F.lit(0))
    pieces = packing.pack(docs, tokenizer_path(), longest=64).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert all(p.offset == 0 and p.length == 1 << p.bucket <= 64 for p in pieces)
    expected = sorted([(i, plain(encoder, t) + [2]) for i, t in rows], key=str)
    docs_ids: dict = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id & ((1 << 56) - 1))):
        own = docs_ids.setdefault(p.doc_id, [])
        if p.start == 0:
            own.append([])
        assert len(own[-1]) == p.start
        own[-1] += np.frombuffer(p.ids, "<u4").tolist()
        assert len(p.ids) == 4 * p.length
        assert p.doc_tokens >= p.start + p.length
    assert sorted([(k, x) for k, v in docs_ids.items() for x in v], key=str) == expected
    digest = packing.digest(packing.pack(docs, tokenizer_path(), longest=64)).collect()
    assert {(p.sequence_id, p.ids_crc32) for p in digest} == {(p.sequence_id, zlib.crc32(p.ids)) for p in pieces}
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, tokenizer_path(), longest=100)


def test_whole_documents_table(spark, encoder):
    path = f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    docs = spark.read.parquet(path)
    ids = {r.doc_id: plain(encoder, r.text) + [2] for r in docs.collect()}
    for p in packing.digest(packing.pack(docs, tokenizer_path())).collect():
        own = np.array(ids[p.doc_id], "<u4")
        assert p.doc_tokens == len(own)
        assert p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes())
