import hashlib
import os
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from dictspark.llm import warc

SCHEMA = "page_id long, url string, html string"


def rows_of(n=300):
    rng = random.Random(9)
    pool = ["".join(rng.choices("abc <é>\r\n", k=k)) for k in (0, 99, 100, 150, 3000, 40_000)]
    rows = [(i, f"http://h/{i}?%20\r\n:é", rng.choice(pool + [f"own {i} " * 30])) for i in range(n)]
    return rows + [(1000, None, None), (7, "again", rows[7][2]), (None, "x", "no id " * 50), (None, "y", "no id " * 50), (None, "z", pool[4])]


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None and len(data) >= 100:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        head = first.get(data)
        revisit = head is not None and head != page_id
        out.append((page_id, url, "revisit" if revisit else "response", head if revisit else None, hashlib.sha256(data).hexdigest(), len(data), None if revisit else data))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def index(spark):
    pages = spark.createDataFrame(rows_of(), SCHEMA).withColumn("digest", F.lit("x")).withColumn("Payload", F.lit(1))
    return warc.write_bundles(pages.coalesce(2), warc.archive_folder(spark), frame_bytes=20_000, bundle_bytes=20_000)


def values(df):
    return sorted(((r.page_id, r.url, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in df.collect()), key=str)


def test_all_records_come_back(index):
    assert values(warc.read_bundles(index)) == expected(rows_of())
    short = warc.read_bundles(index, payloads=False)
    assert values(short) == sorted([(*r[:6], None) for r in expected(rows_of())], key=str)


def test_records_by_their_place(index):
    some = index.where("page_id % 17 = 0 OR page_id IS NULL")
    ids = {r.page_id for r in some.collect()}
    assert values(warc.read_records(some)) == [r for r in expected(rows_of()) if r[0] in ids]


def test_bundles_are_plain_zstandard(index):
    total = 0
    for (uri,) in index.select("bundle").distinct().collect():
        files, path = warc.filesystem(uri)
        with files.open_input_file(path) as file:
            table = warc.seek_table(file)
            file.seek(0)
            raw = file.read()
        unpacker = zstandard.ZstdDecompressor()
        text = b"".join(unpacker.decompress(raw[at : at + packed], max_output_size=size) for at, packed, size in table)
        with unpacker.stream_reader(raw, read_across_frames=True) as reader:
            assert reader.read() == text
        total += text.count(b"WARC/1.1\r\n")
    assert total >= len(rows_of())


def test_frames_hold_several_records(index):
    frames = index.groupBy("bundle", "frame").count().collect()
    bundles = {r.bundle: max(f.frame for f in frames if f.bundle == r.bundle) for r in frames}
    assert len(bundles) > 2 and max(bundles.values()) > 1 and max(r["count"] for r in frames) > 1
    late = index.where("frame > 0 AND record_start > 0")
    assert late.where("frame_start > 0").count() == late.count() > 0
    ids = {r.page_id for r in late.collect()}
    assert {r[0] for r in values(warc.read_records(late))} == ids


def test_empty_and_broken(spark, tmp_path):
    pages = spark.createDataFrame([], SCHEMA)
    empty = warc.write_bundles(pages, f"{tmp_path}/a")
    assert empty.count() == 0 and warc.read_bundles(empty).count() == 0
    assert not os.path.exists(f"{tmp_path}/a")
    (tmp_path / "x").write_bytes(b"0" * 40)
    with pytest.raises(ValueError), open(tmp_path / "x", "rb") as file:
        warc.seek_table(file)
