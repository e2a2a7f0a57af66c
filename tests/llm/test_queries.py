"""The registered queries against their SQL, and the pipeline against its stages."""

import os
import zlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from dictspark.llm import decontaminate, pii, simhash
from dictspark.llm.common import table
from dictspark.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.oracle import TESTDATA, compare, connect

SF_DIR = os.path.join(TESTDATA, "sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_ORACLES) <= set(LLM_QUERIES) <= set(entry.queries())
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, LLM_QUERIES[name], LLM_ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", ["op5_quality", "op9_toxicity"])
def test_scores_cover_all_documents(spark, name):
    docs = table(spark, SF_DIR, "documents")
    rows = LLM_QUERIES[name](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)


def test_pipeline_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    kept, stages = docs, corpus_pipeline.STAGES
    for _, stage in stages[:-1]:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = spark.createDataFrame(stage(spark, kept, SF_DIR).collect(), docs.schema)
        after = {r.doc_id: r.text for r in kept.collect()}
        assert kept.columns == docs.columns and set(after) <= set(before) and len(after) == kept.count()
    assert simhash.near_duplicates(kept).where("doc_id <> component_id").count() <= 1  # masking may make two texts alike
    assert decontaminate.matches(kept, table(spark, SF_DIR, "benchmark")).count() == 0
    assert pii.find(kept).where("size(filter(spans, s -> s.kind in ('email', 'card', 'iban'))) > 0").count() == 0
    pieces = stages[-1][1](spark, kept, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(after)


def test_pipeline_runs_to_its_end(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
