"""Every registered query gives the rows of its SQL."""

import os

import pytest

import __spark_entry__ as entry

from .oracle import TESTDATA, compare, connect

SF_DIR = os.path.join(TESTDATA, f"sf{os.environ.get('SF', '0.001')}")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(ORACLES) <= set(QUERIES)
