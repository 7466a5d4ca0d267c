"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from pagemill.plans.oracles import ORACLES
from pagemill.plans.queries import QUERIES
from tests.compare import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    difference = compare(spark, duck, FOLDER, QUERIES[name], ORACLES[name])
    assert difference is None, difference


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    hits = contract.entry(spark)
    assert hits.count() == 18
    assert hits.columns == [
        "query_id", "rank", "source", "page", "parser", "content_length", "preview", "score",
    ]
