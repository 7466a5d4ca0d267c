"""Registered queries against their SQL twins, and the pipeline stage by stage."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from pagemill.llm.queries import ORACLES, QUERIES
from pagemill.session import table
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    difference = compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name])
    assert difference is None, difference


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_stages_keep_the_columns_and_only_drop_rows(spark, edge, nothing):
    for docs in (table(spark, FOLDER, "documents"), edge, nothing):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, FOLDER).cache()
            assert after.columns == columns and after.count() <= docs.count()
            docs = after
        placed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
        assert placed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
