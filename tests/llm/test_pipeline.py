"""The corpus pipeline, stage by stage, and the SQL of the queries that have one."""

from __future__ import annotations

import pytest
from oracle import connect, differences

import corpus_pipeline as pipeline
from tapmart.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_against_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE_SQL[name]) == []


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.freeze(stage(spark, docs, SF_DIR), f"test-{name}")
        assert docs.columns == COLUMNS
        if name == "language":
            assert docs.count() >= 0.97 * before
        if name == "near_copies":
            assert docs.select("doc_id").distinct().count() == docs.count() < before
    pieces = pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_on_odd_rows_and_on_none(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0)]
    rows += [(2, "a line of text", "en", None, 14), (2, "a line of text", "en", None, 14)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in pipeline.STAGES:
            docs = pipeline.freeze(stage(spark, docs, SF_DIR), f"test-{name}")
        ids = {r["doc_id"] for r in docs.collect()}
        assert ids == ({2} if given else set())
