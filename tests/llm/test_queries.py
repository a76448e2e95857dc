"""Every corpus query over the smallest tables, next to its SQL or to what its columns must satisfy."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from reclake.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.conftest import ODD

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(entry.queries()[name](spark, SF_DIR), connect(SF_DIR), entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op12_embedding_whitening"}))
def test_query_answers_for_every_row(spark, name):
    source = "pages" if name == "op9_html_text" else "documents"
    key = "page_id" if source == "pages" else "doc_id"
    wanted = sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{source}.parquet").select(key).collect())
    assert sorted(r[key] for r in entry.queries()[name](spark, SF_DIR).collect()) == wanted


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == [*range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and "pipeline" in entry.queries()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, set(r.doc_id for r in docs.select("doc_id").collect())
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_DIR), "test")
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= seen and len(left) > 100
        assert number == 4 or docs.columns == columns
        seen = left
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {tuple(r) for r in docs.collect()}


def test_stages_of_odd_rows_and_of_nothing(spark, docs, odd):
    texts = {(number, text or "") for number, text in ODD}
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, odd, SF_DIR)
        rows = out.collect()
        assert len(rows) <= len(ODD) and {r.doc_id for r in rows} <= {number for number, _ in ODD}
        if at < 4:
            assert out.columns == odd.columns and {r["_key"] for r in rows} <= {"k"}
        if at in (2, 3):  # stages that only choose documents
            assert {(r.doc_id, r.text or "") for r in rows} <= texts
        assert len(rows) == len(ODD) or at in (0, 2, 3)
        assert stage(spark, docs([]), SF_DIR).count() == 0
