"""Queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from millrace.llm.common import kept, table
from millrace.llm.oracles import ORACLES
from millrace.llm.queries import QUERIES
from tools.check_oracle import difference

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="benchmark tables not there")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    db = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    assert difference(QUERIES[name](spark, str(SF_DIR)).toPandas(), db.execute(ORACLES[name]).df()) is None


def test_pipeline(spark):
    docs = table(spark, str(SF_DIR), "documents")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept(stage(spark, docs, str(SF_DIR)), "test-stage")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(SF_DIR))
    assert pieces.select("doc_id").distinct().count() == counts[-1]
