"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from millrace.plans.catalog import QUERIES
from millrace.plans.catalog_sql import ORACLES
from tools.check_oracle import difference

duckdb = pytest.importorskip("duckdb")

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="benchmark tables not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    ours = entry.queries()[name](spark, str(SF_DIR)).toPandas()
    assert difference(ours, db.execute(entry.oracle_sql()[name]).df()) is None
