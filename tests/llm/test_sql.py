"""Queries that SQL can express, against it."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tests.support import difference
from tradewind.llm import registered


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    assert difference(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name]) is None
