"""Registered queries that have SQL against it, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from marketspark.llm.queries import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_each_operator_has_one_query():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, oracle, name):
    found = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(found.columns)
    cursor = oracle.execute(ORACLES[name])
    names = [item[0] for item in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in cursor.fetchall())
    assert sorted(repr(tuple(row)) for row in found.select(*columns).collect()) == expected
