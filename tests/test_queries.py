"""Every registered query against its SQL equivalent, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = ("lineitem", "events")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(rows) -> list[tuple]:
    return sorted(tuple("" if v is None else str(v) for v in row) for row in rows)


def test_every_query_has_an_equivalent():
    assert set(contract.QUERIES) == set(contract.ORACLES)


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query_equals_sql(spark, oracle, name):
    found = contract.queries()[name](spark, str(SF_DIR))
    columns = sorted(found.columns)
    cursor = oracle.execute(contract.oracle_sql()[name])
    names = [item[0] for item in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = comparable(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert comparable(found.select(*[f"`{column}`" for column in columns]).collect()) == expected


def test_entry_is_the_daily_summary(spark):
    result = contract.entry(spark)
    assert {"symbol", "trade_date", "open_price", "buy_ratio"} <= set(result.columns)
    assert result.count() > 0
