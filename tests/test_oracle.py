"""Every query that has SQL gives the same names, types and rows as the SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

SLOW = set()
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def folder(sf_dir):
    return os.environ.get("CARDWATCH_SF_DIR", sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, name):
    with connect(folder) as con:
        assert differences(QUERIES[name](spark, folder), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_query_without_sql_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r["is_fraud"] for r in rows] == [0, 1]
