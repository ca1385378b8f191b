"""Every query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from salesdw.checks.compare import connect, differences
from salesdw.checks.oracle import all_sql
from salesdw.checks.queries import all_queries

SQL = all_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(SQL) == set(all_queries())
    assert set(SQL) <= set(entry.oracle_sql()) and set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(name, spark, duck):
    assert differences(entry.queries()[name](spark, SMALL), duck, SQL[name]) == []


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["sales_month", "status", "row_count", "qty_ordered", "grand_total"]
    assert result.count() > 0
