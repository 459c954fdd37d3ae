"""Every registered query that has a SQL twin equals it, value by value."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from conftest import SF

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_twin_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == []
