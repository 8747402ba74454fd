"""Every registered query against its comparison SQL on the smallest provided scale."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, database

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    query = entry.queries()[name]
    if name in SQL:
        assert compare(spark, con, name, query, SQL[name], SF) is None
    else:
        assert query(spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(SQL) <= set(entry.queries())
