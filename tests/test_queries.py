"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import pytest

from __spark_entry__ import corpus_queries, entry, oracle_sql, queries
from check import compare, duck

from .conftest import SF

SQL = oracle_sql()
# The corpus operators have tests of their own.
NAMES = [name for name in queries() if name not in corpus_queries()]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    same, note = compare(spark, con, name, queries()[name], SQL.get(name), SF)
    assert same, note


def test_every_query_has_sql():
    assert set(SQL) >= set(NAMES)


def test_entry(spark):
    assert entry(spark).count() > 0
