"""Every registered query gives what its SQL gives."""

import pytest
from oracle import connect, duckdb_result, spark_result

import __spark_entry__ as entry_module
from terrace_queries import ORACLE as SQL
from terrace_queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    got = spark_result(QUERIES[name](spark, sf))
    assert got == duckdb_result(con, SQL[name])
    assert got[1]


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
