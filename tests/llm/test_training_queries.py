"""Every query with SQL gives what its SQL gives."""

import pytest
from oracle import connect, duckdb_result, spark_result

from terrace.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sf, name):
    got = spark_result(QUERIES[name](spark, sf))
    assert got == duckdb_result(connect(sf), ORACLE[name])
    assert got[1]


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
