"""The registered queries against their SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from tests.oracle import connect, same
from tickloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE_SQL[name])


def test_ten_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
