"""Every query of the engine against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from tests.oracle import connect, same
from tickloom.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    same(queries.QUERIES[name](spark, SF), con, queries.ORACLE_SQL[name])


def test_depth10_of_the_tape(spark):
    rows = queries.depth10_throttled(spark, SF).collect()
    assert rows and all(len(r.bid_prices) == len(r.ask_sizes) == 10 for r in rows)
    assert all(r.bid_prices[0] > 0 and list(r.bid_prices) == sorted(r.bid_prices, reverse=True) for r in rows)
