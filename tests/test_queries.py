"""Every registered query against its SQL counterpart at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "rank" and df.count() > 0
