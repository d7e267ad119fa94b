"""Every registered query against its SQL twin, as the contract runs them."""

import pytest

import __spark_entry__ as contract
from compare import SF_DIR, connect, first_difference, oracle_rows, spark_rows

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = spark_rows(QUERIES[name](spark, SF_DIR))
    if name in ORACLES:
        assert first_difference(got, oracle_rows(con, ORACLES[name])) is None
    else:
        assert got[1]


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 25
