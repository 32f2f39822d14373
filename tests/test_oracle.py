"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, oracle_connection

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    ok, message = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert ok, message


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
