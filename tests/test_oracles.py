"""Every registered query against its SQL on the smallest given tables."""

import pytest

import __spark_entry__ as contract
from checks import ORACLES
from checks.compare import connect, difference
from shelfline.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert "total_daily_revenue" in df.columns and df.count() == 17


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = difference(spark, con, name, QUERIES[name], SF)
    assert problem is None
