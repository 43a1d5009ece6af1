"""The queries that SQL can express, against their SQL."""

import pytest

from checks.compare import connect, difference
from shelfline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert difference(spark, connect(SF), name, QUERIES[name], SF, ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
