"""Registered queries against their SQL, at the smallest scale."""

import pytest
from oracle import database, difference

from hirelake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert difference(spark, database(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF) is None
