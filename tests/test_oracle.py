"""Every registered query against its SQL, at the smallest scale."""

import pytest
from oracle import database, difference

import __spark_entry__ as entry_points
from hirelake import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, QUERIES[name], SQL[name], SF) is None
