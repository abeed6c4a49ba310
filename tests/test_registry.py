"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as registered
from checks.compare import difference, oracle_connection

SF = "/root/testdata/sf0.001"
OWN = registered.GROUPS[:4]
QUERIES = {name: query for group in OWN for name, query in group.QUERIES.items()}
ORACLES = {name: sql for group in OWN for name, sql in group.ORACLES.items()}


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, oracle, name):
    assert difference(QUERIES[name](spark, SF), oracle, ORACLES[name]) is None


def test_all_are_registered():
    assert set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["doc_id", "status", "predicted", "target", "text"] and df.count() > 0
