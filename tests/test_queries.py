"""Every query of the registry against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import connect, difference
from checks.oracle import oracle_sql
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry_point.queries()) and set(QUERIES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = entry_point.queries()[name](spark, SF)
    assert difference(df, db, entry_point.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() == 6000
