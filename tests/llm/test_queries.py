"""The training-data queries that SQL can express, against it, on the smallest tables."""

import os

import duckdb
import pytest

from cargoweave.llm.queries import ORACLE_SQL, QUERIES
from checks.compare import difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "labels"):
        path = f"{SF}/{name}.parquet"
        db.execute(f"create view {name} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return db


def test_sql_is_of_registered_queries():
    assert set(ORACLE_SQL) <= set(QUERIES) and len(QUERIES) == 14


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF), db, ORACLE_SQL[name]) is None
