"""Runs every registered query next to its SQL: python -m checks.compare SF_DIR [NAME ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value: object) -> object:
    return None if isinstance(value, float) and math.isnan(value) else value


def rows_of(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when the two results are equal, else what differs."""
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    wanted = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if wanted == got:
        return None
    return (
        f"{got.total()} rows against {wanted.total()}; "
        f"only here {list((got - wanted).items())[:2]}, only in SQL {list((wanted - got).items())[:2]}"
    )


def main(sf_dir: str, only: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, texts, failed = connect(sf_dir), oracle_sql(), 0
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(run(spark, sf_dir), db, texts[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
