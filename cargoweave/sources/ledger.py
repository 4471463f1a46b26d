"""Which raw tables there are, which have been processed, and who is at which.

A ledger is a folder: ``done`` has the processed names, ``claims`` has by name what runs have noted.
Every entry is a folder of its own, so that writers never meet; entries are only added.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cargoweave.functions.expressions import is_raw_table, raw_table_parts
from cargoweave.sources.tables import stage

LEDGER_SCHEMA = "table_name string"
_CLAIMS = "owner string, state string, number bigint, expires double, table_name string"
#: Seconds a claim holds unless it is given back, that choosing a number may take, and between two
#: looks at others' claims.
LEASE, CHOICE, PAUSE = 6 * 3600, 120, 0.2


def raw_names(registry: DataFrame) -> DataFrame:
    """Raw tables of a listing with the country code, year and month in their names."""
    name = F.col("table_name")
    return registry.filter(is_raw_table(name)).withColumns(raw_table_parts(name))


def unprocessed_tables(registry: DataFrame, ledger: DataFrame) -> DataFrame:
    """All raw tables of the listing that the ledger does not hold, by name."""
    names = registry.filter(is_raw_table(F.col("table_name"))).select("table_name").distinct()
    return names.join(ledger, "table_name", "left_anti").orderBy("table_name")


def _entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a folder that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The processed names, each once. Without a ledger there are none."""
    return _entries(spark, f"{path}/done", f"marked_at timestamp, {LEDGER_SCHEMA}").select("table_name").distinct()


#: Nothing has to be made before a ledger is read.
open_ledger = read_ledger


def mark_processed(names: DataFrame, path: str) -> None:
    """Add the names that the ledger at ``path`` does not hold yet; nothing is written if there are none.

    Two runs at once may both add a name, which is read once.
    """
    new = names.select("table_name").dropna().dropDuplicates()
    left = stage(new.join(read_ledger(names.sparkSession, path), "table_name", "left_anti"), "newly-done")
    if not left.isEmpty():
        left.withColumn("marked_at", F.current_timestamp()).coalesce(1).write.parquet(f"{path}/done/entry={uuid.uuid4().hex}")


def new_owner() -> str:
    return uuid.uuid4().hex


def _note(spark: SparkSession, path: str, owner: str, state: str, numbers: Sequence[tuple[str, int | None]], expires: float) -> None:
    """A folder of its own for every note: writers to one folder would clear away each other's work."""
    rows = [(owner, state, number, expires, name) for name, number in numbers]
    if rows:
        notes = spark.createDataFrame(rows, _CLAIMS).coalesce(1)
        notes.write.partitionBy("table_name").parquet(f"{path}/claims/note={uuid.uuid4().hex}")


def _live(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, dict[str, int | None]]:
    """By name the owners of claims that hold, with their numbers; None while they choose one."""
    claims = _entries(spark, f"{path}/claims", _CLAIMS).where(F.col("table_name").isin(list(names)))
    rows = claims.groupBy("table_name", "owner").agg(
        F.max("number").alias("number"), F.max("expires").alias("expires"), F.bool_or(F.col("state") == "released").alias("released")
    ).where(~F.col("released") & (F.col("expires") > time.time()))
    out: dict[str, dict[str, int | None]] = {name: {} for name in names}
    for r in rows.collect():
        out[r["table_name"]][r["owner"]] = r["number"]
    return out


def claim(spark: SparkSession, path: str, names: Sequence[str], owner: str, lease: float = LEASE) -> list[str]:
    """The names that ``owner`` may process now: nobody else has a claim on them that came first.

    Runs draw numbers as in a bakery: say that you choose, take a number above all you see, wait
    for those who are choosing, and the smallest number is served, of equal ones the smaller
    owner. That needs no lock, only that an entry is seen once it is written. A claim holds for
    ``lease`` seconds or until it is released; names already processed are not claimed. Who has not
    chosen in CHOICE seconds, having ended perhaps, is waited for no longer and gets nothing. Claims
    of one owner are for one run: take a new owner for another.
    """
    done = {r["table_name"] for r in read_ledger(spark, path).collect()}
    wanted = sorted(set(names) - done)
    if not wanted:
        return []
    started = time.time()
    _note(spark, path, owner, "choosing", [(n, None) for n in wanted], started + min(lease, CHOICE))
    seen = _live(spark, path, wanted)
    mine = {n: 1 + max((x or 0 for x in seen[n].values()), default=0) for n in wanted}
    _note(spark, path, owner, "numbered", list(mine.items()), started + lease)
    if time.time() > started + CHOICE:
        release(spark, path, wanted, owner)
        return []
    while True:
        live = _live(spark, path, wanted)
        if all(number is not None for n in wanted for number in live[n].values()):
            break
        time.sleep(PAUSE)
    won = [n for n in wanted if live[n] and min((number, who) for who, number in live[n].items()) == (mine[n], owner)]
    release(spark, path, [n for n in wanted if n not in won], owner)
    # whoever had a name before may have finished it since the first look
    done = {r["table_name"] for r in read_ledger(spark, path).collect()} if won else set()
    return [n for n in won if n not in done]


def release(spark: SparkSession, path: str, names: Sequence[str], owner: str) -> None:
    """Give claims back, so that others can take them at once."""
    _note(spark, path, owner, "released", [(n, None) for n in names], 0.0)
