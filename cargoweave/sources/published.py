"""Tables that are replaced as a whole: every version has a folder, and a manifest says which counts.

A version is written to a folder of its own and published when it is complete, by a line that is
added to the manifest. Readers take the version of the last line, so that a run that ends
half-way leaves the one before as it was.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cargoweave.sources.tables import read_table

_MANIFEST = "version string, sequence bigint, published_at timestamp"


def new_version(path: str) -> str:
    """A folder for the next version; nothing reads it before it is published."""
    return f"{path}/v-{uuid.uuid4().hex}"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, the version that counts first; empty if nothing was published."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], _MANIFEST)
    return rows.orderBy(F.desc("sequence"), F.desc("published_at"), F.desc("version"))


def publish(spark: SparkSession, path: str, version: str) -> None:
    """From now on readers of ``path`` get ``version``, a folder of ``new_version``."""
    last = versions(spark, path).first()
    row = [(version.rsplit("/", 1)[-1], (last["sequence"] if last else 0) + 1)]
    line = spark.createDataFrame(row, "version string, sequence bigint").withColumn("published_at", F.current_timestamp())
    line.coalesce(1).write.parquet(f"{path}/manifest/line={uuid.uuid4().hex}")


def published(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts, None if there is none."""
    last = versions(spark, path).first()
    return f"{path}/{last['version']}" if last else None


def read_published(
    spark: SparkSession, path: str, schema: T.StructType | None = None, part: str = "rows"
) -> DataFrame:
    """A part of the version that counts; FileNotFoundError if nothing was published."""
    folder = published(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing was published at {path}")
    return read_table(spark, f"{folder}/{part}", schema=schema)
