"""Reading and writing tables: Parquet, CSV, JSON documents and JDBC."""

from __future__ import annotations

import csv
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from cargoweave.functions.expressions import column

CORRUPT_RECORD = "_corrupt_record"
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Accepted and quarantined.
OUTCOMES = 2
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing = threading.Lock()
_writers: dict[SparkSession, int] = {}
_before: dict[SparkSession, str] = {}
#: Column of the part that a row of a table in parts is in (:func:`in_parts`).
PART = "_cargoweave_part"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in spark.checkpoint.dir.

    Without the setting it is a folder below the warehouse, which is shared as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path no run has written before: a job never overwrites what it reads."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
    one_task: bool = False,
) -> dict[str, str]:
    """Options for ``read_table``/``write_table`` with ``format="jdbc"``.

    With a partition column and its bounds the table is read by parallel range
    queries; rows outside the bounds are still read, by the first or last one. A whole
    table in one task has to be asked for.
    """
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
        "fetchsize": str(fetch_size),
        "numPartitions": str(partitions),
    }
    if partition_column is None and not one_task:
        raise ValueError("name a partition column with its bounds, or ask for one_task")
    if (partition_column is None) != (bounds is None):
        raise ValueError("a parallel read needs both a partition column and its bounds")
    if partition_column is not None and bounds is not None:
        low, high = bounds
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(low),
            "upperBound": str(high),
        }
    return options


def read_table(
    spark: SparkSession,
    path: str | None = None,
    format: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def deal_out(table: DataFrame, *by: str) -> DataFrame:
    """Use all cores on a table that would be read in fewer tasks than there are cores.

    A table that is read in parallel anyway is returned unchanged. Rows dealt out ``by`` the columns
    of a join that follows are not shuffled again for it.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(*by) if by else table.repartition(cores)


def write_table(
    df: DataFrame,
    path: str | None = None,
    mode: str = "errorifexists",
    format: str = "parquet",
    **options: str,
) -> None:
    writer = df.write.format(format).options(**options).mode(mode)
    writer.save(path) if path else writer.save()


def write_outcomes(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write to folders by ``outcome``. A task keeps the file of each outcome open, so that its rows
    need not be sorted, which would hold or spill all of them."""
    _hold_open(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        df.write.partitionBy("outcome").mode(mode).parquet(path)


def _hold_open(spark: SparkSession) -> None:
    if int(spark.conf.get(_OPEN_FILES)) < OUTCOMES:
        spark.conf.set(_OPEN_FILES, str(OUTCOMES))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go as soon as it is written, not when the driver
    next collects its garbage. Other plans that are run meanwhile make theirs again if they are run again."""
    with _freeing:
        if not _writers.get(spark):
            _before[spark] = spark.conf.get(_FREED, "false")
            spark.conf.set(_FREED, "true")
        _writers[spark] = _writers.get(spark, 0) + 1
    try:
        yield
    finally:
        with _freeing:
            _writers[spark] -= 1
            if not _writers[spark]:
                spark.conf.set(_FREED, _before.pop(spark))
                del _writers[spark]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to a new shared path and read it back: cuts the lineage for good."""
    path = new_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        write_table(df, path)
    return read_table(df.sparkSession, path, schema=df.schema)


@lru_cache(maxsize=64)
def _part_numbers(spark: SparkSession, parts: int) -> tuple[int, ...]:
    """For each part a number that Spark's hash puts there."""
    bucket = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("bucket")
    rows = spark.range(64 * parts).groupBy(bucket).agg(F.min("id").alias("n")).orderBy("bucket").collect()
    return tuple(r["n"] for r in rows)


def in_parts(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back with ``PART``: what a task wrote is one part, of as many as
    there are shuffle partitions, and Spark knows that equal ``PART`` are together. Joins with ``PART`` and other
    columns leave these rows where they are, however the other side comes.

    The table is one of the session's catalog, bucketed by ``PART``; its files lie in the shared folder.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _hold_open(spark)  # rows of a task are of one bucket and need no sorting
    numbers = ", ".join(map(str, _part_numbers(spark, parts)))
    part = F.expr(f"element_at(array({numbers}), pmod(spark_partition_id(), size(array({numbers}))) + 1)").cast("int")
    path = new_path(spark, name)
    table = f"{PART.strip('_')}_{path.rpartition('-')[2]}"
    with freed_shuffles(spark):
        df.withColumn(PART, part).write.option("path", path).bucketBy(parts, PART).saveAsTable(table)
    return spark.table(table)


# One dialect for both directions, so that quotes and outer spaces of values survive.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", null_text: str = ""
) -> None:
    """CSV with headings. Give NULLs a text of their own to tell them from empty values."""
    write_table(df, path, mode, "csv", nullValue=null_text, **_CSV)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = False,
    null_text: str = "",
) -> DataFrame:
    """Typed CSV; a row that does not fit the schema is kept, its text in ``_corrupt_record``.

    Headings must be those of the schema, in its order; a file with others fails the job.

    ``multi_line`` allows line breaks inside quoted values, at the price of one
    task per file. Empty values are NULL unless ``null_text`` says otherwise.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    return read_table(
        spark, path, "csv", full,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT_RECORD,
        multiLine=str(multi_line).lower(),
        nullValue=null_text,
        enforceSchema="false",
        **_CSV,
    )


#: Columns that say where a row of a CSV file came from.
SOURCE = ("source_file", "source_block", "source_modified")


def _headings(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files below ``path`` by their heading lines. Of each file the first line is found by one
    narrow aggregate; as many rows as there are files reach the driver, which lists them anyway."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    files: dict[str, list[str]] = {}
    for r in lines.groupBy("file").agg(F.min_by("value", "place").alias("heading")).collect():
        files.setdefault(r["heading"], []).append(r["file"])
    return files


def read_csv_files(
    spark: SparkSession, path: str, schema: T.StructType, null_text: str = "", delimiter: str = ","
) -> DataFrame:
    """Typed CSV files of any headings: columns are found by name (in any case and order).

    Columns that a file lacks are NULL, those that the schema lacks are left out. A row that does
    not fit its file's heading or its types is kept, its text in ``_corrupt_record``, and each row
    says which file and block it came from and when that was last changed (``SOURCE``).
    Files are read together with all others of the same heading.
    """
    known = {f.name.lower(): f for f in schema}
    parts = []
    for heading, files in sorted(_headings(spark, path).items()):
        names = next(csv.reader([heading], delimiter=delimiter))
        listed = [n.strip().lower() for n in names]
        if repeated := {n for n in listed if listed.count(n) > 1}:
            raise ValueError(f"heading {heading!r} has {sorted(repeated)} more than once")
        fields = [known.get(n) or T.StructField(f"other_{k}", T.StringType()) for k, n in enumerate(listed)]
        full = T.StructType([*fields, T.StructField(CORRUPT_RECORD, T.StringType())])
        rows = spark.read.schema(full).options(
            **{**_CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD, "nullValue": null_text, "sep": delimiter, "enforceSchema": "true"}
        ).csv(files)
        parts.append(rows.select(
            *(column(f.name) if f.name.lower() in listed else F.lit(None).cast(f.dataType).alias(f.name) for f in schema),
            CORRUPT_RECORD, F.col("_metadata.file_path").alias(SOURCE[0]), F.col("_metadata.file_block_start").alias(SOURCE[1]),
            F.col("_metadata.file_modification_time").alias(SOURCE[2]),
        ))
    if not parts:
        places = "source_file string, source_block bigint, source_modified timestamp"
        empty = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType()), *T.StructType.fromDDL(places).fields])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, parts)


def accept_csv(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the rows of ``read_csv_files`` to ``path`` in one pass, and read back the good ones and, as
    text with their places, the corrupt ones."""
    outcome = F.when(F.col(CORRUPT_RECORD).isNull(), "accepted").otherwise("quarantined")
    write_outcomes(rows.withColumn("outcome", outcome), path)
    whole = T.StructType([*rows.schema.fields, T.StructField("outcome", T.StringType())])
    written = rows.sparkSession.read.schema(whole).parquet(path)
    good = written.filter("outcome = 'accepted'").drop("outcome", CORRUPT_RECORD)
    return good, written.filter("outcome = 'quarantined'").select(CORRUPT_RECORD, *SOURCE)


#: Ids of copies that are sent to all tasks; with more the rows are shuffled.
SHARED_IDS = 500_000


def search_documents(df: DataFrame, id_column: str = "RECORD_ID") -> DataFrame:
    """One JSON document per row for a search index, keyed by ``id_column``.

    Exact copies of a row share its id; the second and later ones get their number behind it.
    Rows without an id have none here either. Give it a written table, as it is read more than once.

    Ids that occur once, nearly all, are told from others by a narrow aggregate. Shared
    ids that are few (``SHARED_IDS``) are sent to the rows, so that only rows with one are moved; with more
    all rows that have an id are, once. Documents that meet are counted, numbered, and given out as often
    as they came.
    """
    key = column(id_column)
    rows = df.select(key.alias("id"), F.to_json(F.struct(*map(column, df.columns))).alias("document"))
    counted = df.groupBy(key.alias("shared_id")).agg(F.count("*").alias("n")).where("n > 1 and shared_id is not null").select("shared_id")
    shared = stage(counted, "shared-ids")
    ids = shared.count()
    if ids == 0:
        return rows
    if ids <= SHARED_IDS:
        known = F.broadcast(shared)
        alone, copies = (rows.join(known, rows["id"] == known["shared_id"], how) for how in ("left_anti", "left_semi"))
    else:
        alone, copies = rows.where("id is null"), rows.where("id is not null")
    different = copies.repartition(F.col("id")).groupBy("id", "document").agg(F.count("*").alias("n"))
    before = Window.partitionBy("id").orderBy("document").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before), F.lit(0))
    numbered = different.select("id", "document", start.alias("start"), "n").select(
        "id", "document", F.explode(F.sequence(F.col("start") + 1, F.col("start") + F.col("n"))).alias("number")
    )
    return alone.unionByName(numbered.select(
        F.when(F.col("number") == 1, F.col("id")).otherwise(F.concat_ws("-", "id", "number")).alias("id"), "document"
    ))


def write_search_documents(
    df: DataFrame, path: str, id_column: str = "RECORD_ID", mode: str = "errorifexists", batch: int = 500_000, compression: str = "gzip"
) -> None:
    """JSON lines, one document per line, in compressed files of at most ``batch`` documents."""
    documents = search_documents(df, id_column).select("document")
    documents.write.mode(mode).option("maxRecordsPerFile", batch).text(path, compression=compression)


def write_search_actions(
    df: DataFrame, path: str, index: str, id_column: str = "RECORD_ID", mode: str = "errorifexists", batch: int = 10_000,
    compression: str = "gzip",
) -> None:
    """JSON lines as a search server loads them: before each document a line that says into which
    index it goes and under which id, compressed files of at most ``batch`` documents."""
    docs = search_documents(df, id_column)
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col("id").alias("_id")).alias("index")))
    lines = docs.select(F.concat(action, F.lit("\n"), F.col("document")).alias("value"))
    lines.write.mode(mode).option("maxRecordsPerFile", batch).text(path, compression=compression)
