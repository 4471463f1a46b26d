import json

import pytest
from pyspark.sql import functions as F

from cargoweave.functions import expressions as X
from cargoweave.sources import ledger as L, tables as T


def test_shared_folder_is_the_sessions(spark):
    assert T.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert T.new_path(spark, "x") != T.new_path(spark, "x")


def test_stage_reads_back_the_same_rows(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "")], "`a (x)` int, b string")
    staged = T.stage(df, "stage")
    assert staged.schema.fieldNames() == ["a (x)", "b"] and rows(staged) == rows(df)


def test_write_does_not_replace_unasked(spark):
    df, path = spark.range(3), T.new_path(spark, "once")
    T.write_table(df, path)
    with pytest.raises(Exception, match="already exists"):
        T.write_table(df, path)


def test_csv_keeps_rows_it_cannot_type(spark):
    path = T.new_path(spark, "csv")
    spark.createDataFrame(
        [("id,qty",), ("1,2.5",), ("x,many",), ("3,",)], "value string"
    ).coalesce(1).write.text(path)
    df = spark.createDataFrame([], "id int, qty double")
    got = {r.id: r for r in T.read_csv(spark, path, df.schema).collect()}
    assert got[1].qty == 2.5 and got[1][T.CORRUPT_RECORD] is None
    assert got[3].qty is None and got[3][T.CORRUPT_RECORD] is None
    assert got[None][T.CORRUPT_RECORD] == "x,many"


def test_csv_round_trip_of_awkward_text(spark, rows):
    df = spark.createDataFrame(
        [(1, 'say "hi", ok'), (2, ""), (3, None), (4, " pad "), (5, "two\nlines")], "id int, t string"
    )
    path = T.new_path(spark, "csv-text")
    T.write_csv(df, path, null_text=r"\N")
    back = T.read_csv(spark, path, df.schema, multi_line=True, null_text=r"\N")
    assert rows(back.drop(T.CORRUPT_RECORD)) == rows(df)


def test_search_documents(spark):
    df = spark.createDataFrame([("r1", 1.5, None), ("r2", None, "é")], "RECORD_ID string, q double, t string")
    path = T.new_path(spark, "docs")
    T.write_search_documents(df, path)
    docs = {d["RECORD_ID"]: d for d in (json.loads(r.value) for r in spark.read.text(path).collect())}
    assert docs == {"r1": {"RECORD_ID": "r1", "q": 1.5}, "r2": {"RECORD_ID": "r2", "t": "é"}}
    ids = [r.id for r in T.search_documents(df.union(df.limit(1))).orderBy("id").collect()]
    assert ids in (["r1", "r1-2", "r2"], ["r1", "r2", "r2-2"])


def test_csv_headings_are_held_against_the_schema(spark):
    path = T.new_path(spark, "csv-order")
    T.write_csv(spark.createDataFrame([("x", "y")], "b string, a string"), path)
    with pytest.raises(Exception, match="CSV header does not conform|headers|schema"):
        T.read_csv(spark, path, spark.createDataFrame([], "a string, b string").schema).collect()


def test_jdbc_options_for_a_parallel_read():
    options = T.jdbc_options("jdbc:postgresql://h/db", "cr.t", "u", "p", "id", (1, 1000), 8)
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("id", "1", "1000")
    assert options["numPartitions"] == "8" and options["dbtable"] == "cr.t"
    assert "partitionColumn" not in T.jdbc_options("u", "t", "u", "p", one_task=True)
    with pytest.raises(ValueError):
        T.jdbc_options("u", "t", "u", "p")
    with pytest.raises(ValueError):
        T.jdbc_options("u", "t", "u", "p", partition_column="id")


NAMES = [
    "yeni_veri_cr_2023_12", "yeni_veri_cr_2024_01_imp", "yeni_veri_ar_2024_02", "processed_tables",
    "yeni_veri_cr_2024_01_imp_islendi", "tmp_x", "yeni_veri_c_2024_01", "x_yeni_veri_cr_2024_01",
]


def test_discovery(spark):
    registry = spark.createDataFrame([(n,) for n in NAMES], "table_name string")
    ledger = spark.createDataFrame([("yeni_veri_cr_2023_12",), (None,)], "table_name string")
    got = [r.table_name for r in L.unprocessed_tables(registry, ledger).collect()]
    assert got == ["yeni_veri_ar_2024_02", "yeni_veri_cr_2024_01_imp"]
    parts = {r.table_name: r for r in L.raw_names(registry).collect()}
    row = parts["yeni_veri_cr_2024_01_imp"]
    assert (row.country_code, row.year, row.month) == ("CR", 2024, 1) and len(parts) == 3


def test_ledger_holds_each_name_once(spark, rows):
    path = T.new_path(spark, "ledger")
    L.open_ledger(spark, path)
    assert L.read_ledger(spark, path).count() == 0
    L.mark_processed(spark.createDataFrame([("a",)], L.LEDGER_SCHEMA), path)
    new = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], L.LEDGER_SCHEMA)
    for _ in range(2):
        L.mark_processed(new, path)
    assert rows(L.read_ledger(spark, path)) == [("a",), ("b",)]


def test_data_type_by_name(spark):
    df = spark.createDataFrame([("t_imp",), ("T_EXP",), ("t",), (None,)], "n string")
    got = [r[0] for r in df.select(X.data_type_of(F.col("n"))).collect()]
    assert got == ["IMPORT", "EXPORT", None, None]
    assert X.data_type_of_name("cr_imp_2024") == "IMPORT" and X.data_type_of_name("exp") == "EXPORT"
    with pytest.raises(ValueError):
        X.data_type_of_name("cr_2024")


def test_csv_files_of_any_heading(spark, rows):
    path = T.new_path(spark, "drift")
    T.write_csv(spark.createDataFrame([(1, "x", 1.5)], "id int, name string, v double"), f"{path}/1")
    T.write_csv(spark.createDataFrame([(2.5, "y, z", "extra", 2)], "V double, Name string, other string, ID int"), f"{path}/2")
    T.write_csv(spark.createDataFrame([(3,)], "id int"), f"{path}/3")
    spark.createDataFrame([("id,v",), ("4,oops",), ("5,5.5",), ("6",), ("7,7.5,7",)], "l string").coalesce(1).write.text(f"{path}/4")
    schema = spark.createDataFrame([], "id int, name string, v double").schema
    read = T.read_csv_files(spark, f"{path}/*", schema)
    good, bad = T.accept_csv(read, T.new_path(spark, "split"))
    assert rows(good.select("id", "name", "v")) == sorted([(1, "x", 1.5), (2, "y, z", 2.5), (3, None, None), (5, None, 5.5)], key=repr)
    held = bad.collect()
    assert sorted(r[T.CORRUPT_RECORD] for r in held) == ["4,oops", "6", "7,7.5,7"]
    assert all("/4/" in r["source_file"] and r["source_block"] == 0 and r["source_modified"] for r in held)
    spark.createDataFrame([("id,id",), ("1,2",)], "l string").coalesce(1).write.text(f"{path}/5")
    with pytest.raises(ValueError, match="more than once"):
        T.read_csv_files(spark, f"{path}/*", schema)


def test_copies_get_numbers_wherever_they_are_read(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 3)] + [("c", 4)] * 7, "RECORD_ID string, v int").repartition(3)
    table = T.stage(df, "rows")
    found = T.search_documents(table).collect()
    assert sorted(r.id for r in found if r.id) == ["a", "b", "c", *[f"c-{k}" for k in range(2, 8)]]
    assert sum(r.id is None for r in found) == 2
    path = T.new_path(spark, "actions")
    T.write_search_actions(table, path, "ix", batch=2)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 22 and sum(x.startswith('{"index":{"_index":"ix"') for x in lines) == 11
    files = spark.read.text(path).groupBy(F.col("_metadata.file_path")).count().collect()
    assert max(f["count"] for f in files) <= 4


@pytest.mark.parametrize("few", [10, 1])
def test_copies_of_few_or_many_ids_are_numbered(spark, monkeypatch, plan, few):
    monkeypatch.setattr(T, "SHARED_IDS", few)
    df = spark.createDataFrame([("a", 1), (None, 3), (None, 3), ("b", 1), ("b", 2)] + [("c", 4)] * 3, "RECORD_ID string, v int").repartition(3)
    table = T.stage(df, "rows")
    documents = T.search_documents(table)
    # none is sorted by its id and, of those that are alone, none is moved
    assert "SortMergeJoin" not in plan(documents)
    found = documents.collect()
    assert sorted(r.id for r in found if r.id) == ["a", "b", "b-2", "c", "c-2", "c-3"]
    assert len(found) == 8 and sum('"v":3' in r.document for r in found) == 2
    alone = T.search_documents(table.where("v = 1"))
    assert "Exchange" not in plan(alone) and alone.count() == 2
