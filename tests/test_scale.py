"""What keeps the shuffles of large tables few and narrow."""

import pytest

from pyspark.sql import functions as F

from cargoweave.operators import conform as C
from cargoweave.operators.lookup import found, left_lookup, lookup_table, prepared
from cargoweave.plans import stages as S
from cargoweave.profiles import CR_IMPORT
from cargoweave.sources import ledger as L, tables as T
from checks import stand_ins as D

SF = "/root/testdata/sf0.001"


def test_each_use_of_a_lookup_is_reduced_to_its_own_keys(spark):
    fact = spark.range(1000).select((F.col("id") % 3).alias("few"), F.col("id").alias("many"))
    table = spark.range(5000).select(F.col("id").alias("k"), F.lit("value").alias("v"))
    lookup = lookup_table(table, ["k"], ["v"], broadcast_bytes=1000)
    few, many = prepared(fact, [(lookup, {"k": F.col("few")}), (lookup, {"k": F.col("many")})])
    assert few.small and sorted(r["k"] for r in few.rows.collect()) == [0, 1, 2]
    assert not many.small and many.rows.count() == 1000


def test_lines_are_not_shuffled_by_customer(spark, plan, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = plan(D.lines(spark, SF)).splitlines()
    (place,) = (i for i, line in enumerate(lines) if "hashpartitioning(o_custkey" in line)
    assert lines[place - 1].startswith("Input") and "l_" not in lines[place - 1]


def test_a_split_opens_the_files_of_both_outcomes(spark, conf, tmp_path, rows):
    conf("spark.sql.maxConcurrentOutputFileWriters", "0")
    df = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, "accepted").otherwise("quarantined").alias("outcome"))
    T.write_outcomes(df, f"{tmp_path}/split")
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2
    assert rows(spark.read.parquet(f"{tmp_path}/split").select("id", "outcome")) == rows(df)


def test_names_are_computed_once_to_be_marked(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(name):
        seen.add(1)
        return name

    names = spark.createDataFrame([("yeni_veri_cr_2024_01_imp",)], "table_name string")
    looked = names.select(F.udf(look, "string").asNondeterministic()("table_name").alias("table_name"))
    L.mark_processed(looked, f"{tmp_path}/ledger")
    assert seen.value == 1 and L.read_ledger(spark, f"{tmp_path}/ledger").count() == 1


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_kept_lookups_give_the_same_table(spark, limit, rows):
    raw = T.stage(D.raw_cr_import(spark, SF).limit(300), "raw")
    lookups = D.lookups(spark, SF, broadcast_bytes=limit)
    kept = lookups.kept()
    assert ("lookup-" in "".join(kept.companies.rows.inputFiles())) == (limit == 0)
    got = S.process(raw, CR_IMPORT, kept)
    assert rows(got) == rows(S.process(raw, CR_IMPORT, D.lookups(spark, SF)))
    names = [(f.name, f.dataType) for f in S.processed_schema(raw, CR_IMPORT, kept)]
    assert names == [(f.name, f.dataType) for f in got.schema]


def test_ids_that_a_table_brings_stay_as_they_are(spark):
    raw = D.raw_cr_import(spark, SF).limit(20).withColumn("record_id", F.lit("not hex"))
    processed = S.process(raw, CR_IMPORT, D.lookups(spark, SF, broadcast_bytes=0))
    assert {r[0] for r in processed.select("record_id").collect()} == {"not hex"}


def test_rows_in_parts_are_not_shuffled_for_large_lookups(spark, plan, conf, rows):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    keys = F.when(F.col("id") % 3 > 0, (F.col("id") * 7919) % 701)  # a third has none, others come often
    fact = spark.range(20000).select(keys.alias("a"), (F.col("id") % 611).cast("string").alias("b"), F.lit("wide").alias("v"), F.lit("w").alias("w"))
    known = spark.range(600).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t"))
    (by_number, by_text) = (lookup_table(known, [k], [v], broadcast_bytes=0) for k, v in (("k", "t"), ("t", "k")))

    def looked_up(df):
        df = left_lookup(df, by_number, {"k": F.col("a")}, {"v": F.coalesce(found("t"), F.col("v"))}, hot=[])
        return left_lookup(df, by_text, {"t": F.col("b")}, {"w": F.coalesce(found("k").cast("string"), F.col("w"))}, hot=[])

    placed = looked_up(T.in_parts(fact, "rows"))
    text = plan(placed)
    assert not [line for line in text.splitlines() if line.startswith("Input") and "Exchange" in line]
    assert "Bucketed: true" in text and "hashpartitioning(_code" not in text
    assert rows(placed.drop(T.PART)) == rows(looked_up(fact))


def test_process_reads_a_raw_table_once_where_lookups_are_large(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text

    raw = T.stage(D.raw_cr_import(spark, SF).limit(200), "raw")
    looked = raw.withColumn("UNIT", F.udf(look, "string").asNondeterministic()("UNIT"))
    got = S.process(looked, CR_IMPORT, D.lookups(spark, SF, broadcast_bytes=0))
    assert T.PART not in got.columns
    assert rows(got) == rows(S.process(raw, CR_IMPORT, D.lookups(spark, SF)))
    assert seen.value == 200


def test_repair_reads_held_rows_once_where_lookups_are_large(spark, rows):
    processed = T.stage(S.process(D.raw_cr_import(spark, SF).limit(200), CR_IMPORT, D.lookups(spark, SF)), "processed")
    seen = spark.sparkContext.accumulator(0)

    def look(text):
        seen.add(1)
        return text

    held = processed.withColumn("HS_CODE", F.udf(look, "string").asNondeterministic()("HS_CODE"))
    got = S.remediate(held, D.lookups(spark, SF, broadcast_bytes=0))
    assert rows(got) == rows(S.remediate(processed, D.lookups(spark, SF)))
    assert seen.value == 200


def test_shuffles_are_freed_while_tables_are_written(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with T.freed_shuffles(spark), T.freed_shuffles(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before


def test_texts_are_read_once_by_each_parser(spark, plan):
    df = spark.createDataFrame([(" 1.5 ", "2")], "QUANTITY string, CIF_VALUE string")
    typed = C.type_columns(df)
    assert typed.columns == ["QUANTITY", "CIF_VALUE", C.FAILED_CASTS]
    assert plan(typed).count("regexp_replace(QUANTITY") == 1
    assert [tuple(r) for r in typed.collect()] == [(1.5, 2.0, {})]


def test_rows_that_lie_by_their_key_are_spread_after_a_table_in_parts(spark, plan, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.requireAllClusterKeysForCoPartition", "false")
    fact = spark.range(1000).select((F.col("id") % 10).alias("a"), F.lit("x").alias("v")).repartition(4, "a")
    lookup = lookup_table(spark.range(600).select(F.col("id").alias("k"), F.lit("t").alias("t")), ["k"], ["t"], broadcast_bytes=0)
    got = left_lookup(fact, lookup, {"k": F.col("a")}, {"v": found("t")}, hot=[])
    assert "hashpartitioning(_code" in plan(got)
