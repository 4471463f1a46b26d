"""Raw tables that come as text: no value is lost unless its row is held back."""

from pyspark.sql import functions as F, types as T

from cargoweave.layout import p7_schema
from cargoweave.operators import conform as C, quality as Q
from cargoweave.operators.conform import FAILED_CASTS
from cargoweave.plans import stages as S
from cargoweave.profiles import CR_IMPORT
from cargoweave.sources import tables as Tb
from checks import stand_ins as D

SF = "/root/testdata/sf0.001"


def text_raw(spark):
    raw = D.raw_cr_import(spark, SF)
    text = raw.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) for f in raw.schema])
    source = next(a for a, b in CR_IMPORT.renames.items() if b == "QUANTITY")
    return text.withColumn(source, F.when(F.pmod(F.hash(*[f"`{c}`" for c in text.columns]), F.lit(10)) == 0, "12,5").otherwise(F.col(f"`{source}`")))


def test_values_that_do_not_fit_are_kept_and_hold_the_row_back(spark):
    raw = text_raw(spark)
    processed = S.process(raw, CR_IMPORT, D.lookups(spark, SF))
    assert isinstance(processed.schema["QUANTITY"].dataType, (T.FloatType, T.DoubleType))
    path = Tb.new_path(spark, "text")
    S.write_split(processed, path)
    written = spark.read.parquet(path)
    assert written.count() == raw.count()
    bad = written.filter(F.map_contains_key(FAILED_CASTS, "QUANTITY"))
    n = bad.count()
    assert n > 0 and bad.filter("outcome = 'accepted'").isEmpty()
    assert bad.filter(F.array_contains("violations", "QUANTITY:float")).count() == n
    assert bad.filter(F.col(FAILED_CASTS)["QUANTITY"] != "12,5").isEmpty()
    summary = {(r["column_name"], r["check_name"]): r["n"] for r in Q.rule_summary(processed).collect()}
    assert summary["QUANTITY", "float"] == n
    good, rejects = C.p7_projection(processed), C.p7_rejects(processed)
    assert good.count() + rejects.count() == raw.count()
    assert rejects.filter(F.array_contains("MISSING_FIELDS", "QUANTITY")).count() == n
    assert [f.name for f in p7_schema()] == good.columns


def test_typed_tables_get_no_extra_column(spark):
    assert FAILED_CASTS not in C.conform(D.raw_cr_import(spark, SF), CR_IMPORT).columns


def test_different_rows_have_different_ids(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("n", "x"), ("1:x", ""), ("", "1:x")]
    df = C.add_columns(spark.createDataFrame(rows, "p string, q string"), {"RECORD_ID": ("UUID", "")})
    assert df.select("RECORD_ID").distinct().count() == len(rows)
    numbers = C.add_columns(spark.createDataFrame([(1e-9,), (2e-9,), (0.0,)], "x double"), {"RECORD_ID": ("UUID", "")})
    assert numbers.select("RECORD_ID").distinct().count() == 3


def test_all_unprocessed_tables_from_an_empty_ledger(spark):
    names = ["yeni_veri_cr_2024_01_imp", "yeni_veri_cr_2024_02_imp", "other"]
    registry = spark.createDataFrame([(n,) for n in names], "table_name string")
    raw, out, ledger = D.raw_cr_import(spark, SF), Tb.new_path(spark, "out"), Tb.new_path(spark, "ledger")
    run = lambda: S.run_unprocessed(spark, registry, lambda _: raw.limit(50), {"CR": D.lookups(spark, SF)}, out, ledger)
    assert run() == names[:2] and run() == []


def test_remediation_looks_up_no_new_code_again(spark):
    chain = spark.createDataFrame([("CR", "01", "A", "02"), ("CR", "02", "B", "03")], D.hs_desc(spark, SF).select("country", "HS_CODE", "HS_CODE_DESC", "new_HS_CODE").schema)
    processed = S.process(D.raw_cr_import(spark, SF).limit(200), CR_IMPORT, D.lookups(spark, SF))
    from dataclasses import replace

    from cargoweave.operators import enrich as E

    lookups = replace(D.lookups(spark, SF), hs=E.hs_descriptions(chain, "CR"))
    held = processed.withColumn("HS_CODE", F.lit("01")).withColumn("HS_CODE_DESCRIPTION", F.lit(None).cast("string"))
    once = E.enrich_hs(held, lookups.hs)
    path, out = Tb.new_path(spark, "split"), Tb.new_path(spark, "repaired")
    S.write_split(once.withColumn("ARRIVAL_DATE", F.lit(None).cast("date")), path)
    S.remediate_folder(spark, path, spark.read.parquet(f"{path}/outcome=quarantined").schema, lookups, out)
    again = spark.read.parquet(out)
    assert again.count() == 200 and {(r[0], r[1]) for r in again.select("HS_CODE", "HS_CODE_DESCRIPTION").collect()} == {("02", "A")}
