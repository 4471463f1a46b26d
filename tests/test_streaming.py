import pytest

from cargoweave.operators import quality as Q
from cargoweave.plans import stages as S
from cargoweave.profiles import CR_IMPORT
from cargoweave.sources import tables as T
from cargoweave.streaming.incremental import process_arrivals, process_new_files, read_arrivals, read_processed
from checks import stand_ins as D

SF = "/root/testdata/sf0.001"


def test_each_file_is_processed_once(spark, rows):
    raw, lookups = D.raw_cr_import(spark, SF), D.lookups(spark, SF)
    landing, out, state = (T.new_path(spark, n) for n in ("landing", "out", "state"))
    schema = S.process(raw, CR_IMPORT, lookups).schema

    def run():
        process_new_files(
            spark, landing, raw.schema, lambda b: S.process(b, CR_IMPORT, lookups), out, state, 2
        )
        return read_processed(spark, out, schema)

    T.write_table(raw.repartition(3), landing)
    first = run()
    assert first.count() == raw.count()
    assert run().count() == raw.count()  # nothing new: nothing is done again
    T.write_table(raw.limit(10), landing, mode="append")
    assert run().count() == raw.count() + 10


def test_a_lost_checkpoint_repeats_no_rows(spark):
    landing, out = T.new_path(spark, "landing"), T.new_path(spark, "out")
    T.write_table(spark.range(10).toDF("n").repartition(5), landing)
    schema = spark.read.parquet(landing).schema
    process_new_files(spark, landing, schema, lambda b: b, out, max_files_per_batch=2)
    process_new_files(spark, landing, schema, lambda b: b, out, max_files_per_batch=5)
    assert read_processed(spark, out, schema).count() == 10
    with pytest.raises(ValueError, match="knows nothing"):
        process_new_files(spark, landing, schema, lambda b: b, out, T.new_path(spark, "state"), 5)
    assert read_processed(spark, out, schema).count() == 10


def test_arrivals_are_split_audited_and_counted_once(spark):
    raw, lookups = T.stage(D.raw_cr_import(spark, SF).limit(300), "raw"), D.lookups(spark, SF)
    landing, out = (T.new_path(spark, n) for n in ("landing", "out"))
    processed = S.process(raw, CR_IMPORT, lookups, keep_source=True)
    half = raw.filter("ITEM <= 3")
    for part in (half, raw.filter("ITEM > 3"), half):  # the last one comes again
        T.write_table(part, landing, mode="append")
        process_arrivals(spark, landing, raw.schema, CR_IMPORT, lookups, out, max_files_per_batch=1)
    got = read_arrivals(spark, out, processed.schema)
    want = Q.with_violations(processed).dropDuplicates(["RECORD_ID"])
    assert got.count() == want.count()
    plain = [c for c in processed.columns if c != S.AS_CAME]
    assert got.select(plain).exceptAll(want.select(plain)).isEmpty()
    assert got.filter("(outcome = 'accepted') <> (size(violations) = 0)").isEmpty()
    audits = spark.read.parquet(f"{out}/audit")
    nulls = audits.filter("check_name = 'null' and column_name = 'HS_CODE'").agg({"n": "sum"}).first()[0]
    assert nulls == want.filter("HS_CODE is null").count() > 0
    with pytest.raises(ValueError, match="knows nothing"):
        process_arrivals(spark, landing, raw.schema, CR_IMPORT, lookups, out, T.new_path(spark, "state"))
