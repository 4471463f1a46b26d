"""Audit while writing, published versions, claims, and runs over many tables."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Observation, functions as F

from cargoweave.operators import quality as Q
from cargoweave.plans import stages as S
from cargoweave.profiles import CR_IMPORT
from cargoweave.sources import ledger as L, published as P, tables as T
from checks import stand_ins as D

SF = "/root/testdata/sf0.001"
NAME = "yeni_veri_cr_2024_01_imp"


@pytest.fixture(scope="module")
def raw(spark):
    return T.stage(D.raw_cr_import(spark, SF), "raw")


@pytest.fixture(scope="module")
def lookups(spark):
    return D.lookups(spark, SF)


def test_counts_taken_while_writing_are_the_counts_of_the_table(spark, raw, lookups):
    counts, path = Observation(), T.new_path(spark, "split")
    S.write_split(S.process(raw, CR_IMPORT, lookups), path, observation=counts)
    got = Q.observed_counts(spark, counts, Q.audit_measures())
    want = Q.count_measures(spark.read.parquet(path), Q.audit_measures())
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sum(r["n"] for r in got.collect()) > 0


def test_the_audit_scans_what_was_written_once(spark, raw, lookups, plan):
    counts, path = Observation(), T.new_path(spark, "split")
    S.write_split(S.process(raw, CR_IMPORT, lookups), path, observation=counts)
    written = spark.read.parquet(path)
    scalars = Q.observed_counts(spark, counts, Q.audit_measures())
    text = plan(S.stage_audit(written, lookups, scalars))
    assert text.count(path) == 1
    schema = next(line for line in text.split(path)[1].splitlines() if line.startswith("ReadSchema:"))
    assert schema.count(":") - 1 == 2  # the two columns with unknown values
    alone = S.stage_audit(written, lookups)
    assert sorted(map(tuple, S.stage_audit(written, lookups, scalars).collect()), key=repr) == sorted(map(tuple, alone.collect()), key=repr)


def test_counts_of_an_empty_table_are_zero(spark, raw, lookups):
    counts, path = Observation(), T.new_path(spark, "split")
    S.write_split(S.process(raw.limit(0), CR_IMPORT, lookups), path, observation=counts)
    assert {r["n"] for r in Q.observed_counts(spark, counts, Q.audit_measures()).collect()} == {0}


def test_a_version_counts_when_it_is_published(spark):
    path = T.new_path(spark, "table")
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, path)
    for n in (1, 2, 3):
        version = P.new_version(path)
        spark.range(n).write.parquet(f"{version}/rows")
        assert P.published(spark, path) is None if n == 1 else P.read_published(spark, path).count() == n - 1
        P.publish(spark, path, version)
        assert P.read_published(spark, path).count() == n
    assert [r["sequence"] for r in P.versions(spark, path).collect()] == [3, 2, 1]


def test_a_run_that_ends_half_way_leaves_the_last_version(spark, raw, lookups, monkeypatch):
    out, ledger = T.new_path(spark, "out"), T.new_path(spark, "ledger")
    S.run_table(spark, NAME, raw.limit(40), "CR", lookups, out, ledger)

    def killed(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(S, "stage_audit", killed)
    with pytest.raises(KeyboardInterrupt):
        S.run_table(spark, NAME, raw.limit(70), "CR", lookups, out, ledger)
    assert P.read_published(spark, f"{out}/{NAME}_islendi").count() == 40
    assert P.read_published(spark, f"{out}/{NAME}_islendi", part="audit").filter("check_name = 'null'").count() == 10


def files(spark, path):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").collect()


def test_the_ledger_has_no_empty_files(spark):
    path = T.new_path(spark, "ledger")
    assert L.read_ledger(spark, path).collect() == []
    for _ in range(3):
        L.mark_processed(spark.createDataFrame([(NAME,), ("other",), (None,)], "table_name string"), path)
    assert sorted(r["table_name"] for r in L.read_ledger(spark, path).collect()) == ["other", NAME]
    assert len([f for f in files(spark, path) if f["path"].endswith(".parquet")]) == 1


def test_a_name_is_claimed_once_at_a_time(spark):
    path, names = T.new_path(spark, "ledger"), ["a", "b", "c"]
    assert L.claim(spark, path, names, "first") == names
    assert L.claim(spark, path, names, "second") == []
    L.release(spark, path, ["b"], "first")
    assert L.claim(spark, path, names, "third") == ["b"]
    L.mark_processed(spark.createDataFrame([("c",)], "table_name string"), path)
    L.release(spark, path, ["a", "c"], "first")
    assert L.claim(spark, path, names, "fourth") == ["a"]


def test_a_claim_ends_with_its_lease(spark):
    path = T.new_path(spark, "ledger")
    assert L.claim(spark, path, ["a"], "first", lease=0.0) == []  # over before it was taken
    assert L.claim(spark, path, ["a"], "second") == ["a"]


def test_claims_at_the_same_time(spark):
    path, names = T.new_path(spark, "ledger"), [f"t{k}" for k in range(5)]
    start = threading.Barrier(3)

    def run(owner):
        start.wait()
        return L.claim(spark, path, names, owner)

    with ThreadPoolExecutor(3) as pool:
        won = list(pool.map(run, "xyz"))
    assert sorted(n for mine in won for n in mine) == names


def test_who_ends_while_choosing_is_waited_for_no_longer(spark, monkeypatch):
    path = T.new_path(spark, "ledger")
    monkeypatch.setattr(L, "CHOICE", 3)
    L._note(spark, path, "gone", "choosing", [("a", None)], time.time() + 3)
    assert L.claim(spark, path, ["a"], "here") in (["a"], [])
    L.release(spark, path, ["a"], "here")
    assert L.claim(spark, path, ["a"], "again") == ["a"]


def test_two_runs_at_once_process_each_table_once(spark, raw, lookups):
    names = [f"yeni_veri_cr_2024_0{k}_imp" for k in range(1, 4)]
    listing = spark.createDataFrame([(n,) for n in [*names, "yeni_veri_cr_2024_09_imp", "no_table"]], "table_name string")
    out, ledger, opened = T.new_path(spark, "out"), T.new_path(spark, "ledger"), []

    def open_table(name):
        if "_09_" in name:
            raise OSError("broken")
        opened.append(name)
        return raw.limit(20)

    def run(owner):
        return S.process_unprocessed(spark, listing, open_table, {"CR": lookups}, out, ledger, threads=2, owner=owner)

    with ThreadPoolExecutor(2) as pool:
        both = [r for report in pool.map(run, "xy") for r in report]
    assert sorted(opened) == names
    assert sorted(r.table_name for r in both if r.error is None) == names
    assert {r.error for r in both if r.error is not None} == {"OSError: broken"}
    assert sorted(r["table_name"] for r in L.read_ledger(spark, ledger).collect()) == names
    with pytest.raises(RuntimeError, match="09_imp: OSError"):  # given back, so the next call takes it up
        S.run_unprocessed(spark, listing, open_table, {"CR": lookups}, out, ledger)


def test_repairs_are_noted_and_repeats_change_nothing(spark, raw, lookups):
    path, one, two = (T.new_path(spark, n) for n in ("split", "one", "two"))
    processed = S.process(raw, CR_IMPORT, lookups, keep_source=True)
    S.write_split(processed, path)
    S.remediate_folder(spark, path, processed.schema, lookups, one)
    first = spark.read.parquet(one)
    S.remediate_folder(spark, one, first.drop("violations", "outcome").schema, lookups, two)
    held, again = first.filter("outcome = 'quarantined'").drop("outcome"), spark.read.parquet(two).drop("outcome")
    assert held.count() == again.count() > 0
    plain = [c for c in held.columns if c != S.AS_CAME]
    assert held.select(plain).exceptAll(again.select(plain)).isEmpty()
    fields = {r["field"] for r in first.select(F.explode(S.REPAIRS).alias("r")).select("r.*").distinct().collect()}
    assert {"COUNTRY_OF_ORIGIN", "HS_CODE"} <= fields
