import pytest

from cargoweave.operators import enrich as E, lookup, quality as Q
from cargoweave.plans import stages as S
from cargoweave.profiles import CR_IMPORT
from cargoweave.sources import ledger as L, published as P, tables as T
from checks import stand_ins as D

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return T.stage(D.raw_cr_import(spark, SF), "raw")


@pytest.fixture(scope="module")
def lookups(spark):
    return D.lookups(spark, SF)


def test_process_is_one_pass_over_the_fact(raw, lookups, plan):
    text = plan(S.process(raw, CR_IMPORT, lookups))
    tree = text.split("\n\n")[0]
    assert not any(word in tree for word in ("SortMergeJoin", "Cartesian", "Python", "InPandas"))
    assert text.count("Location:") - text.count("testdata") == 1
    # Down the fact's side, the left input of every join, nothing is exchanged.
    depth = min(i for i, line in enumerate(tree.splitlines()) if "Exchange" in line)
    scan = next(i for i, line in enumerate(tree.splitlines()) if "Scan parquet" in line)
    assert scan < depth


def test_audit_counts_all_scalars_in_one_scan(raw, lookups, plan):
    processed = T.stage(S.process(raw, CR_IMPORT, lookups), "processed")
    measures = Q.null_measures() + Q.hs_measures() + Q.ta_measures() + Q.quantity_measures()
    text = plan(Q.count_measures(processed, measures))
    assert text.count("ReadSchema:") == 1
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema:"))
    assert schema.count(":") - 1 == 10  # ten of fifty columns


def test_large_lookups_give_the_same_result(spark, raw, lookups, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = D.lookups(spark, SF, broadcast_bytes=0)
    assert not any(x.small for x in (large.hs, large.companies, large.countries))
    one, other = S.process(raw, CR_IMPORT, lookups), S.process(raw, CR_IMPORT, large)
    assert one.columns == other.columns and one.count() == other.count() == raw.count()
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_any_scope_for_both_sides(spark, raw, lookups):
    coded = S.stage_country(S.stage_columns(raw, CR_IMPORT), lookups)
    companies = D.company(spark, SF)

    def lookup(side):
        return E.company_codes(companies, "any", E.present_countries(coded, side.country))

    both = E.assign_ta_codes(coded, lookup(E.EXPORTER), lookup(E.IMPORTER))
    assert both.count() == coded.count() and both.columns == coded.columns
    found = S.stage_ta(coded, lookups).filter("EXPORTER_TA_CODE is not null").count()
    assert both.filter("EXPORTER_TA_CODE is not null").count() >= found > 0


def test_remediation_repairs_and_loses_nothing(raw, lookups):
    processed = S.process(raw, CR_IMPORT, lookups)
    quarantined = Q.quarantined_rows(processed)
    repaired = S.remediate(quarantined, lookups)
    assert repaired.count() == quarantined.count()

    def broken(df):
        return df.selectExpr("explode(violations) as v").groupBy("v").count().collect()

    before, after = ({r.v: r["count"] for r in broken(df)} for df in (quarantined, repaired))
    assert before["COUNTRY_OF_ORIGIN:exist"] > 0 and "COUNTRY_OF_ORIGIN:exist" not in after
    # A blank tariff code is no longer badly formed but missing.
    assert after["HS_CODE:hs_code"] < before["HS_CODE:hs_code"]
    assert sum(after.values()) < sum(before.values())


def test_run_table_writes_audits_and_marks(spark, raw, lookups):
    out, ledger = T.new_path(spark, "out"), T.new_path(spark, "ledger")
    name = "yeni_veri_cr_2024_01_imp"
    for _ in range(2):  # a second run replaces the output and marks nothing twice
        report = S.run_table(spark, name, raw, "CR", lookups, out, ledger)
    assert {r.check_name for r in report.collect()} >= {"null", "unknown_country", "unknown_unit"}
    written = P.read_published(spark, f"{out}/{name}_islendi")
    assert written.count() == raw.count()
    assert {r.outcome for r in written.select("outcome").distinct().collect()} <= {
        "accepted", "quarantined"
    }
    assert written.filter("(outcome = 'accepted') <> (size(violations) = 0)").isEmpty()
    assert [r.table_name for r in L.read_ledger(spark, ledger).collect()] == [name]
    with pytest.raises(ValueError, match="import from export"):
        S.run_table(spark, "yeni_veri_cr_2024_01", raw, "CR", lookups, out, ledger)


def test_large_lookups_take_two_passes_and_at_most_three_shuffles(spark, raw, conf, plan, monkeypatch):
    """The keys are counted before and after the countries are mapped; a lookup whose keys are all frequent shuffles nothing."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "32")
    large, passes = D.lookups(spark, SF, broadcast_bytes=0), []
    write = lookup.stage
    monkeypatch.setattr(lookup, "stage", lambda df, name: passes.append(name) or write(df, name))
    df = S.process(raw, CR_IMPORT, large)
    assert passes.count("held-keys") == 2
    tree = plan(df).split("\n\n")[0]
    assert 0 < tree.count("ShuffledHashJoin LeftOuter") <= 3


def test_rule_summary_of_texts_is_one_scan(spark, lookups, plan, rows):
    text = T.stage(D.raw_as_text(spark, SF), "text")
    processed = T.stage(S.process(text, CR_IMPORT, lookups), "processed")
    summary = Q.rule_summary(processed)
    assert plan(summary).count("ReadSchema:") == 1
    each = Q.with_violations(processed).selectExpr("explode(violations) as v").groupBy("v").count()
    # what did not fit its type is NULL, and in the rules of that type only by its text
    assert rows(summary.selectExpr("concat(column_name, ':', check_name)", "n")) == rows(each)
