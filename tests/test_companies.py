"""Company codes by reduced lookups and by ranked keys."""

from dataclasses import replace

import pytest

from cargoweave.operators import enrich as E
from cargoweave.operators.lookup import held_keys, hot_key_codes, left_lookup, lookup_table, measured, reduced
from checks import stand_ins as D
from checks import registry as R

SF = "/root/testdata/sf0.001"


def test_a_reduced_lookup_needs_no_wide_shuffle(spark, plan, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    (whole,) = measured(E.company_codes(D.many_companies(spark, SF)))
    rows = D.hot_importer(R.country_all(spark, SF))
    limit = replace(whole, broadcast_bytes=whole.size // 2)
    assert not limit.small
    result = E.assign_ta_codes(rows, limit)
    before = plan(rows).split("\n\n")[0]
    tree = plan(result).split("\n\n")[0]
    assert "SortMergeJoin" not in tree.replace(before, "") or tree.count("SortMergeJoin") == before.count("SortMergeJoin")
    assert tree.count("ShuffledHashJoin") == before.count("ShuffledHashJoin")
    same = E.assign_ta_codes(rows, replace(whole, broadcast_bytes=0))
    other = E.assign_ta_codes(rows, whole)
    assert result.exceptAll(other).isEmpty() and other.exceptAll(result).isEmpty()
    assert result.exceptAll(same).isEmpty() and same.exceptAll(result).isEmpty()


def test_a_third_of_the_rows_have_one_importer(spark):
    rows = D.hot_importer(D.shipments(spark, SF))
    n = rows.count()
    assert rows.filter("IMPORTER_NAME = 'CUSTOMER#000000001'").count() >= n // 4
    lookup = E.company_codes(D.company(spark, SF), broadcast_bytes=0)
    coded = rows.withColumn("IMPORTER_COUNTRY", rows["IMPORTER_COUNTRY"])
    (hot,) = hot_key_codes(coded, lookup.key_code(E.IMPORTER.match(lookup)))
    assert hot


@pytest.mark.parametrize("held", [10**6, 1])
def test_reducing_keeps_every_row_that_is_looked_up(spark, monkeypatch, held):
    monkeypatch.setattr("cargoweave.operators.lookup.HELD_KEYS", held)
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "a")], "id int, k string")
    table = spark.createDataFrame([("a", "A"), ("a", "B"), ("b", None), ("c", "C"), (None, "N")], "k string, v string")
    (lookup,) = measured(lookup_table(table, ["k"], ["v"], broadcast_bytes=0))
    match = {"k": fact["k"]}
    small = reduced(lookup, held_keys(fact, [lookup.key_code(match)]))
    assert sorted(r["k"] for r in small.rows.collect()) == ["a", "a", "b"] and 0 < small.size < lookup.size
    got = left_lookup(fact.withColumn("v", fact["k"]), lookup, match, {"v": E.found("v")})
    assert {r["id"]: r["v"] for r in got.collect()} == {1: "A", 2: None, 3: None, 4: None, 5: "A"}


COMPANIES = [
    ("CR", "3-101", "ACME, S.A.", "CR00000001"), ("CR", "3 102", "BOLT", "CR00000002"), ("CR", None, "CORK", "CR00000003"),
    ("US", "3101", "ACME SA", "US00000001"), ("CR", "3101", "AAA", "CR00000009"), ("CR", "3-104", None, "CR00000004"), ("CR", "3-105", "NOCODE", None),
]
PARTIES = [
    (1, "CR", "3101", "BOLT", None), (2, "CR", "3102", "ACME S.A.", None), (3, "CR", "999", "B.O.L.T.", None), (4, "CR", None, "CORK", None),
    (5, "US", "3101", "CORK", None), (6, "CR", "3104", None, None), (7, "CR", "3105", "CORK", None), (8, None, "3101", "ACME SA", None),
    (9, "CR", "3101", "ACME", "KEEP"), (10, "CR", "-", " . ", None), (11, "CR", "3105", None, None), (1, "CR", "3101", "BOLT", None),
]


@pytest.mark.parametrize("broadcast_bytes", [10**6, 0])
@pytest.mark.parametrize("order", [(E.TAX_ID, E.NAME), (E.NAME, E.TAX_ID)])
def test_the_first_key_that_is_known_decides(spark, conf, broadcast_bytes, order):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    companies = spark.createDataFrame(COMPANIES, "country string, COMPANY_TAX_ID string, COMPANY_ham string, TA_CODE string")
    parties = spark.createDataFrame(
        PARTIES, "id int, IMPORTER_COUNTRY string, IMPORTER_TAX_ID string, IMPORTER_NAME string, IMPORTER_TA_CODE string"
    )
    result = E.assign_ta_codes_by_rank(parties, companies, [E.IMPORTER], matched_by=True, order=order, broadcast_bytes=broadcast_bytes)
    assert result.columns == [*parties.columns, "IMPORTER_TA_CODE_BY"]

    def key(text):
        return "".join(c for c in text or "" if c not in """.,-"'&/#() +:<>""")

    def wanted(country, tax_id, name, code):
        if code or not country:
            return code, None
        column = {E.TAX_ID: (1, key(tax_id)), E.NAME: (2, key(name))}
        for kind in order:
            at, value = column[kind]
            codes = [c[3] for c in COMPANIES if c[0] == country and value and key(c[at]) == value and c[3]]
            if codes:
                return min(codes), kind
        return None, None

    want = sorted([(i, *wanted(country, tax_id, name, code)) for i, country, tax_id, name, code in PARTIES], key=repr)
    got = sorted([(r["id"], r["IMPORTER_TA_CODE"], r["IMPORTER_TA_CODE_BY"]) for r in result.collect()], key=repr)
    assert got == want
    assert {by for *_, by in got} == {None, E.TAX_ID, E.NAME}


def test_sides_without_tax_ids_are_matched_by_name(spark):
    companies = spark.createDataFrame(COMPANIES, "country string, COMPANY_TAX_ID string, COMPANY_ham string, TA_CODE string")
    rows = spark.createDataFrame([("CR", "BOLT", None, "CR", "CORK", None)], """EXPORTER_COUNTRY string, EXPORTER_NAME string,
        EXPORTER_TA_CODE string, IMPORTER_COUNTRY string, IMPORTER_NAME string, IMPORTER_TA_CODE string""")
    (got,) = E.assign_ta_codes_by_rank(rows, companies).collect()
    assert (got["EXPORTER_TA_CODE"], got["IMPORTER_TA_CODE"]) == ("CR00000002", "CR00000003")
