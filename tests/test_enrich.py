import string

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cargoweave.functions import expressions as X
from cargoweave.operators import enrich as E

NOISE = set(""".,-"'&/#() +:<>""")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(string.printable.replace("\x0b", "") + "éñ", max_size=20), max_size=40))
def test_company_key_drops_noise_only(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(X.company_key(F.col("n"))).collect()]
    assert got == ["".join(c for c in n if c not in NOISE) or None for n in names]


def test_country_map_is_exact_and_keeps_unknown(spark, rows):
    names = spark.createDataFrame(
        [("Costa Rica", "CR"), ("Nowhere", None)], "country2 string, code string"
    )
    df = spark.createDataFrame(
        [(1, "Costa Rica"), (2, "costa rica"), (3, "Costa Rica "), (4, None), (5, "Nowhere")],
        "id int, c string",
    )
    result = E.map_country(df, "c", E.country_names(names))
    assert rows(result) == [
        (1, "CR"), (2, "costa rica"), (3, "Costa Rica "), (4, None), (5, "Nowhere"),
    ]


def test_crossfill(spark, rows):
    df = spark.createDataFrame(
        [("A", None), (None, "B"), (None, None), ("C", "D")],
        "COUNTRY_OF_ORIGIN string, EXPORTER_COUNTRY string",
    )
    once = E.crossfill_countries(df)
    assert rows(once) == [("A", "A"), ("B", "B"), ("C", "D"), ("ZZ", "ZZ")]
    assert rows(E.crossfill_countries(once)) == rows(once)


def test_port_fills_gaps_only(spark, rows):
    ports = spark.createDataFrame([("CR", "Costa Rica")], "alpha2 string, short_name string")
    df = spark.createDataFrame(
        [(1, "CR", None), (2, "CR", "LIMON"), (3, "XX", None), (4, None, None)],
        "id int, c string, p string",
    )
    result = E.fill_port(df, "c", "p", E.port_names(ports))
    assert rows(result) == [
        (1, "CR", "Costa Rica"), (2, "CR", "LIMON"), (3, "XX", None), (4, None, None),
    ]


def test_hs_description_belongs_to_the_old_code(spark, rows):
    dim = E.union_by_country({
        "CR": spark.createDataFrame(
            [("01", "old", "02"), ("02", "new", None), ("03", None, "04")],
            "HS_CODE string, HS_CODE_DESC string, new_HS_CODE string",
        ),
        "AR": spark.createDataFrame(
            [("01", "other", "99")], "HS_CODE string, HS_CODE_DESC string, new_HS_CODE string"
        ),
    })
    df = spark.createDataFrame(
        [(1, "01", "mine"), (2, "02", None), (3, "03", "mine"), (4, "05", "mine"), (5, None, "m")],
        "id int, HS_CODE string, HS_CODE_DESCRIPTION string",
    )
    result = E.enrich_hs(df, E.hs_descriptions(dim, "CR"))
    assert rows(result) == [
        (1, "02", "old"), (2, "02", "new"), (3, "04", "mine"), (4, "05", "mine"), (5, None, "m"),
    ]


def test_unit_without_factor_leaves_the_quantity(spark, rows):
    dim = spark.createDataFrame(
        [("CR", "KGS", "Kilogram", None), ("CR", "TON", "Kilogram", 1000.0), ("CR", "G", None, 0.001)],
        "country string, unit string, new_unit string, factor double",
    )
    units = E.unit_factors(dim, "CR")
    df = spark.createDataFrame(
        [(1, 5.0, "KGS"), (2, 5.0, "TON"), (3, 5.0, "G"), (4, 5.0, "?"), (5, None, "TON"), (6, 1.0, None)],
        "id int, q double, u string",
    )
    result = E.convert_units(df, units, "u", "q")
    assert rows(result) == [
        (1, 5.0, "Kilogram"), (2, 5000.0, "Kilogram"), (3, 0.005, "G"), (4, 5.0, "?"),
        (5, None, "Kilogram"), (6, 1.0, None),
    ]
    text = E.convert_units(df.withColumn("q", F.when(F.col("id") == 2, "two").otherwise("2")), units, "u", "q")
    assert [r.q for r in text.orderBy("id").collect()] == ["2", "two", "0.002", "2", "2000.0", "2"]


@pytest.fixture
def companies(spark):
    return spark.createDataFrame(
        [("CR", "ACME, S.A.", "CR00000002"), ("CR", "ACME S A", "CR00000001"),
         ("US", "ACME SA", "US00000001"), ("AD", "BOLT", "AD00000001"), ("US", "BOLT", "US00000002"),
         ("XX", "ONLY", "XX00000001"), ("US", " . ", "US00000009"), ("US", "NOCODE", None)],
        "country string, COMPANY_ham string, TA_CODE string",
    )


@pytest.fixture
def parties(spark):
    return spark.createDataFrame(
        [(1, "CR", "A.C.M.E. (SA)", None), (2, "US", "ACME SA", None), (3, "US", "acme sa", None),
         (4, "US", "BOLT", None), (5, None, "BOLT", None), (6, "CR", "BOLT", None),
         (7, "CR", "ACMESA", "KEEP"), (8, "US", "- -", None), (9, "US", "NOCODE", None),
         (10, "XX", "ONLY", None)],
        "id int, EXPORTER_COUNTRY string, EXPORTER_NAME string, EXPORTER_TA_CODE string",
    )


@pytest.mark.parametrize("broadcast_bytes", [10**6, 0])
def test_ta_code_within_the_country(companies, parties, conf, broadcast_bytes):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    lookup = E.company_codes(companies, broadcast_bytes=broadcast_bytes)
    result = E.assign_ta_code(parties, E.EXPORTER, lookup).orderBy("id")
    assert [r.EXPORTER_TA_CODE for r in result.collect()] == [
        "CR00000001", "US00000001", None, "US00000002", None, None, "KEEP", None, None, "XX00000001",
    ]


def test_ta_code_from_any_present_country(companies, parties):
    present = E.present_countries(parties, "EXPORTER_COUNTRY")
    assert sorted(r.country for r in present.collect()) == ["CR", "US"]  # XX is in no list
    result = E.assign_ta_code(
        parties, E.EXPORTER, E.company_codes(companies, "any", present)
    ).orderBy("id")
    # AD is not present, so BOLT is the US one; CR comes before US in the list.
    assert [r.EXPORTER_TA_CODE for r in result.collect()] == [
        "CR00000001", "CR00000001", None, "US00000002", "US00000002", "US00000002", "KEEP", None,
        None, None,
    ]
    with pytest.raises(ValueError, match="scope"):
        E.company_codes(companies, "any")


def test_list_order_decides_between_countries(spark, parties):
    present = spark.createDataFrame([("ZW",), ("AN",)], "country string")
    companies = spark.createDataFrame(
        [("AN", "BOLT", "AN00000001"), ("ZW", "BOLT", "ZW00000001")],
        "country string, COMPANY_ham string, TA_CODE string",
    )
    lookup = E.company_codes(companies, "any", present)
    # AN stands behind ZW in the list, though not in the alphabet.
    assert [r.TA_CODE for r in lookup.table.collect()] == ["ZW00000001"]


def test_lookups_take_their_source_headings(spark, rows):
    ports = spark.createDataFrame(
        [("CR", "Costa Rica", 1)],
        "`Alpha-2 code` string, `English short name (upper/lower case)` string, other int",
    )
    df = spark.createDataFrame([("CR", None)], "c string, p string")
    assert rows(E.fill_port(df, "c", "p", E.port_names(ports))) == [("CR", "Costa Rica")]
    tables = {
        "CR_unit_of_quantity": spark.createDataFrame(
            [("TON", "Kilogram", 1000.0)], "UNIT_OF_QUANTITY string, Yeni_Birim string, Aksiyon double"
        ),
        "AR_unit_of_quantity": spark.createDataFrame(
            [("TON", "Gram", 1e6)], "UNIT_OF_QUANTITY string, Yeni_Birim string, Aksiyon double"
        ),
    }
    units = E.read_by_country(tables.__getitem__, "units", ["CR", "AR"])
    df = spark.createDataFrame([(2.0, "TON")], "q double, u string")
    result = E.convert_units(df, E.unit_factors(units, "CR"), "u", "q")
    assert rows(result) == [(2000.0, "Kilogram")]
