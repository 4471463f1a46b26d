from pyspark.sql import functions as F

from cargoweave.operators import enrich as E, quality as Q
from cargoweave.operators.conform import finalize


def counts(df):
    return {(r.check_name, r.column_name): r.n for r in df.collect()}


def test_hs_integrity_counts_blank_as_bad_and_null_once(spark):
    df = spark.createDataFrame(
        [("0101", "d"), ("", None), ("01a", "d"), (None, None), ("12\n", "d")],
        "HS_CODE string, HS_CODE_DESCRIPTION string",
    )
    assert counts(Q.hs_integrity(df)) == {
        ("null_hs_code", "HS_CODE"): 1,
        ("null_hs_code_description", "HS_CODE_DESCRIPTION"): 2,
        ("invalid_hs_code_format", "HS_CODE"): 3,
    }


def test_ta_format(spark):
    df = spark.createDataFrame(
        [("CR00000001", "CR00000001"), ("CR0000001", "US00000001"), ("cr00000001", "US00000002"),
         (None, "US00000003"), ("CR00000001\n", "US00000004")],
        "IMPORTER_TA_CODE string, EXPORTER_TA_CODE string",
    )
    assert counts(Q.ta_format(df)) == {("invalid_ta_code", "IMPORTER_TA_CODE"): 4}
    assert counts(Q.ta_format(df, keep_zero=True))["invalid_ta_code", "EXPORTER_TA_CODE"] == 0


def test_measures_of_an_empty_table_are_zero(spark):
    empty = finalize(spark.createDataFrame([], "QUANTITY double"))
    assert set(counts(Q.null_counts(empty)).values()) == {0}


def test_unknown_values_keep_null_and_count_rows(spark, rows):
    ports = E.port_names(spark.createDataFrame([("CR", "x")], "alpha2 string, short_name string"))
    df = spark.createDataFrame([("CR",), ("XX",), ("XX",), (None,)], "c string")
    assert rows(Q.unknown_values(df, "c", ports)) == [("XX", 2), (None, 1)]
    assert rows(Q.unknown_countries(df, "c", ports)) == [("XX",), (None,)]


def test_row_rules(spark):
    df = finalize(spark.createDataFrame(
        [("2020-01-01", "0101", "CR00000001", "CR00000002", "CR", "r1", "1.5", "4"),
         ("2020-02-30", "01x", "bad", None, "GB", "r2", "x", "70000"),
         (None, None, None, None, None, None, None, None)],
        "ARRIVAL_DATE string, HS_CODE string, IMPORTER_TA_CODE string, EXPORTER_TA_CODE string,"
        " COUNTRY_OF_ORIGIN string, RECORD_ID string, QUANTITY string, EXPORT_DATA_TYPE string",
    ))
    got = [r.violations for r in Q.with_violations(df).collect()]
    assert got == [
        [],
        ["ARRIVAL_DATE:date", "HS_CODE:hs_code", "IMPORTER_TA_CODE:ta_code", "EXPORTER_TA_CODE:exist",
         "QUANTITY:float", "COUNTRY_OF_ORIGIN:country", "EXPORT_DATA_TYPE:short"],
        [f"{c}:exist" for c in ("ARRIVAL_DATE", "HS_CODE", "IMPORTER_TA_CODE", "EXPORTER_TA_CODE",
                                "COUNTRY_OF_ORIGIN", "RECORD_ID")]
    ]
    accepted, quarantined = Q.accepted_rows(df), Q.quarantined_rows(df)
    assert [r.RECORD_ID for r in accepted.collect()] == ["r1"]
    assert accepted.count() + quarantined.count() == df.count()
    summary = counts(Q.rule_summary(df))
    assert summary["exist", "EXPORTER_TA_CODE"] == 2 and summary["float", "QUANTITY"] == 1
    exploded = quarantined.select(F.explode("violations").alias("v")).groupBy("v").count()
    assert {tuple(r.v.split(":")[::-1]): r["count"] for r in exploded.collect()} == summary
