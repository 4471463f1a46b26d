import datetime

import pytest
from pyspark.sql import functions as F, types as T

from cargoweave import layout, profiles
from cargoweave.operators import conform as C


def test_layout_has_the_known_shape():
    assert len(layout.SHIPMENT_FIELDS) == 46
    counts = {}
    for field in layout.SHIPMENT_FIELDS:
        for rule in field.rules:
            counts[rule] = counts.get(rule, 0) + 1
    assert counts == {
        "exist": 6, "text": 25, "float": 13, "date": 1, "short": 2, "ta_code": 2, "hs_code": 1,
        "country": 1,
    }
    kinds = [type(f.dataType) for f in layout.p7_schema()]
    assert (kinds.count(T.StringType), kinds.count(T.FloatType), kinds.count(T.DateType)) == (32, 13, 1)
    assert sum(not f.nullable for f in layout.p7_schema()) == 8
    assert [f.name for f in layout.company_schema()] == [
        "TA_CODE", "COMPANY_TAX_ID", "COMPANY_NAME", "COMPANY_ADDRESS", "CITY_STATE",
    ]


def test_country_codes_follow_the_rule():
    codes = layout.country_codes()
    assert len(codes) == len(set(codes)) == 255
    assert "UK" in codes and "GB" not in codes
    assert codes[:3] == ["AD", "AE", "AF"] and codes[-7:] == ["ZW", "OS", "AN", "KV", "AB", "ZZ", "EU"]
    assert layout.country_codes(["GB", "FR"])[:2] == ["FR", "UK"]


def test_country_table(spark):
    rows = layout.country_table(spark, {"CR": "COSTA RICA"}).collect()
    assert [r.code for r in rows] == layout.country_codes()
    assert [r.position for r in rows] == list(range(1, 256))
    names = {r.code: r.name for r in rows}
    assert names["CR"] == "COSTA RICA" and names["ZZ"] == "N/A" and names["UK"] == "United Kingdom"
    assert all(names.values())


def test_profiles():
    assert len(profiles.CR_IMPORT.renames) == len(profiles.CR_EXPORT.renames) == 16
    assert profiles.CR_EXPORT.renames["VALUE (USD)"] == "CIF_VALUE"
    assert profiles.CR_EXPORT.renames["COUNTRY ORIGIN"] == "COUNTRY_OF_ORIGIN"
    assert len(profiles.AR_IMPORT_COLUMNS) == 34 and len(profiles.AR_IMPORT.renames) == 18
    assert set(profiles.AR_IMPORT.renames) <= set(profiles.AR_IMPORT_COLUMNS)
    assert profiles.profile_for("cr", "EXPORT") is profiles.CR_EXPORT
    for country, data_type in (("CR", "TRANSIT"), ("AR", "EXPORT"), ("XX", "IMPORT")):
        with pytest.raises(ValueError):
            profiles.profile_for(country, data_type)


def test_rename_ignores_absent_and_refuses_repeated_names(spark):
    df = spark.createDataFrame([(1, 2)], "`A#` int, b int")
    assert C.rename_columns(df, {"a#": "X", "nope": "Y"}).columns == ["X", "b"]
    with pytest.raises(ValueError, match="b"):
        C.rename_columns(df, {"A#": "B"})


def test_add_columns_only_adds_what_is_absent(spark):
    df = spark.createDataFrame([("x",)], "ta string")
    added = C.add_columns(df, {
        "TA": ("STRING", "other"), "D": ("DATE", "1900-01-01"), "N": ("INTEGER", "4"),
        "E": ("STRING", ""), "RECORD_ID": ("UUID", ""),
    })
    row = added.first()
    assert added.columns == ["ta", "D", "N", "E", "RECORD_ID"]
    assert (row.ta, row.D, row.N, row.E) == ("x", datetime.date(1900, 1, 1), 4, None)


def test_record_id_is_stable_and_tells_positions_apart(spark):
    df = spark.createDataFrame(
        [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.5), ("a", None, 1.0)],
        "p string, q string, n double",
    )
    with_id = C.add_columns(df, {"RECORD_ID": ("UUID", "")})
    ids = [r.RECORD_ID for r in with_id.collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[3]
    random = C.add_columns(df, {"RECORD_ID": ("UUID", "")}, random_ids=True)
    assert len({r.RECORD_ID for r in random.collect()}) == 4


def test_typed_columns_and_order(spark):
    df = spark.createDataFrame([(1, 2.0, "h")], "extra int, quantity double, `z.1` string")
    typed = C.add_typed_columns(df, include_text=False)
    assert "BILL_OF_LADING_NO" not in typed.columns and "quantity" in typed.columns
    assert dict(typed.dtypes)["FOB_VALUE"] == "double"
    assert dict(typed.dtypes)["ARRIVAL_DATE"] == "date"
    assert dict(typed.dtypes)["IMPORT_DATA_TYPE"] == "int"
    final = C.finalize(df)
    assert final.columns == [f.name for f in layout.SHIPMENT_FIELDS] + ["extra", "z.1"]
    assert C.finalize(final).columns == final.columns
    assert final.first()["QUANTITY"] == 2.0


def test_arrival_date_from_parts(spark):
    df = spark.createDataFrame(
        [(2020, 2, 29), (2020, 2, 31), (2021, 12, 1), (None, 1, 1), (2020, 1, None)],
        "YEAR int, MONTH int, DAY int",
    ).withColumn("ARRIVAL_DATE", F.lit(None).cast("date"))
    dates = [r.ARRIVAL_DATE for r in C.derive_arrival_date(df, ("YEAR", "MONTH", "DAY")).collect()]
    assert dates == [datetime.date(2020, 2, 29), None, datetime.date(2021, 12, 1), None, None]


def test_p7_splits_rows_without_loss(spark):
    df = spark.createDataFrame(
        [("2020-01-01", "CR00000001", "CR00000002", "CR", 4, 1, "Custom", "r1", "12.5"),
         ("bad date", "CR00000001", None, "CR", 4, 1, "Custom", "r2", "many")],
        "ARRIVAL_DATE string, IMPORTER_TA_CODE string, EXPORTER_TA_CODE string,"
        " COUNTRY_OF_ORIGIN string, EXPORT_DATA_TYPE int, IMPORT_DATA_TYPE int, DATA_TYPE string,"
        " RECORD_ID string, QUANTITY string",
    )
    good, bad = C.p7_projection(df), C.p7_rejects(df)
    assert [(f.name, f.dataType) for f in good.schema] == [
        (f.name, f.dataType) for f in layout.p7_schema()
    ]
    assert [(r.RECORD_ID, r.QUANTITY, r.IMPORT_DATA_TYPE) for r in good.collect()] == [("r1", 12.5, "1")]
    (row,) = bad.collect()
    assert (row.RECORD_ID, row.QUANTITY) == ("r2", None)
    assert row.MISSING_FIELDS == ["ARRIVAL_DATE", "EXPORTER_TA_CODE", "QUANTITY"]
    unfit = df.filter("RECORD_ID = 'r1'").withColumn("QUANTITY", F.lit("12,5"))
    assert C.p7_projection(unfit).isEmpty() and C.p7_rejects(unfit).first().MISSING_FIELDS == ["QUANTITY"]


def test_company_file_is_distinct_and_in_layout(spark, rows):
    df = spark.createDataFrame([("CR1", "N"), ("CR1", "N"), (None, "M")], "code string, who string")
    result = C.company_file(df, {"TA_CODE": "code", "COMPANY_NAME": "who"})
    assert result.columns == [f.name for f in layout.COMPANY_FIELDS]
    assert rows(result) == [("CR1", None, "N", None, None), (None, None, "M", None, None)]


def test_blank_to_null_touches_text_only(spark, rows):
    df = spark.createDataFrame([("", " ", 0), ("x", "", 1)], "a string, b string, n int")
    once = C.blank_to_null(df, ["a", "b", "n"])
    assert rows(once) == [("x", None, 1), (None, " ", 0)]
    assert rows(C.blank_to_null(once, ["a", "b", "n"])) == rows(once)
