"""Dates and numbers as text: what parsers take, and what typing does with the rest."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cargoweave.functions import parsing as X
from cargoweave.operators import conform as C, quality as Q
from cargoweave.operators.conform import FAILED_CASTS, PARSED_BY


def read(spark, parsers, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    value, by = X.parsed(F.col("t"), parsers)
    rows = df.select("i", value.alias("v"), by.alias("by")).orderBy("i").collect()
    return [r["v"] for r in rows], [r["by"] for r in rows]


def test_whole_dates_only(spark):
    texts = ["2020-12-31", " 2020-02-29 ", "2020", "2020-5", "2020-02-30", "31/12/2020", "1/2/2020", "2020-12-31T00:00", "", None, "20201231"]
    iso, local = X.date_as("yyyy-MM-dd"), X.date_as("dd/MM/yyyy")
    values, by = read(spark, [iso, local], texts)
    d = datetime.date
    assert values == [d(2020, 12, 31), d(2020, 2, 29), None, None, None, d(2020, 12, 31), None, None, None, None, None]
    assert by[0] == "date yyyy-MM-dd" and by[5] == "date dd/MM/yyyy" and by[2] is None
    assert read(spark, [X.date_as("yyyyMMdd")], texts)[0][-1] == d(2020, 12, 31)
    for bad in ("yyyy-MM", "dd.MM.yyyy.dd", "HH:mm"):
        with pytest.raises(ValueError):
            X.date_as(bad)


def test_numbers_are_taken_whole_or_not_at_all(spark):
    texts = ["16777217", "123456789.12", "-0.5", ".5", "5.", "1e3", "12,5", "1.234,56", "1,234.56", "12345678901234567", "1e999", "1e-999", "0.0",
             "0.1000000000000000000", "abc", "NaN", "Infinity", "1 000", "+7", "1,23,4", None, "9007199254740993"]
    point = [16777217.0, 123456789.12, -0.5, 0.5, 5.0, 1000.0, None, None, None, None, None, None, 0.0, 0.1, None, None, None, None, 7.0, None, None, None]
    assert read(spark, [X.number_as(".")], texts)[0] == point
    values, by = read(spark, [X.number_as("."), X.number_as(",", ".")], texts)
    assert (values[6], values[7], values[8]) == (12.5, 1234.56, None) and by[6] == "number ,."
    assert read(spark, [X.number_as(".", ",")], texts)[0][8] == 1234.56 and read(spark, [X.number_as(".", ",")], texts)[0][19] is None
    assert read(spark, [X.number_as(".", " ")], texts)[0][17] == 1000.0
    rounded = read(spark, [X.number_as(".", rounded=True)], texts)[0]
    assert rounded[9] == 12345678901234568.0 and rounded[11] == 0.0 and rounded[10] is None
    for mark, grouping in (("", ""), (",", ","), ("5", "")):
        with pytest.raises(ValueError):
            X.number_as(mark, grouping)


def test_exact_decimals_and_whole_numbers(spark):
    values, _ = read(spark, [X.decimal_as(20, 2, ",", ".")], ["1.234,50", "0,125", "12345678901234567,89", "1234567890123456789,5", "x", None])
    assert values == [Decimal("1234.50"), None, Decimal("12345678901234567.89"), None, None, None]
    assert read(spark, [X.whole_as(".")], ["1.000", "12", "1.00", "3000000000", "-4", "4.5"])[0] == [1000, 12, None, None, -4, None]


LOCAL = {"date": (X.date_as("yyyy-MM-dd"), X.date_as("dd/MM/yyyy")), "QUANTITY": (X.number_as("."), X.number_as(","))}


@pytest.fixture
def text(spark):
    rows = [(1, "2020-01-02", "1", "1", "3"), (2, "31/12/2020", "12,5", "2,5", "x"), (3, "", "  ", None, " "), (4, "2020-5", "a", "16777217", "70000")]
    return spark.createDataFrame(rows, "id int, ARRIVAL_DATE string, QUANTITY string, CIF_VALUE string, EXPORT_DATA_TYPE string")


def test_typing_keeps_what_it_cannot_read_and_blanks_are_missing(text):
    typed = C.type_columns(text, parsers=LOCAL).orderBy("id")
    rows = typed.collect()
    d = datetime.date
    assert [r.ARRIVAL_DATE for r in rows] == [d(2020, 1, 2), d(2020, 12, 31), None, None]
    assert [r.QUANTITY for r in rows] == [1.0, 12.5, None, None]
    assert [r.CIF_VALUE for r in rows] == [1.0, None, None, 16777217.0]
    assert [r.EXPORT_DATA_TYPE for r in rows] == [3, None, None, 70000]
    assert [r[FAILED_CASTS] for r in rows] == [{}, {"CIF_VALUE": "2,5", "EXPORT_DATA_TYPE": "x"}, {}, {"ARRIVAL_DATE": "2020-5", "QUANTITY": "a"}]
    assert [r[PARSED_BY] for r in rows] == [{}, {"ARRIVAL_DATE": "date dd/MM/yyyy", "QUANTITY": "number ,"}, {}, {}]
    assert PARSED_BY not in C.type_columns(text).columns
    broken = {r.id: r.violations for r in Q.with_violations(C.finalize(typed)).collect()}
    assert "CIF_VALUE:float" in broken[2] and "EXPORT_DATA_TYPE:short" in broken[2] and "ARRIVAL_DATE:date" in broken[4]
    assert "EXPORT_DATA_TYPE:short" in broken[4] and not any(":float" in v or ":short" in v for v in broken[3])


def test_values_are_read_again_by_other_parsers(text):
    typed = C.type_columns(text)
    again = C.retype_columns(typed, parsers={**LOCAL, "CIF_VALUE": (X.number_as(","),)})
    rows = again.orderBy("id").collect()
    assert [r.QUANTITY for r in rows] == [1.0, 12.5, None, None] and [r.CIF_VALUE for r in rows] == [1.0, 2.5, None, 16777217.0]
    assert rows[1].ARRIVAL_DATE == datetime.date(2020, 12, 31)
    assert [set(r[FAILED_CASTS]) for r in rows] == [set(), {"EXPORT_DATA_TYPE"}, set(), {"ARRIVAL_DATE", "QUANTITY"}]
    assert C.retype_columns(again, parsers=LOCAL).orderBy("id").collect() == rows
    typed_already = text.select("id")
    assert C.retype_columns(typed_already).columns == ["id"]


def test_blanks_that_an_earlier_run_held_back_are_let_go(spark):
    df = spark.createDataFrame([(1, None, {"QUANTITY": "  "})], f"id int, QUANTITY double, {FAILED_CASTS} map<string,string>")
    assert C.retype_columns(df).first()[FAILED_CASTS] == {}
