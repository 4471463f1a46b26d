"""Column expressions shared by the operators. All run inside Spark's codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F, types as T

# Patterns of the source data.
COMPANY_NOISE = """.,-"'&/#() +:<>"""
TA_CODE_PATTERN = r"^[A-Z]{2}[0-9]{8}\z"
HS_CODE_PATTERN = r"^[0-9]+\z"
RAW_TABLE_PATTERN = r"^yeni_veri_([a-z]{2})_(20[0-9]{2})_([0-9]{2})"
PROCESSED_SUFFIX = "_islendi"


def column(name: str) -> Column:
    """A column by its literal name, even if that name holds dots or back-ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def company_key(name: Column) -> Column:
    """Company name without punctuation and spaces; NULL when nothing is left."""
    return F.nullif(F.translate(name, COMPANY_NOISE, ""), F.lit(""))


def is_ta_code(value: Column) -> Column:
    return F.coalesce(value.rlike(TA_CODE_PATTERN), F.lit(False))


def is_hs_code(value: Column) -> Column:
    return F.coalesce(value.rlike(HS_CODE_PATTERN), F.lit(False))


def data_type_of(table_name: Column) -> Column:
    """IMPORT or EXPORT by the table's name, NULL when the name tells neither."""
    name = F.upper(table_name)
    return F.when(name.contains("IMP"), "IMPORT").when(name.contains("EXP"), "EXPORT")


def data_type_of_name(table_name: str) -> str:
    """Same as :func:`data_type_of` for one name on the driver; ValueError if unknown."""
    name = table_name.upper()
    for mark, data_type in (("IMP", "IMPORT"), ("EXP", "EXPORT")):
        if mark in name:
            return data_type
    raise ValueError(f"cannot tell import from export: {table_name!r}")


def is_raw_table(table_name: Column) -> Column:
    """Raw tables follow the name pattern and are no output of an earlier run."""
    return table_name.rlike(RAW_TABLE_PATTERN) & ~table_name.endswith(PROCESSED_SUFFIX)


def raw_table_parts(table_name: Column) -> dict[str, Column]:
    """Country code, year and month held in a raw table's name."""

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(table_name, RAW_TABLE_PATTERN, group), F.lit(""))

    return {
        "country_code": F.upper(part(1)),
        "year": part(2).cast("int"),
        "month": part(3).cast("int"),
    }


def _stable_text(name: str, data_type: T.DataType) -> Column:
    value = column(name)
    text = value.cast("string")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # A float's text depends on the Java version; whole millionths do not.
        number = value.cast("double")
        millionths = F.floor(number * 1e6 + 0.5)
        whole = (F.abs(number) < 9e12) & (millionths.cast("double") / 1e6 == number)
        text = F.when(whole, millionths.cast("string")).otherwise(text)
    # both uses of the text are always computed, so Spark makes it once
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("n"))


def record_id(columns: Iterable[str], types: Mapping[str, T.DataType]) -> Column:
    """MD5 over the columns' text, each in its place: equal rows get equal ids on every run.

    Each text stands behind its length and NULL is told from empty, so rows that differ
    anywhere have different texts.
    """
    return F.md5(F.concat_ws("|", *(_stable_text(c, types[c]) for c in columns)))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """The date, or NULL when a part is missing or no such day exists."""
    text = F.concat(
        year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string")
    )
    return F.try_to_timestamp(text, F.lit("y-M-d")).cast("date")
