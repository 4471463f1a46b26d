"""The shipment and company layouts, their rules, and the country-code list."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import cache
from importlib import resources
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, types as T


class Field(NamedTuple):
    name: str
    rules: tuple[str, ...]


# The shipment layout in column order, each field with its rules.
SHIPMENT_FIELDS = (
    Field("ARRIVAL_DATE", ("exist", "date")),
    Field("BILL_OF_LADING_NO", ("text",)),
    Field("DECLARATION_NUMBER", ("text",)),
    Field("HS_CODE", ("exist", "hs_code")),
    Field("HS_CODE_DESCRIPTION", ("text",)),
    Field("PRODUCT_DETAILS", ("text",)),
    Field("IMPORTER_TA_CODE", ("exist", "ta_code")),
    Field("EXPORTER_TA_CODE", ("exist", "ta_code")),
    Field("FOB_VALUE", ("float",)),
    Field("FOB_CURRENCY", ("text",)),
    Field("FREIGHT_AMOUNT", ("float",)),
    Field("INSURANCE_AMOUNT", ("float",)),
    Field("F_I_CURRENCY", ("text",)),
    Field("CIF_VALUE", ("float",)),
    Field("CIF_CURRENCY", ("text",)),
    Field("STATISTICAL_VALUE_USD", ("float",)),
    Field("UNIT_PRICE", ("float",)),
    Field("NET_WEIGHT", ("float",)),
    Field("NET_WEIGHT_UNIT", ("text",)),
    Field("GROSS_WEIGHT", ("float",)),
    Field("GROSS_WEIGHT_UNIT", ("text",)),
    Field("QUANTITY", ("float",)),
    Field("QUANTITY_UNIT", ("text",)),
    Field("PACKAGE_AMOUNT", ("float",)),
    Field("PACKAGES_UNIT", ("text",)),
    Field("INCOTERMS", ("text",)),
    Field("PAYMENT_TYPE", ("text",)),
    Field("TRANSPORT_TYPE", ("text",)),
    Field("REGIME", ("text",)),
    Field("BRAND_NAME", ("text",)),
    Field("MANUFACTURING_COMPANY", ("text",)),
    Field("COUNTRY_OF_ORIGIN", ("exist", "country")),
    Field("PORT_OF_ARRIVAL", ("text",)),
    Field("PORT_OF_DEPARTURE", ("text",)),
    Field("CONDITION_New_Used", ("text",)),
    Field("NOTIFY_PARTY", ("text",)),
    Field("NOTIFY_ADDRESS", ("text",)),
    Field("TRANSPORT_COMPANY", ("text",)),
    Field("CONTAINER_COUNT", ("float",)),
    Field("TOTAL_TEUS", ("float",)),
    Field("EXPORT_DATA_TYPE", ("short",)),
    Field("IMPORT_DATA_TYPE", ("short",)),
    Field("ITEM_NO", ("float",)),
    Field("DATA_TYPE", ("text",)),
    Field("VESSEL_NAME", ("text",)),
    Field("RECORD_ID", ("exist",)),
)

# The company layout in column order.
COMPANY_FIELDS = (
    Field("TA_CODE", ("exist", "ta_code")),
    Field("COMPANY_TAX_ID", ("text",)),
    Field("COMPANY_NAME", ("exist", "text")),
    Field("COMPANY_ADDRESS", ("text",)),
    Field("CITY_STATE", ("text",)),
)

# The fields that a delivered (p7) row must carry.
P7_REQUIRED = (
    "ARRIVAL_DATE",
    "IMPORTER_TA_CODE",
    "EXPORTER_TA_CODE",
    "COUNTRY_OF_ORIGIN",
    "EXPORT_DATA_TYPE",
    "IMPORT_DATA_TYPE",
    "DATA_TYPE",
    "RECORD_ID",
)

# The columns whose NULLs an audit counts.
AUDITED_COLUMNS = (
    "PORT_OF_ARRIVAL",
    "PORT_OF_DEPARTURE",
    "HS_CODE",
    "HS_CODE_DESCRIPTION",
    "ARRIVAL_DATE",
    "IMPORTER_TA_CODE",
    "EXPORTER_TA_CODE",
    "QUANTITY",
    "QUANTITY_UNIT",
    "COUNTRY_OF_ORIGIN",
)

# Codes the trade list has beyond the public standard, in their order.
EXTRA_COUNTRIES = {
    "OS": "South Ossetia Region",
    "AN": "Netherlands Antilles",
    "KV": "Kosovo",
    "AB": "Abkhazia Region",
    "ZZ": "N/A",
    "EU": "Europe Union",
}
UNKNOWN_COUNTRY = "ZZ"


def working_type(field: Field) -> T.DataType:
    """Type of a field in the working table."""
    if "float" in field.rules:
        return T.DoubleType()
    if "date" in field.rules:
        return T.DateType()
    if "short" in field.rules or "integer" in field.rules:
        return T.IntegerType()
    return T.StringType()


def p7_schema() -> T.StructType:
    """The delivered layout: the date keeps its type, numbers are narrowed to floats, the rest is text."""

    def delivered(field: Field) -> T.DataType:
        if "float" in field.rules:
            return T.FloatType()
        return T.DateType() if "date" in field.rules else T.StringType()

    return T.StructType([T.StructField(f.name, delivered(f), f.name not in P7_REQUIRED) for f in SHIPMENT_FIELDS])


def company_schema() -> T.StructType:
    return T.StructType([
        T.StructField(f.name, T.StringType(), "exist" not in f.rules) for f in COMPANY_FIELDS
    ])


@cache
def _iso_names() -> dict[str, str]:
    table = resources.files("tzdata").joinpath("zoneinfo", "iso3166.tab")
    lines = table.read_text(encoding="utf-8").splitlines()
    return dict(line.split("\t")[:2] for line in lines if line and not line.startswith("#"))


def country_codes(iso_codes: Iterable[str] | None = None) -> list[str]:
    """Two-letter trade codes in list order.

    The rule: the public ISO 3166-1 codes in alphabetical order, the United
    Kingdom written UK instead of GB, then the extra codes. Pass ``iso_codes``
    to use another edition of the standard than the one tzdata carries.
    """
    iso = _iso_names() if iso_codes is None else iso_codes
    return sorted({"UK" if code == "GB" else code for code in iso}) + list(EXTRA_COUNTRIES)


def country_table(spark: SparkSession, names: Mapping[str, str] | None = None) -> DataFrame:
    """The code list as a table ``position, code, name``.

    Names are those of the public standard's table; ``names`` overrides any of them.
    """
    known = {**_iso_names(), "UK": "United Kingdom", **EXTRA_COUNTRIES, **(names or {})}
    rows = [(i, code, known.get(code)) for i, code in enumerate(country_codes(), start=1)]
    return spark.createDataFrame(rows, "position int, code string, name string")
