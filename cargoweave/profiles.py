"""Country profiles: how a raw table's headings and constants map to the layout."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from cargoweave.functions.parsing import Parser

# (type, default); a blank or None default is NULL, UUID asks for a record id.
Added = dict[str, tuple[str, object]]


class Profile(NamedTuple):
    country: str
    data_type: str
    renames: dict[str, str]
    adds: Added
    date_parts: tuple[str, str, str] | None = None  # year, month, day columns
    # How text is read, by layout field or by its kind (date, float, short, integer); the first
    # parser that takes a value wins. What is not named is read by DEFAULT_PARSERS.
    parsers: Mapping[str, tuple[Parser, ...]] = {}


# Costa Rica import headings and constants.
CR_IMPORT = Profile(
    "CR",
    "IMPORT",
    renames={
        "DATE": "ARRIVAL_DATE",
        "OPERATION#": "DECLARATION_NUMBER",
        "ITEM": "ITEM_NO",
        "IMPORTER#": "IMPORTER_TAX_ID",
        "IMPORTER": "IMPORTER_NAME",
        "HS CODE": "HS_CODE",
        "GOODS DESCRIPTION": "PRODUCT_DETAILS",
        "COUNTRY_ORIGIN": "COUNTRY_OF_ORIGIN",
        "COUNTRY_ACQUISITION": "yedek_EXPORTER_COUNTRY",
        "SHIPPING_COUNTRY": "EXPORTER_COUNTRY",
        "QUANTITY": "QUANTITY",
        "UNIT": "QUANTITY_UNIT",
        "VALUE_(USD)": "CIF_VALUE",
        "NET_WEIGHT_(KG)": "NET_WEIGHT",
        "GROSS_WEIGHT_(KG)": "GROSS_WEIGHT",
        "INGRESS_CUSTOMS": "PORT_OF_ARRIVAL",
    },
    adds={
        "NET_WEIGHT_UNIT": ("STRING", "Kilogram"),
        "GROSS_WEIGHT_UNIT": ("STRING", "Kilogram"),
        "CIF_CURRENCY": ("STRING", "USD"),
        "IMPORTER_COUNTRY": ("STRING", "CR"),
        "PORT_OF_DEPARTURE": ("STRING", ""),
        "IMPORTER_TA_CODE": ("STRING", ""),
        "EXPORTER_TA_CODE": ("STRING", ""),
        "DATA_TYPE": ("STRING", "Custom"),
        "EXPORT_DATA_TYPE": ("INTEGER", "4"),
        "IMPORT_DATA_TYPE": ("INTEGER", "1"),
        "RECORD_ID": ("UUID", ""),
        # Not in the source tables, but read by the company-code stage.
        "EXPORTER_NAME": ("STRING", ""),
    },
)

# Export tables spell the same headings with spaces. The targets are the import
# ones (importer country CR too): kept as the source system defines them.
CR_EXPORT = Profile(
    "CR",
    "EXPORT",
    renames={
        heading.replace("_", " "): target for heading, target in CR_IMPORT.renames.items()
    },
    adds={"ARRIVAL_DATE": ("DATE", "1900-01-01"), **CR_IMPORT.adds},
)

# Argentina import columns, headings and constants.
AR_IMPORT_COLUMNS = (
    "DAY",
    "MONTH",
    "YEAR",
    "IMPORT_ID",
    "OPER_TYPE",
    "CUSTOMS",
    "IMPORTER_ID",
    "IMPORTER",
    "SALES_COUNTRY",
    "TRANS_TYPE",
    "ORIGIN_PORT",
    "INCOTERMS",
    "TOTAL_FOB",
    "TOTAL_FREIGHT",
    "TOTAL_INSURANCE",
    "TOTAL_CIF",
    "PACKAGES",
    "G_WEIGHT",
    "ITEM_NUMBER",
    "ORIGIN_COUNTRY",
    "QUANTITY",
    "UNIT_OF_QUANTITY",
    "ITEM_FOB",
    "ITEM_FREIGHT",
    "ITEM_INSURANCE",
    "HS_CODE",
    "PRODUCT_DESC",
    "ITEM_CIF",
    "SUBITEM_NUMBER",
    "BRAND",
    "VARIETY",
    "ATTRIBUTES",
    "SUBITEM_FOB",
    "SUBITEM_QUANTITY",
)

AR_IMPORT = Profile(
    "AR",
    "IMPORT",
    renames={
        "IMPORT_ID": "DECLARATION_NUMBER",
        "OPER_TYPE": "REGIME",
        "CUSTOMS": "PORT_OF_ARRIVAL",
        "IMPORTER_ID": "IMPORTER_TAX_ID",
        "IMPORTER": "IMPORTER_NAME",
        "SALES_COUNTRY": "EXPORTER_COUNTRY",
        "TRANS_TYPE": "TRANSPORT_TYPE",
        "ORIGIN_PORT": "PORT_OF_DEPARTURE",
        "PACKAGES": "PACKAGE_AMOUNT",
        "G_WEIGHT": "GROSS_WEIGHT",
        "ORIGIN_COUNTRY": "COUNTRY_OF_ORIGIN",
        "UNIT_OF_QUANTITY": "QUANTITY_UNIT",
        "ITEM_FOB": "FOB_VALUE",
        "ITEM_FREIGHT": "FREIGHT_AMOUNT",
        "ITEM_INSURANCE": "INSURANCE_AMOUNT",
        "PRODUCT_DESC": "PRODUCT_DETAILS",
        "ITEM_CIF": "CIF_VALUE",
        "BRAND": "BRAND_NAME",
    },
    adds={
        "ARRIVAL_DATE": ("DATE", None),
        "PACKAGES_UNIT": ("STRING", "Pieces"),
        "GROSS_WEIGHT_UNIT": ("STRING", "Kilogram"),
        "FOB_CURRENCY": ("STRING", "USD"),
        "F_I_CURRENCY": ("STRING", "USD"),
        "CIF_CURRENCY": ("STRING", "USD"),
        "IMPORTER_COUNTRY": ("STRING", "AR"),
        "EXPORT_DATA_TYPE": ("INTEGER", 4),
        "IMPORT_DATA_TYPE": ("INTEGER", 1),
        "DATA_TYPE": ("STRING", "Custom"),
        "IMPORTER_TA_CODE": ("STRING", None),
        "EXPORTER_TA_CODE": ("STRING", None),
        "RECORD_ID": ("UUID", None),
        "EXPORTER_NAME": ("STRING", None),
    },
    date_parts=("YEAR", "MONTH", "DAY"),
)

PROFILES = {(p.country, p.data_type): p for p in (CR_IMPORT, CR_EXPORT, AR_IMPORT)}


def profile_for(country: str, data_type: str) -> Profile:
    """The profile of a country's import or export tables; ValueError if there is none."""
    if data_type not in ("IMPORT", "EXPORT"):
        raise ValueError(f"data type must be IMPORT or EXPORT, not {data_type!r}")
    try:
        return PROFILES[country.upper(), data_type]
    except KeyError:
        raise ValueError(f"no {data_type} profile for {country!r}") from None


# Names of the per-country lookup tables, and headings that lookup
# tables carry at their source, with the names the operators use.
COUNTRY_TABLES = {
    "hs": "{country}_hs_desc",
    "units": "{country}_unit_of_quantity",
    "companies": "{country}_kod_atama",
}
LOOKUP_HEADINGS = {
    "Alpha-2 code": "alpha2",
    "English short name (upper/lower case)": "short_name",
    "UNIT_OF_QUANTITY": "unit",
    "Yeni_Birim": "new_unit",
    "Aksiyon": "factor",
}


def country_table_name(kind: str, country: str) -> str:
    """Name of a country's lookup table; ``kind`` is hs, units or companies."""
    return COUNTRY_TABLES[kind].format(country=country)
