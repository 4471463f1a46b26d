"""Operators that fill and correct shipment columns from lookup tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cargoweave.functions.expressions import column, company_key
from cargoweave.layout import UNKNOWN_COUNTRY, country_codes
from cargoweave.operators.lookup import (
    Lookup,
    found,
    frequent,
    left_lookup,
    lookup_table,
    measured,
    prepared,
)
from cargoweave.sources.tables import PART, in_parts, stage
from cargoweave.profiles import LOOKUP_HEADINGS, country_table_name

COUNTRY_COLUMNS = ("COUNTRY_OF_ORIGIN", "EXPORTER_COUNTRY", "IMPORTER_COUNTRY")


def union_by_country(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One lookup table with a ``country`` column out of one table per country."""
    return reduce(
        DataFrame.unionByName,
        (table.withColumn("country", F.lit(code)) for code, table in tables.items()),
    )


def read_by_country(
    read: Callable[[str], DataFrame], kind: str, countries: Sequence[str]
) -> DataFrame:
    """The lookup tables of several countries as one; ``read`` opens a table by its name."""
    return union_by_country({c: read(country_table_name(kind, c)) for c in countries})


def for_country(table: DataFrame, country: str) -> DataFrame:
    return table.filter(F.col("country") == country)


def country_names(table: DataFrame, **options) -> Lookup:
    """Lookup of country spellings; columns country2, code."""
    return lookup_table(table, ["country2"], ["code"], **options)


def port_names(table: DataFrame, **options) -> Lookup:
    """Lookup of unique countries; columns alpha2, short_name, or their source headings."""
    table = table.withColumnsRenamed(LOOKUP_HEADINGS)
    return lookup_table(table, ["alpha2"], ["short_name"], **options)


def hs_descriptions(table: DataFrame, country: str, **options) -> Lookup:
    """Lookup of a country's tariff codes; columns country, HS_CODE, HS_CODE_DESC, new_HS_CODE."""
    return lookup_table(
        for_country(table, country), ["HS_CODE"], ["HS_CODE_DESC", "new_HS_CODE"], **options
    )


def unit_factors(table: DataFrame, country: str, **options) -> Lookup:
    """Lookup of a country's units; columns country, unit, new_unit, factor, or source headings."""
    table = for_country(table, country).withColumnsRenamed(LOOKUP_HEADINGS)
    return lookup_table(table, ["unit"], ["new_unit", "factor"], **options)


def map_country(df: DataFrame, country_column: str, names: Lookup) -> DataFrame:
    """Replace a country's spelling by its code; unknown spellings stay."""
    value = column(country_column)
    return left_lookup(
        df, names, {"country2": value}, {country_column: F.coalesce(found("code"), value)}
    )


def map_countries(df: DataFrame, names: Lookup) -> DataFrame:
    ready = prepared(df, [(names, {"country2": column(c)}) for c in COUNTRY_COLUMNS])
    for country_column, known in zip(COUNTRY_COLUMNS, ready):
        df = map_country(df, country_column, known)
    return df


def crossfill_countries(df: DataFrame) -> DataFrame:
    """Origin and exporter country fill each other; what is then missing becomes ZZ."""
    # Whichever side is missing takes the other's value, so one fallback serves both.
    origin, exporter = F.col("COUNTRY_OF_ORIGIN"), F.col("EXPORTER_COUNTRY")
    unknown = F.lit(UNKNOWN_COUNTRY)
    return df.withColumns({
        "COUNTRY_OF_ORIGIN": F.coalesce(origin, exporter, unknown),
        "EXPORTER_COUNTRY": F.coalesce(exporter, origin, unknown),
    })


#: The country that fills each port.
PORTS = (("IMPORTER_COUNTRY", "PORT_OF_ARRIVAL"), ("EXPORTER_COUNTRY", "PORT_OF_DEPARTURE"))


def port_match(country_column: str, port_column: str) -> dict[str, Column]:
    """Rows that have a port search for none."""
    return {"alpha2": F.when(column(port_column).isNull(), column(country_column))}


def fill_port(df: DataFrame, country_column: str, port_column: str, ports: Lookup) -> DataFrame:
    """Fill a missing port with the short name of the country's code."""
    return left_lookup(
        df,
        ports,
        port_match(country_column, port_column),
        {port_column: F.coalesce(column(port_column), found("short_name"))},
    )


def fill_ports(df: DataFrame, ports: Lookup, departure_ports: Lookup | None = None) -> DataFrame:
    """Both ports; ``departure_ports`` is the lookup as prepared for those, ``ports`` then that of arrival."""
    given = (ports, departure_ports or ports)
    ready = prepared(df, [(known, port_match(*names)) for known, names in zip(given, PORTS)])
    for known, (country_column, port_column) in zip(ready, PORTS):
        df = fill_port(df, country_column, port_column, known)
    return df


def enrich_hs(
    df: DataFrame, descriptions: Lookup, hot: Sequence[int] | None = None, only: Column | None = None
) -> DataFrame:
    """Take description and replacement of a tariff code; both by the code as it came.

    ``only`` names the rows to look up, where others already have their new code.
    """
    code = F.col("HS_CODE") if only is None else F.when(only, F.col("HS_CODE"))
    return left_lookup(
        df,
        descriptions,
        {"HS_CODE": code},
        {
            "HS_CODE": F.coalesce(found("new_HS_CODE"), F.col("HS_CODE")),
            "HS_CODE_DESCRIPTION": F.coalesce(found("HS_CODE_DESC"), F.col("HS_CODE_DESCRIPTION")),
        },
        hot,
    )


def convert_units(
    df: DataFrame,
    units: Lookup,
    unit_column: str = "QUANTITY_UNIT",
    quantity_column: str = "QUANTITY",
) -> DataFrame:
    """Take the new unit and multiply the quantity; without a factor the quantity stays."""
    unit, quantity = column(unit_column), column(quantity_column)
    kind = df.schema[quantity_column].dataType
    times = quantity * found("factor")
    if isinstance(kind, T.StringType):  # text that is no number stays as it is
        times = F.coalesce((quantity.try_cast("double") * found("factor")).cast("string"), quantity)
    elif isinstance(kind, T.DecimalType):
        times = times.cast(kind)
    return left_lookup(
        df,
        units,
        {"unit": unit},
        {
            unit_column: F.coalesce(found("new_unit"), unit),
            quantity_column: F.when(
                found("factor").isNotNull(), times
            ).otherwise(quantity),
        },
    )


def present_countries(
    df: DataFrame, country_column: str, codes: Sequence[str] | None = None
) -> DataFrame:
    """The listed codes that occur in a column; at most as many rows as the list has codes."""
    listed = country_codes() if codes is None else list(codes)
    return (
        df.select(column(country_column).alias("country"))
        .filter(F.col("country").isin(listed))
        .distinct()
    )


def company_codes(
    companies: DataFrame,
    scope: str = "country",
    present: DataFrame | None = None,
    codes: Sequence[str] | None = None,
    **options,
) -> Lookup:
    """Lookup of TA codes by company key; columns country, COMPANY_ham, TA_CODE.

    Scope ``country`` looks a company up in its own country's list only. Scope
    ``any`` looks in the lists of all countries in ``present``; the country first
    in ``codes`` wins, then the smallest code.
    """
    keyed = companies.select(
        "country", company_key(F.col("COMPANY_ham")).alias("company_key"), "TA_CODE"
    ).dropna()
    if scope == "country":
        return lookup_table(keyed, ["country", "company_key"], ["TA_CODE"], **options)
    if scope != "any" or present is None:
        raise ValueError("scope is 'country', or 'any' together with the present countries")
    listed = country_codes() if codes is None else list(codes)
    position = F.array_position(F.lit(listed), F.col("country"))
    # ``present`` holds listed codes only, so its size is bounded by the list.
    ranked = keyed.join(F.broadcast(present), "country", "left_semi").select(
        "company_key", position.alias("position"), "TA_CODE"
    )
    lookup = lookup_table(ranked, ["company_key"], ["position", "TA_CODE"], **options)
    # Measured before the semi-join: a bound that needs no pass over the shipments.
    (bound,) = measured(lookup_table(keyed, ["company_key"], ["country", "TA_CODE"]))
    return replace(lookup, size=bound.size)


class Side(NamedTuple):
    """The columns of one party of a shipment."""

    country: str
    name: str
    ta_code: str
    tax_id: str

    def match(self, companies: Lookup) -> dict[str, Column]:
        """Rows that have a TA code search for none."""
        wanted = F.when(column(self.ta_code).isNull(), company_key(column(self.name)))
        within = {"country": column(self.country)} if "country" in companies.keys else {}
        return {"company_key": wanted, **within}


EXPORTER = Side("EXPORTER_COUNTRY", "EXPORTER_NAME", "EXPORTER_TA_CODE", "EXPORTER_TAX_ID")
IMPORTER = Side("IMPORTER_COUNTRY", "IMPORTER_NAME", "IMPORTER_TA_CODE", "IMPORTER_TAX_ID")


def assign_ta_code(
    df: DataFrame, side: Side, companies: Lookup, hot: Sequence[int] | None = None
) -> DataFrame:
    """Fill a missing TA code by company name, within the country or any, as the lookup says."""
    code = F.coalesce(column(side.ta_code), found("TA_CODE"))
    return left_lookup(df, companies, side.match(companies), {side.ta_code: code}, hot)


def assign_ta_codes(
    df: DataFrame,
    companies: Lookup,
    importer_companies: Lookup | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Both sides; scope ``any`` needs one lookup per side, as the present countries differ.

    Lookups too large to broadcast are reduced to the companies of both sides in one pass over
    ``probe``: a table with the same parties as ``df`` that is cheaper to compute, or ``df``
    itself, which is then written once, in parts, and not shuffled.
    """
    (companies,) = measured(companies)
    given = (companies, *measured(importer_companies or companies))
    whole = df if all(k.small or k.all_hot for k in given) else placed(df)
    sides, source = (EXPORTER, IMPORTER), whole if probe is None else probe
    ready = prepared(source, [(k, side.match(k)) for side, k in zip(sides, given)])
    for side, lookup in zip(sides, ready):
        whole = assign_ta_code(whole, side, lookup)
    return whole.select(*map(column, df.columns))


def placed(df: DataFrame) -> DataFrame:
    """``df`` in parts, for several large lookups, unless it is already or is a stream."""
    return df if PART in df.columns or df.isStreaming else in_parts(df, "rows")


#: What a company is known by, in the order in which it counts.
TAX_ID, NAME = "tax id", "name"
PARTY_KEYS = ("country", "tax_key", "name_key")


def _party(df: DataFrame, side: Side) -> dict[str, Column]:
    """The keys of a party, '' for a missing one. Absent columns are missing values."""
    def value(name: str) -> Column:
        return column(name) if name in df.columns else F.lit(None).cast("string")
    keys = (value(side.country), company_key(value(side.tax_id)), company_key(value(side.name)))
    return {k: F.coalesce(v.cast("string"), F.lit("")) for k, v in zip(PARTY_KEYS, keys)}


def wanted_parties(df: DataFrame, sides: Sequence[Side] = (EXPORTER, IMPORTER)) -> DataFrame:
    """The parties without a code: side (its number), country, tax id, name, and n rows; in one pass, staged."""
    wanted = [
        F.when(column(side.ta_code).isNull() & column(side.country).isNotNull(), F.struct(
            F.lit(i).alias("side"), *(e.alias(k) for k, e in _party(df, side).items())
        ))
        for i, side in enumerate(sides)
    ]
    each = df.select(F.explode(F.array_compact(F.array(*wanted))).alias("p")).select("p.*")
    return stage(each.groupBy("side", *PARTY_KEYS).agg(F.count(F.lit(1)).alias("n")), "parties")


def resolved_parties(
    df: DataFrame, companies: DataFrame, sides: Sequence[Side] = (EXPORTER, IMPORTER),
    order: Sequence[str] = (TAX_ID, NAME), wanted: DataFrame | None = None, **options,
) -> Lookup:
    """Lookup of TA codes by party (country, tax id, name), for the parties without a code in ``df``.

    ``companies`` has country, COMPANY_TAX_ID, COMPANY_ham and TA_CODE. A party takes the code of
    its country's company with the same tax id, else that of the same name, or as ``order`` says;
    of several companies the smallest code. Tax ids are compared like names, without
    punctuation. ``matched_by`` says what decided. ``wanted`` are the parties where the caller has them.

    The distinct parties of all sides are exploded into their keys, and meet the companies'
    keys in one join, however many keys and sides there are; the best rank of each party stays.
    The result holds only parties that occur and are known.
    """
    parties = (wanted_parties(df, sides) if wanted is None else wanted).select(*PARTY_KEYS).distinct()
    keys = {TAX_ID: "tax_key", NAME: "name_key"}
    ranked = parties.select("*", F.explode(F.array(*(
        F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.col(keys[kind]).alias("key")) for rank, kind in enumerate(order)
    ))).alias("k")).select(*PARTY_KEYS, "k.*").where("key <> ''").withColumn("code", F.lit(None).cast("string"))
    company = {TAX_ID: company_key(F.col("COMPANY_TAX_ID")), NAME: company_key(F.col("COMPANY_ham"))}
    known = companies.select("country", "TA_CODE", F.explode(F.array(*(
        F.struct(F.lit(kind).alias("kind"), company[kind].alias("key")) for kind in order
    ))).alias("k")).select("country", "k.kind", "k.key", "TA_CODE").dropna()
    by_key = lookup_table(known, ["country", "kind", "key"], ["TA_CODE"], **options)
    match = {k: F.col(k) for k in ("country", "kind", "key")}
    best = left_lookup(ranked, by_key, match, {"code": found("TA_CODE")}).where(F.col("code").isNotNull()).groupBy(*PARTY_KEYS).agg(
        F.min(F.struct("rank", "kind", "code")).alias("best")
    )
    rows = best.select(*PARTY_KEYS, F.col("best.code").alias("TA_CODE"), F.col("best.kind").alias("matched_by"))
    (lookup,) = measured(lookup_table(stage(rows, "known-parties"), PARTY_KEYS, ["TA_CODE", "matched_by"], **options))
    return lookup


def assign_ta_codes_by_rank(
    df: DataFrame, companies: DataFrame, sides: Sequence[Side] = (EXPORTER, IMPORTER),
    probe: DataFrame | None = None, matched_by: bool = False, **options,
) -> DataFrame:
    """Fill missing TA codes of all sides by tax id, then by name, within the party's country.

    ``probe`` is a table with the same parties that is cheaper to compute. With ``matched_by`` a
    column such as IMPORTER_TA_CODE_BY says what a code was found by, NULL where it was there
    or is still missing. ``options`` are those of ``resolved_parties``.
    """
    own = [*df.columns, *(f"{side.ta_code}_BY" for side in sides if matched_by)]
    limit = {k: v for k, v in options.items() if k == "broadcast_bytes"}
    listed = lookup_table(companies, ["country"], ["COMPANY_TAX_ID", "COMPANY_ham", "TA_CODE"], **limit)
    if not measured(listed)[0].small:
        df = placed(df)
    source = df if probe is None else probe
    wanted = wanted_parties(source, sides)
    parties = resolved_parties(source, companies, sides, wanted=wanted, **options)
    ready = [parties for _ in sides]

    def match(side: Side) -> dict[str, Column]:
        return {k: F.when(column(side.ta_code).isNull(), v) for k, v in _party(df, side).items()}

    if not parties.small:
        figures = {r["side"]: r for r in wanted.groupBy("side").agg(F.sum("n").alias("rows"), F.count("*").alias("keys")).collect()}
        counts = wanted.withColumn("held_code", F.xxhash64(*PARTY_KEYS))
        for i in range(len(sides)):
            rows, keys = (figures[i]["rows"], figures[i]["keys"]) if i in figures else (0, 0)
            hot = () if PART in df.columns else frequent(counts.where(F.col("side") == i), rows, keys)[0]
            ready[i] = replace(parties, hot=hot, searches=rows)
    for side, known in zip(sides, ready):
        updates = {side.ta_code: F.coalesce(column(side.ta_code), found("TA_CODE"))}
        by = f"{side.ta_code}_BY"
        if matched_by:
            df = df.withColumn(by, F.lit(None).cast("string"))
            updates[by] = found("matched_by")
        df = left_lookup(df, known, match(side), updates)
    return df.select(*map(column, own))
