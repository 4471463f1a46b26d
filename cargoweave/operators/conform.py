"""Operators that bring a raw table to the shipment layout."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cargoweave.functions.expressions import column, date_from_parts, record_id
from cargoweave.functions.parsing import DEFAULT_PARSERS, Parser, first_read, is_blank, parsed, trimmed
from cargoweave.layout import (
    COMPANY_FIELDS,
    P7_REQUIRED,
    SHIPMENT_FIELDS,
    Field,
    p7_schema,
    working_type,
)
from cargoweave.profiles import Added, Profile
from cargoweave.sources.tables import PART

#: Column of the values, by column name, that did not fit their types.
FAILED_CASTS = "failed_casts"
#: Column of the parsers, by column name, that read a value which the first of its chain did not.
PARSED_BY = "parsed_by"
#: Rules that give a field a type, in the order in which they do.
TYPE_RULES = ("float", "date", "short", "integer")

Parsers = Mapping[str, tuple[Parser, ...]]


def _by_lower_name(df: DataFrame) -> dict[str, str]:
    return {name.lower(): name for name in df.columns}


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename in one step; absent names are ignored, equal resulting names are an error."""
    renamed = df.withColumnsRenamed(dict(renames))
    counts = Counter(name.lower() for name in renamed.columns)
    repeated = sorted(name for name, n in counts.items() if n > 1)
    if repeated:
        raise ValueError(f"renaming yields repeated columns: {', '.join(repeated)}")
    return renamed


def add_columns(
    df: DataFrame,
    adds: Added,
    id_columns: Sequence[str] | None = None,
    random_ids: bool = False,
) -> DataFrame:
    """Add the columns that are absent, with a typed constant or a record id.

    The record id is a hash of ``id_columns`` (all input columns if not given);
    ``random_ids`` asks for a random UUID instead, which changes on every run.
    """
    present = _by_lower_name(df)
    types = {f.name: f.dataType for f in df.schema}

    def value(kind: str, default: object) -> Column:
        if kind == "UUID":
            return F.uuid() if random_ids else record_id(id_columns or [c for c in df.columns if c != PART], types)
        return F.lit(None if default == "" else default).cast(kind)

    return df.withColumns({
        name: value(*spec) for name, spec in adds.items() if name.lower() not in present
    })


def add_typed_columns(
    df: DataFrame, fields: Sequence[Field] = SHIPMENT_FIELDS, include_text: bool = True
) -> DataFrame:
    """Add absent layout fields as typed NULLs; ``include_text=False`` leaves out text fields."""
    present = _by_lower_name(df)
    types = {f.name: working_type(f) for f in fields if f.name.lower() not in present}
    return df.withColumns({
        name: F.lit(None).cast(kind)
        for name, kind in types.items()
        if include_text or not isinstance(kind, T.StringType)
    })


def reorder_columns(df: DataFrame, fields: Sequence[Field] = SHIPMENT_FIELDS) -> DataFrame:
    """Layout fields first, in layout order; other columns after them in their own order."""
    present = _by_lower_name(df)
    layout = {f.name.lower() for f in fields}
    first = [column(present[f.name.lower()]).alias(f.name) for f in fields if f.name.lower() in present]
    rest = [column(name) for name in df.columns if name.lower() not in layout]
    return df.select(*first, *rest)


def finalize(df: DataFrame, fields: Sequence[Field] = SHIPMENT_FIELDS) -> DataFrame:
    return reorder_columns(add_typed_columns(df, fields), fields)


def derive_arrival_date(df: DataFrame, parts: tuple[str, str, str]) -> DataFrame:
    """Fill a missing ARRIVAL_DATE from year, month and day columns."""
    derived = date_from_parts(*map(column, parts))
    return df.withColumn("ARRIVAL_DATE", F.coalesce(F.col("ARRIVAL_DATE"), derived))


def parsers_of(field: Field, parsers: Parsers) -> tuple[Parser, ...]:
    """The chain that reads a field: its own, else that of its kind. None for text."""
    kind = next((r for r in TYPE_RULES if r in field.rules), None)
    if kind is None:
        return ()
    return parsers.get(field.name) or parsers.get(kind) or DEFAULT_PARSERS[kind]


def type_columns(
    df: DataFrame, fields: Sequence[Field] = SHIPMENT_FIELDS, parsers: Parsers = {}
) -> DataFrame:
    """Bring text columns of typed layout fields to their types, losing nothing.

    Each text is read by the chain of its field (``parsers`` by field or kind, else the default).
    A blank one is NULL. One that no parser takes becomes NULL and stays, as it came, in the map
    ``FAILED_CASTS`` by field name; row validation rejects such a row. The map is only there if a
    column had to be typed. Where chains have several parsers, the map ``PARSED_BY`` names, by
    field, the parser of each value that the first one did not take.
    """
    present = _by_lower_name(df)
    chains = {
        f.name: parsers_of(f, parsers)
        for f in fields
        if f.name.lower() in present
        and isinstance(df.schema[present[f.name.lower()]].dataType, T.StringType)
        and parsers_of(f, parsers)
    }
    if not chains:
        return df
    own = df.columns
    text = {name: column(present[name.lower()]) for name in chains}
    # a column for what each parser reads: inside the map's entries Spark would read the texts again for every use
    df = df.withColumns({f"_bare_{name}": trimmed(text[name]) for name in chains})
    df = df.withColumns({f"_read_{name}_{i}": p.parse(column(f"_bare_{name}")) for name, chain in chains.items() for i, p in enumerate(chain)})
    read = {name: first_read([column(f"_read_{name}_{i}") for i in range(len(chain))], chain) for name, chain in chains.items()}

    def entries(of: Mapping[str, Column]) -> Column:
        """A map of the values that are not NULL."""
        return F.map_from_entries(F.array_compact(F.array(*(
            F.when(v.isNotNull(), F.struct(F.lit(name).alias("key"), v.alias("value"))) for name, v in of.items()
        ))))

    failed = {n: F.when(value.isNull() & ~is_blank(text[n]), text[n]) for n, (value, _) in read.items()}
    several = {n: by for n, (_, by) in read.items() if len(chains[n]) > 1}
    won = {n: F.nullif(by, F.lit(chains[n][0].name)) for n, by in several.items()}
    added = {FAILED_CASTS: entries(failed)} | ({PARSED_BY: entries(won)} if won else {})
    typed = df.withColumns({present[n.lower()]: value for n, (value, _) in read.items()} | added)
    return typed.select(*map(column, [c for c in own if c not in added]), *added)


def retype_columns(
    df: DataFrame, fields: Sequence[Field] = SHIPMENT_FIELDS, parsers: Parsers = {}
) -> DataFrame:
    """Read the values in ``FAILED_CASTS`` again, by other chains: those that are taken, or are
    blank, leave the map, and a value goes to its column where that is NULL."""
    if FAILED_CASTS not in df.columns:
        return df
    present = _by_lower_name(df)
    chains = {f.name: parsers_of(f, parsers) for f in fields if f.name.lower() in present and parsers_of(f, parsers)}
    left = column(FAILED_CASTS)
    read = {n: parsed(F.element_at(left, F.lit(n)), chain)[0] for n, chain in chains.items()}
    types = {f.name: f.dataType for f in df.schema}
    settled = F.array_compact(F.array(*(
        F.when(value.isNotNull() | is_blank(F.element_at(left, F.lit(n))), F.lit(n)) for n, value in read.items()
    )))
    values = {
        present[n.lower()]: F.coalesce(column(present[n.lower()]), value.try_cast(types[present[n.lower()]]))
        for n, value in read.items()
    }
    # both are made from the map as it is, then it is replaced
    return df.withColumns({**values, FAILED_CASTS: F.map_filter(left, lambda name, _: ~F.array_contains(settled, name))})


def conform(df: DataFrame, profile: Profile) -> DataFrame:
    """Raw table to working table: rename, type, add constants and ids, complete and order the layout."""
    df = rename_columns(df, profile.renames)
    df = type_columns(add_columns(df, profile.adds), parsers=profile.parsers)
    if profile.date_parts:
        df = derive_arrival_date(df, profile.date_parts)
    return finalize(df)


def _p7_columns(df: DataFrame) -> list[Column]:
    present = _by_lower_name(df)
    return [
        (
            column(present[f.name.lower()]).try_cast(f.dataType)
            if f.name.lower() in present
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in p7_schema()
    ]


def _p7_checked(df: DataFrame) -> DataFrame:
    """The delivered columns with the fields that keep a row back: required ones it lacks, then
    those whose value was there and does not fit its type, also if ``type_columns`` found so."""
    present = _by_lower_name(df)
    delivered = {f.name: f.dataType for f in p7_schema()}
    lacks = [
        F.when(column(present[c.lower()]).try_cast(delivered[c]).isNull() if c.lower() in present else F.lit(True), F.lit(c))
        for c in P7_REQUIRED
    ]
    unfit = [
        F.when(column(present[f.name.lower()]).isNotNull() & column(present[f.name.lower()]).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in p7_schema()
        if f.name.lower() in present and not isinstance(f.dataType, T.StringType)
    ]
    fields = F.array_compact(F.array(*lacks, *unfit))
    if FAILED_CASTS in df.columns:
        fields = F.concat(fields, F.map_keys(column(FAILED_CASTS)))
    return df.select(*_p7_columns(df), F.array_distinct(fields).alias("MISSING_FIELDS"))


def p7_projection(df: DataFrame) -> DataFrame:
    """The 46 delivered columns by name, for the rows that carry all required fields and no
    value that does not fit its type."""
    return _p7_checked(df).filter(F.size("MISSING_FIELDS") == 0).drop("MISSING_FIELDS")


def p7_rejects(df: DataFrame) -> DataFrame:
    """The other rows, with the fields that each one lacks or that do not fit."""
    return _p7_checked(df).filter(F.size("MISSING_FIELDS") > 0)


def company_file(df: DataFrame, sources: Mapping[str, str]) -> DataFrame:
    """Distinct companies in company layout; ``sources`` names the column behind each field."""
    return df.select(*(
        (column(sources[f.name]) if f.name in sources else F.lit(None)).cast("string").alias(f.name)
        for f in COMPANY_FIELDS
    )).distinct()


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty strings become NULL in the listed text columns; white space alone stays."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns({
        c: F.nullif(column(c), F.lit("")) for c in columns if c in text
    })
