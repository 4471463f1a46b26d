"""The processing stages and the full process, each one lazy plan."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields, replace
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from cargoweave.functions.expressions import column, data_type_of_name
from cargoweave.operators import conform as C, enrich as E, quality as Q
from cargoweave.operators.lookup import BROADCAST_BYTES, Lookup, measured, prepared
from cargoweave.profiles import Profile, profile_for
from cargoweave.sources.ledger import claim, mark_processed, new_owner, raw_names, read_ledger, release, unprocessed_tables
from cargoweave.sources.published import new_version, publish, read_published
from cargoweave.sources.tables import PART, read_table, stage, write_outcomes, write_table

#: Column of the values, before any lookup, of fields that lookups replace.
AS_CAME = "as_came"
KEPT_FIELDS = ("HS_CODE", "HS_CODE_DESCRIPTION", "QUANTITY", "QUANTITY_UNIT")
#: Column of what remediation has changed: the round and the field of each repair.
REPAIRS = "repairs"
RECORD_ID = "RECORD_ID"
REPAIRABLE = (
    "ARRIVAL_DATE", "HS_CODE", "HS_CODE_DESCRIPTION", "IMPORTER_TA_CODE", "EXPORTER_TA_CODE",
    "QUANTITY", "QUANTITY_UNIT", "COUNTRY_OF_ORIGIN", "EXPORTER_COUNTRY",
)


@dataclass(frozen=True)
class Lookups:
    """The measured lookups of one country. Prepare once, use in every stage."""

    countries: Lookup
    ports: Lookup
    hs: Lookup
    units: Lookup
    companies: Lookup

    @classmethod
    def prepare(
        cls,
        country: str,
        country_names: DataFrame,
        port_names: DataFrame,
        hs_descriptions: DataFrame,
        units: DataFrame,
        companies: DataFrame,
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> Lookups:
        limit = {"broadcast_bytes": broadcast_bytes}
        return cls(*measured(
            E.country_names(country_names, **limit),
            E.port_names(port_names, **limit),
            E.hs_descriptions(hs_descriptions, country, **limit),
            E.unit_factors(units, country, **limit),
            E.company_codes(companies, **limit),
        ))

    def _known(self) -> tuple[Lookup, ...]:
        return measured(*(getattr(self, f.name) for f in fields(self)))

    def kept(self) -> Lookups:
        """The same, large ones as written tables: for runs that read them many times."""
        return Lookups(*(k if k.small else replace(k, rows=stage(k.rows, "lookup")) for k in self._known()))

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` as these lookups need it: as it is, or in parts if one of them is large."""
        return df if all(k.small for k in self._known()) else E.placed(df)

    def empty(self) -> Lookups:
        return Lookups(*(replace(getattr(self, f.name), rows=getattr(self, f.name).rows.limit(0), size=0) for f in fields(self)))


def processed_schema(raw: DataFrame, profile: Profile, lookups: Lookups, keep_source: bool = False) -> T.StructType:
    """The schema that ``process`` gives, without reading the table."""
    return process(raw.limit(0), profile, lookups.empty(), keep_source).schema


def stage_columns(raw: DataFrame, profile: Profile) -> DataFrame:
    return C.conform(raw, profile)


def stage_country(df: DataFrame, lookups: Lookups) -> DataFrame:
    return E.fill_ports(E.map_countries(df, lookups.countries), lookups.ports)


def stage_hs(df: DataFrame, lookups: Lookups, probe: DataFrame | None = None) -> DataFrame:
    """``probe``, here and below: an earlier table with the same keys, read to reduce a large
    lookup to them and to find hot ones."""
    if probe is None or lookups.hs.small:
        return E.enrich_hs(df, lookups.hs)
    (known,) = prepared(probe, [(lookups.hs, {"HS_CODE": F.col("HS_CODE")})])
    return E.enrich_hs(df, known)


def stage_quantity(df: DataFrame, lookups: Lookups) -> DataFrame:
    return E.convert_units(df, lookups.units)


def stage_ta(df: DataFrame, lookups: Lookups, probe: DataFrame | None = None) -> DataFrame:
    return E.assign_ta_codes(df, lookups.companies, probe=probe)


def process(raw: DataFrame, profile: Profile, lookups: Lookups, keep_source: bool = False) -> DataFrame:
    """Raw table to processed table. ``keep_source`` adds ``AS_CAME``, which remediation works from.

    Where a lookup is large the raw table is written once, in parts, as it is read for its keys as well.
    """
    conformed = stage_columns(lookups.placed(raw), profile)
    if keep_source:
        conformed = conformed.withColumn(AS_CAME, F.struct(*map(column, KEPT_FIELDS)))
    mapped = E.map_countries(conformed, lookups.countries)
    arrival, departure, known = _all_prepared(mapped, lookups)
    return E.fill_ports(_looked_up(mapped, known), arrival, departure).drop(PART)


class _Known(NamedTuple):
    """Lookups as prepared for one table."""

    hs: Lookup
    units: Lookup
    exporters: Lookup
    importers: Lookup


def _code_uses(lookups: Lookups) -> list[tuple[Lookup, dict]]:
    match = {"HS_CODE": F.col("HS_CODE")}, {"unit": F.col("QUANTITY_UNIT")}
    parties = [(lookups.companies, side.match(lookups.companies)) for side in (E.EXPORTER, E.IMPORTER)]
    return [(lookups.hs, match[0]), (lookups.units, match[1]), *parties]


def _all_prepared(mapped: DataFrame, lookups: Lookups) -> tuple[Lookup, Lookup, _Known]:
    """The lookups of ports and codes, by one pass over the keys of a table with mapped countries:
    none of them changes a key of another."""
    ports = [(lookups.ports, E.port_match(*names)) for names in E.PORTS]
    arrival, departure, *known = prepared(mapped, [*ports, *_code_uses(lookups)])
    return arrival, departure, _Known(*known)


def _looked_up(df: DataFrame, known: _Known) -> DataFrame:
    df = E.convert_units(E.enrich_hs(df, known.hs), known.units)
    return E.assign_ta_codes(df, known.exporters, known.importers)


def stage_audit(processed: DataFrame, lookups: Lookups, scalars: DataFrame | None = None) -> DataFrame:
    return Q.audit(processed, lookups.ports, lookups.units, scalars=scalars)


def _with_repairs(before: DataFrame, after: DataFrame, tag: str) -> DataFrame:
    """Note which fields of ``after`` differ from those that ``before`` named ``tag``."""
    past = F.col(REPAIRS) if REPAIRS in before.columns else F.array().cast("array<struct<round:int,field:string>>")
    next_round = F.coalesce(F.array_max(F.transform(past, lambda r: r["round"])), F.lit(0)) + 1
    new = F.array_compact(F.array(*(
        F.when(~column(c).eqNullSafe(column(f"{tag}{c}")), F.struct(next_round.alias("round"), F.lit(c).alias("field"))) for c in REPAIRABLE
    )))
    return after.withColumn(REPAIRS, F.concat(past, new)).drop(*(f"{tag}{c}" for c in REPAIRABLE))


def remediate(quarantined: DataFrame, lookups: Lookups, profile: Profile | None = None) -> DataFrame:
    """Repair quarantined rows and validate them again; ``violations`` says what is left.

    Values that did not fit their types are read again, by the parsers of ``profile``. Rows with
    ``AS_CAME`` are looked up by what they came with, so that a round that is repeated gives the
    same and a new code is never looked up as an old one; ``REPAIRS`` then says which
    field each round has changed. Without it, rows with a description are taken to have been
    looked up.
    """
    df = lookups.placed(quarantined.drop("violations"))
    if AS_CAME not in df.columns:
        df = C.blank_to_null(C.retype_columns(df, parsers=profile.parsers if profile else {}), df.columns)
        df = E.crossfill_countries(df)
        # a row with a description has its new code: looked up again it would get that one's
        df = E.enrich_hs(df, lookups.hs, only=F.col("HS_CODE_DESCRIPTION").isNull())
        return Q.with_violations(stage_ta(df, lookups).drop(PART))
    held = df.withColumns({f"_held_{c}": column(c) for c in REPAIRABLE})
    df = held.withColumns({c: F.col(AS_CAME)[c] for c in KEPT_FIELDS})
    df = C.retype_columns(df, parsers=profile.parsers if profile else {})
    # what is read now counts as what came, for the rounds after this one
    df = df.withColumn(AS_CAME, F.struct(*map(column, KEPT_FIELDS)))
    df = E.crossfill_countries(C.blank_to_null(df, [c for c in df.columns if not c.startswith("_held_")]))
    df = _looked_up(df, _Known(*prepared(df, _code_uses(lookups))))
    return Q.with_violations(_with_repairs(quarantined, df, "_held_").drop(PART))


def remediate_folder(
    spark: SparkSession, path: str, schema: T.StructType, lookups: Lookups, out: str, profile: Profile | None = None
) -> None:
    """Read the quarantined rows that ``write_split`` left at ``path``, repair them, and write
    both outcomes to ``out``; there may be none. Rows that are held again can go through the next round from there."""
    whole = T.StructType([*schema.fields, T.StructField("outcome", T.StringType())])
    held = read_table(spark, path, schema=whole).filter("outcome = 'quarantined'").drop("outcome")
    write_split(remediate(held, lookups, profile).drop("violations"), out, mode="overwrite")


def write_split(
    df: DataFrame, path: str, mode: str = "errorifexists", observation: Observation | None = None
) -> None:
    """Write accepted and quarantined rows in one pass, to folders by ``outcome``.

    Quarantined rows keep their ``violations``; accepted rows have none. An ``observation`` gets
    the counts of ``audit_measures`` from the same pass.
    """
    accepted = F.size("violations") == 0
    split = Q.with_violations(df).withColumn(
        "outcome", F.when(accepted, "accepted").otherwise("quarantined")
    )
    if observation is not None:
        split = Q.observed(split, observation, Q.audit_measures())
    write_outcomes(split, path, mode)


def run_table(
    spark: SparkSession,
    table_name: str,
    raw: DataFrame,
    country: str,
    lookups: Lookups,
    out: str,
    ledger_path: str,
    profile: Profile | None = None,
) -> DataFrame:
    """Process one raw table, write it split, audit it, publish both, then mark it processed.

    A run writes a version of its own below ``out`` and publishes it when rows and audit are
    complete (``read_published``); one that fails leaves the last version as it was, and the ledger too,
    so that the table is taken up again. The audit's scalar counts are taken while the rows are
    written. ``profile`` is that of the country and the kind in the name unless given.
    """
    profile = profile or profile_for(country, data_type_of_name(table_name))
    target = f"{out}/{table_name}_islendi"
    version = new_version(target)
    processed = process(raw, profile, lookups, keep_source=True)
    counts = Observation()
    write_split(processed, f"{version}/rows", observation=counts)
    written = read_table(spark, f"{version}/rows", schema=processed.schema)
    scalars = Q.observed_counts(spark, counts, Q.audit_measures())
    write_table(stage_audit(written, lookups, scalars), f"{version}/audit")
    publish(spark, target, version)
    done = spark.range(1).select(F.lit(table_name).alias("table_name"))
    mark_processed(done, ledger_path)
    return read_published(spark, target, part="audit")


class TableRun(NamedTuple):
    """How one table went; ``error`` is None if it was processed."""

    table_name: str
    seconds: float
    error: str | None


def process_unprocessed(
    spark: SparkSession,
    registry: DataFrame,
    open_table: Callable[[str], DataFrame],
    lookups: Mapping[str, Lookups],
    out: str,
    ledger_path: str,
    threads: int = 4,
    owner: str | None = None,
) -> list[TableRun]:
    """Process every raw table of the listing that the ledger does not hold and no other run has claimed.

    ``open_table`` opens a raw table by name; ``lookups`` are those of each country. Up to
    ``threads`` tables are in work at once, each in a pool of Spark's scheduler that has its name, so
    that under fair scheduling a long one does not hold up the others. A table that fails is reported,
    given back, and taken up by the next call; it stops none of the others.
    """
    owner = owner or new_owner()
    left = unprocessed_tables(registry, read_ledger(spark, ledger_path))
    countries = {r["table_name"]: r["country_code"] for r in raw_names(left).orderBy("table_name").collect()}
    mine = claim(spark, ledger_path, list(countries), owner)

    @inheritable_thread_target(spark)
    def run(name: str) -> TableRun:
        start = time.monotonic()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            run_table(spark, name, open_table(name), countries[name], lookups[countries[name]], out, ledger_path)
            return TableRun(name, time.monotonic() - start, None)
        except Exception as error:  # reported, and the others go on
            return TableRun(name, time.monotonic() - start, f"{type(error).__name__}: {error}")
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, threads)) as pool:
        report = list(pool.map(run, mine))
    release(spark, ledger_path, [r.table_name for r in report if r.error is not None], owner)
    return report


def run_unprocessed(
    spark: SparkSession,
    registry: DataFrame,
    open_table: Callable[[str], DataFrame],
    lookups: Mapping[str, Lookups],
    out: str,
    ledger_path: str,
) -> list[str]:
    """As ``process_unprocessed``; returns the names done, or raises when all have ended and some have failed."""
    report = process_unprocessed(spark, registry, open_table, lookups, out, ledger_path)
    if failed := [f"{r.table_name}: {r.error}" for r in report if r.error is not None]:
        raise RuntimeError("\n".join(failed))
    return [r.table_name for r in report]
