"""The registered queries: each operator on tables made out of the given ones."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargoweave.functions.expressions import company_key, data_type_of
from cargoweave.functions.parsing import date_as, number_as
from cargoweave.layout import COMPANY_FIELDS
from cargoweave.operators import conform as C, enrich as E, quality as Q
from cargoweave.operators.lookup import measured
from cargoweave.plans import stages as S
from cargoweave.profiles import AR_IMPORT, CR_EXPORT, CR_IMPORT
from cargoweave.sources import ledger as L, published as P, tables as T
from cargoweave.streaming.incremental import process_arrivals, process_new_files, read_arrivals, read_processed
from checks import stand_ins as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def as_text(df: DataFrame, array_column: str) -> DataFrame:
    return df.withColumn(array_column, F.concat_ws(",", array_column))


# Sources and sinks


@query
def scan_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.shipments(spark, sf_dir)


@query
def roundtrip_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.stage(D.shipments(spark, sf_dir), "shipments")


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = D.shipments(spark, sf_dir), T.new_path(spark, "shipments-csv")
    T.write_csv(rows, path, null_text=r"\N")
    return T.read_csv(spark, path, rows.schema, null_text=r"\N").drop(T.CORRUPT_RECORD)


@query
def discover_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.unprocessed_tables(D.registry(spark, sf_dir), D.ledger(spark, sf_dir))


@query
def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = T.new_path(spark, "ledger")
    L.mark_processed(D.ledger(spark, sf_dir), path)
    new = T.stage(discover_unprocessed(spark, sf_dir), "unprocessed")
    for _ in range(2):  # the second time adds nothing
        L.mark_processed(new, path)
    return L.read_ledger(spark, path)


@query
def raw_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.raw_names(D.registry(spark, sf_dir))


@query
def search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as JSON lines and parsed again."""
    rows, path = T.stage(process_full(spark, sf_dir), "processed"), T.new_path(spark, "search")
    T.write_search_documents(rows, path)
    parsed = F.from_json("value", rows.schema).alias("row")
    return spark.read.text(path).select(parsed).select(*(f"row.{c}" for c in (
        "RECORD_ID", "ARRIVAL_DATE", "HS_CODE", "IMPORTER_NAME", "EXPORTER_NAME", "CIF_VALUE",
        "QUANTITY", "QUANTITY_UNIT", "IMPORT_DATA_TYPE",
    )))


@query
def search_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with action lines, every row twice, and read back: all columns of the documents, with the
    number of different ids that the action lines hold."""
    rows, path = T.stage(process_full(spark, sf_dir), "processed"), T.new_path(spark, "actions")
    T.write_search_actions(rows.unionByName(rows), path, "shipments", batch=5000)
    lines = spark.read.text(path)
    action = F.get_json_object("value", "$.index._id")
    ids = lines.where(F.col("value").startswith('{"index":')).agg(F.countDistinct(action).alias("written_ids"))
    documents = lines.where(~F.col("value").startswith('{"index":')).select(F.from_json("value", rows.schema).alias("row")).select("row.*")
    return documents.join(F.broadcast(ids))


@query
def csv_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of different headings, some rows torn: every row is accepted, or kept as text with its place."""
    rows, path = D.shipments(spark, sf_dir).select("DECLARATION_NUMBER", "ITEM_NO", "ARRIVAL_DATE", "CIF_VALUE", "PRODUCT_DETAILS"), T.new_path(spark, "drift")
    item = F.col("ITEM_NO")
    T.write_csv(rows.where(item <= 3), f"{path}/a")
    T.write_csv(rows.where(item.between(4, 5)).select("CIF_VALUE", F.lit("x").alias("EXTRA"), "ARRIVAL_DATE", "ITEM_NO", "DECLARATION_NUMBER"), f"{path}/b")
    torn = rows.where(item > 5).select(F.concat_ws(",", "DECLARATION_NUMBER", "ITEM_NO", F.lit("no date"), F.lit("torn")).alias("DECLARATION_NUMBER,ITEM_NO,ARRIVAL_DATE,CIF_VALUE"))
    torn.write.option("header", "true").option("quote", "").option("sep", "|").csv(f"{path}/c")
    good, bad = T.accept_csv(T.read_csv_files(spark, f"{path}/*", rows.schema), T.new_path(spark, "csv-split"))
    folder = F.element_at(F.split("source_file", "/"), -2)
    return good.select(*rows.columns, F.lit(None).cast("string").alias("record"), folder.alias("folder")).unionByName(bad.select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema), F.col(T.CORRUPT_RECORD).alias("record"), folder.alias("folder")
    ))


# Schema operators


@query
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rename_columns(D.raw_cr_import(spark, sf_dir), CR_IMPORT.renames)


@query
def add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.add_columns(rename_columns(spark, sf_dir), CR_IMPORT.adds)


@query
def record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_columns(spark, sf_dir).select("DECLARATION_NUMBER", "ITEM_NO", "RECORD_ID")


@query
def add_typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.add_typed_columns(D.shipments(spark, sf_dir))


@query
def reorder_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.reorder_columns(D.shipments(spark, sf_dir))


@query
def finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.finalize(D.shipments(spark, sf_dir))


@query
def p7_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.p7_projection(process_full(spark, sf_dir))


@query
def p7_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(C.p7_rejects(process_full(spark, sf_dir)), "MISSING_FIELDS")


@query
def data_type_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.registry(spark, sf_dir).withColumn("data_type", data_type_of(F.col("table_name")))


@query
def conform_cr_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.conform(D.raw_cr_import(spark, sf_dir), CR_IMPORT)


@query
def conform_cr_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.conform(D.raw_cr_export(spark, sf_dir), CR_EXPORT)


@query
def conform_ar_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some typed fields come as text here, without values; a value that does not fit would lose its row."""
    conformed = C.conform(D.raw_ar_import(spark, sf_dir), AR_IMPORT)
    return conformed.filter(F.size(C.FAILED_CASTS) == 0).drop(C.FAILED_CASTS)


@query
def company_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = E.assign_ta_code(
        country_all(spark, sf_dir), E.IMPORTER, companies(spark, sf_dir)
    )
    return C.company_file(coded, {
        "TA_CODE": "IMPORTER_TA_CODE",
        "COMPANY_TAX_ID": "IMPORTER_TAX_ID",
        "COMPANY_NAME": "IMPORTER_NAME",
    })


@query
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.blank_to_null(D.shipments(spark, sf_dir), ["HS_CODE", "QUANTITY", "IMPORTER_NAME"])


# Enrichment


@query
def hs_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = E.hs_descriptions(D.hs_desc(spark, sf_dir), "CR")
    return E.enrich_hs(D.shipments(spark, sf_dir), lookup)


@query
def country_code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = E.country_names(D.country_map(spark, sf_dir))
    return E.map_country(D.shipments(spark, sf_dir), "EXPORTER_COUNTRY", names)


@query
def country_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = E.country_names(D.country_map(spark, sf_dir))
    return E.map_countries(D.shipments(spark, sf_dir), names)


@query
def country_crossfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.crossfill_countries(D.shipments(spark, sf_dir))


@query
def port_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    ports = E.port_names(D.country_uniq(spark, sf_dir))
    return E.fill_port(country_all(spark, sf_dir), "IMPORTER_COUNTRY", "PORT_OF_ARRIVAL", ports)


@query
def port_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.fill_ports(country_all(spark, sf_dir), E.port_names(D.country_uniq(spark, sf_dir)))


@query
def company_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.shipments(spark, sf_dir).select(
        "DECLARATION_NUMBER", "ITEM_NO", "IMPORTER_NAME",
        company_key(F.col("IMPORTER_NAME")).alias("importer_key"),
        company_key(F.col("EXPORTER_NAME")).alias("exporter_key"),
    )


QUERIES["company_key"] = QUERIES.pop("company_key_query")


def companies(spark: SparkSession, sf_dir: str) -> E.Lookup:
    return E.company_codes(D.company(spark, sf_dir))


@query
def ta_code_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.assign_ta_code(country_all(spark, sf_dir), E.EXPORTER, companies(spark, sf_dir))


@query
def ta_code_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = country_all(spark, sf_dir)
    present = E.present_countries(coded, "EXPORTER_COUNTRY")
    lookup = E.company_codes(D.company(spark, sf_dir), "any", present)
    return E.assign_ta_code(coded, E.EXPORTER, lookup)


@query
def ta_code_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.assign_ta_codes(country_all(spark, sf_dir), companies(spark, sf_dir))


@query
def present_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.present_countries(country_all(spark, sf_dir), "EXPORTER_COUNTRY")


@query
def unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.convert_units(D.shipments(spark, sf_dir), E.unit_factors(D.unit_map(spark), "CR"))


@query
def hs_enrich_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As hs_enrich, by the plan of a lookup too large to broadcast; so the next ones."""
    lookup = E.hs_descriptions(D.hs_desc(spark, sf_dir), "CR", broadcast_bytes=0)
    return E.enrich_hs(D.shipments(spark, sf_dir), lookup)


@query
def ta_code_both_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = E.company_codes(D.company(spark, sf_dir), broadcast_bytes=0)
    return E.assign_ta_codes(country_all(spark, sf_dir), lookup)


@query
def ta_code_any_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = country_all(spark, sf_dir)
    present = E.present_countries(coded, "EXPORTER_COUNTRY")
    lookup = E.company_codes(D.company(spark, sf_dir), "any", present, broadcast_bytes=0)
    return E.assign_ta_code(coded, E.EXPORTER, lookup)


@query
def ta_code_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One importer has a third of the rows; the company list is too large to broadcast until it
    is reduced to the companies that occur."""
    (whole,) = measured(E.company_codes(D.many_companies(spark, sf_dir)))
    rows = D.hot_importer(country_all(spark, sf_dir))
    return E.assign_ta_codes(rows, replace(whole, broadcast_bytes=whole.size // 2))


@query
def ta_code_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax id first, then name; they disagree for the neighbours of every fifth customer."""
    coded = S.stage_country(stage_columns(spark, sf_dir), D.lookups(spark, sf_dir))
    return E.assign_ta_codes_by_rank(coded, D.company_with_tax_ids(spark, sf_dir), matched_by=True)


@query
def ta_code_by_rank_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = S.stage_country(stage_columns(spark, sf_dir), D.lookups(spark, sf_dir))
    return E.assign_ta_codes_by_rank(coded, D.company_with_tax_ids(spark, sf_dir), matched_by=True, broadcast_bytes=0)


# Quality


@query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.null_counts(D.shipments(spark, sf_dir))


@query
def hs_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.hs_integrity(D.shipments(spark, sf_dir))


@query
def ta_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.ta_format(D.shipments(spark, sf_dir))


@query
def quantity_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.quantity_nulls(D.shipments(spark, sf_dir))


@query
def unknown_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    ports = E.port_names(D.country_uniq(spark, sf_dir))
    return Q.unknown_countries(country_all(spark, sf_dir), "COUNTRY_OF_ORIGIN", ports)


@query
def unknown_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.unknown_units(D.shipments(spark, sf_dir), E.unit_factors(D.unit_map(spark), "CR"))


@query
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookups = D.lookups(spark, sf_dir)
    processed = S.process(D.raw_cr_import(spark, sf_dir), CR_IMPORT, lookups)
    return S.stage_audit(T.stage(processed, "processed"), lookups)


@query
def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table from raw to ledger; the result is the audit it wrote."""
    out, ledger = T.new_path(spark, "run"), T.new_path(spark, "run-ledger")
    return S.run_table(
        spark, "yeni_veri_cr_2024_01_imp", D.raw_cr_import(spark, sf_dir), "CR",
        D.lookups(spark, sf_dir), out, ledger,
    )


@query
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = as_text(Q.with_violations(process_full(spark, sf_dir)), "violations")
    return checked.select("RECORD_ID", "DECLARATION_NUMBER", "ITEM_NO", "violations")


@query
def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.rule_summary(process_full(spark, sf_dir))


@query
def rules_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that only texts can break: days that do not exist, numbers out of range or in other forms."""
    item, rows = F.col("ITEM_NO"), D.shipments(spark, sf_dir)
    date = F.when(item == 2, "2020-02-30").when(item == 3, "31/12/2020").otherwise(F.col("ARRIVAL_DATE").cast("string"))
    kind = F.when(item == 4, "70000").when(item == 5, "4.5").otherwise("4")
    quantity = F.when(item == 6, "12,5").otherwise(F.col("QUANTITY").cast("string"))
    checked = Q.with_violations(C.finalize(rows.withColumns({"ARRIVAL_DATE": date, "EXPORT_DATA_TYPE": kind, "QUANTITY": quantity})))
    only = F.filter("violations", lambda v: v.rlike(":(date|short|float)$"))
    return checked.select("DECLARATION_NUMBER", "ITEM_NO", F.concat_ws(",", only).alias("violations"))


@query
def company_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company file under the rules of its own layout."""
    return as_text(Q.with_violations(company_file(spark, sf_dir), fields=COMPANY_FIELDS), "violations")


@query
def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.accepted_rows(process_full(spark, sf_dir))


@query
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(Q.quarantined_rows(process_full(spark, sf_dir)), "violations")


@query
def remediated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookups = D.lookups(spark, sf_dir)
    processed = S.process(D.raw_cr_import(spark, sf_dir), CR_IMPORT, lookups)
    return as_text(S.remediate(Q.quarantined_rows(processed), lookups), "violations")


@query
def split_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and quarantined rows, written in one pass and read back."""
    path = T.new_path(spark, "split")
    S.write_split(process_full(spark, sf_dir), path)
    return as_text(T.read_table(spark, path), "violations")


# Stages


@query
def stage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stage_columns(D.raw_cr_import(spark, sf_dir), CR_IMPORT)


@query
def stage_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stage_country(stage_columns(spark, sf_dir), D.lookups(spark, sf_dir))


@query
def stage_hs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stage_hs(stage_columns(spark, sf_dir), D.lookups(spark, sf_dir))


@query
def stage_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stage_quantity(stage_columns(spark, sf_dir), D.lookups(spark, sf_dir))


@query
def stage_ta(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookups = D.lookups(spark, sf_dir)
    return S.stage_ta(S.stage_country(stage_columns(spark, sf_dir), lookups), lookups)


@query
def process_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.process(D.raw_cr_import(spark, sf_dir), CR_IMPORT, D.lookups(spark, sf_dir))


@query
def process_ar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Argentina from raw table to processed table; days that do not exist leave no date."""
    processed = S.process(D.raw_ar_import(spark, sf_dir), AR_IMPORT, D.lookups(spark, sf_dir, "AR"))
    return processed.select(
        "RECORD_ID", "DECLARATION_NUMBER", "ARRIVAL_DATE", "HS_CODE", "HS_CODE_DESCRIPTION", "QUANTITY", "QUANTITY_UNIT",
        "COUNTRY_OF_ORIGIN", "EXPORTER_COUNTRY", "IMPORTER_COUNTRY", "PORT_OF_ARRIVAL", "PORT_OF_DEPARTURE",
        "IMPORTER_TA_CODE", "EXPORTER_TA_CODE", "FOB_VALUE", "FOB_CURRENCY", "GROSS_WEIGHT", "DATA_TYPE",
    )


@query
def process_full_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No lookup may be broadcast."""
    return S.process(D.raw_cr_import(spark, sf_dir), CR_IMPORT, D.lookups(spark, sf_dir, broadcast_bytes=0))


def _outcome_of_text(df: DataFrame) -> DataFrame:
    failed = F.array_sort(F.transform(F.map_entries(C.FAILED_CASTS), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return as_text(df.withColumn("failed", F.concat_ws(";", failed)), "violations").select(
        "DECLARATION_NUMBER", "ITEM_NO", "ARRIVAL_DATE", "CIF_VALUE", "QUANTITY", "QUANTITY_UNIT", "HS_CODE",
        "HS_CODE_DESCRIPTION", "failed", "violations",
    )


@query
def text_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table of texts, with values that are no number or date, and some that are missing."""
    processed = S.process(D.raw_as_text(spark, sf_dir), CR_IMPORT, D.lookups(spark, sf_dir))
    return _outcome_of_text(Q.with_violations(processed))


#: How a country writes dates and numbers that the plain profile does not take.
LOCAL = CR_IMPORT._replace(parsers={
    "date": (date_as("yyyy-MM-dd"), date_as("dd/MM/yyyy")),
    "float": (number_as("."), number_as(",")),
})


@query
def text_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table under a profile that names its formats, with the parsers that read odd values."""
    processed = S.process(D.raw_as_text(spark, sf_dir), LOCAL, D.lookups(spark, sf_dir))
    by = F.array_sort(F.transform(F.map_entries(C.PARSED_BY), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    failed = F.array_sort(F.map_keys(C.FAILED_CASTS))
    return processed.select(
        "DECLARATION_NUMBER", "ITEM_NO", "ARRIVAL_DATE", "CIF_VALUE", "QUANTITY",
        F.concat_ws(";", by).alias("parsed_by"), F.concat_ws(";", failed).alias("failed"),
    )


@query
def text_remediated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that text_process holds back, written and repaired under the wider profile."""
    lookups, path, out = D.lookups(spark, sf_dir), T.new_path(spark, "split"), T.new_path(spark, "repaired")
    processed = S.process(D.raw_as_text(spark, sf_dir), CR_IMPORT, lookups, keep_source=True)
    S.write_split(processed, path)
    S.remediate_folder(spark, path, processed.schema, lookups, out, LOCAL)
    return _outcome_of_text(T.read_table(spark, out))


@query
def remediation_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds over held rows with chained tariff codes: accepted rows of all rounds, and what is
    held after the last, are the whole table; the second round changes nothing."""
    lookups = replace(D.lookups(spark, sf_dir), hs=E.hs_descriptions(D.hs_chain(spark, sf_dir), "CR")).kept()
    paths = [T.new_path(spark, name) for name in ("split", "round-1", "round-2")]
    processed = S.process(D.raw_cr_import(spark, sf_dir), CR_IMPORT, lookups, keep_source=True)
    S.write_split(processed, paths[0])
    schema = processed.schema
    for source, out in zip(paths, paths[1:]):
        S.remediate_folder(spark, source, schema, lookups, out)
        schema = T.read_table(spark, out).drop("violations", "outcome").schema
    accepted = [T.read_table(spark, path).filter("outcome = 'accepted'") for path in paths[:2]]
    parts = [*accepted, T.read_table(spark, paths[2])]
    repairs = F.col(S.REPAIRS) if S.REPAIRS in parts[1].columns else F.lit(None)
    rounds = F.coalesce(F.array_max(F.transform(repairs, lambda r: r["round"])), F.lit(0))
    return as_text(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), "violations").select(
        "RECORD_ID", "DECLARATION_NUMBER", "ITEM_NO", "HS_CODE", "HS_CODE_DESCRIPTION", "COUNTRY_OF_ORIGIN",
        "EXPORTER_TA_CODE", "QUANTITY", "QUANTITY_UNIT", "violations", "outcome", rounds.alias("rounds"),
    )


@query
def run_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tables from an empty ledger, one of them broken: what was published of each."""
    raw, out, ledger = T.stage(D.raw_cr_import(spark, sf_dir), "raw"), T.new_path(spark, "runs"), T.new_path(spark, "runs-ledger")
    names = [f"yeni_veri_cr_2024_{month:02}_imp" for month in range(1, 6)]
    listing = spark.createDataFrame([(n,) for n in names], "table_name string")

    def open_table(name: str) -> DataFrame:
        if name == names[4]:
            raise ValueError("this table cannot be opened")
        return raw.filter(F.col("ITEM") % 4 == names.index(name))

    report = S.process_unprocessed(spark, listing, open_table, {"CR": D.lookups(spark, sf_dir).kept()}, out, ledger)
    done = {r.table_name for r in report if r.error is None}
    written = [
        P.read_published(spark, f"{out}/{name}_islendi").select(F.lit(name).alias("table_name"), "outcome") for name in sorted(done)
    ]
    counts = reduce(DataFrame.unionByName, written).groupBy("table_name").agg(
        F.count_if(F.col("outcome") == "accepted").alias("accepted"), F.count_if(F.col("outcome") == "quarantined").alias("quarantined")
    )
    marked = L.read_ledger(spark, ledger).select("table_name", F.lit(True).alias("marked"))
    return listing.join(counts, "table_name", "left").join(marked, "table_name", "left").select(
        "table_name", F.coalesce("accepted", F.lit(0)).alias("accepted"), F.coalesce("quarantined", F.lit(0)).alias("quarantined"),
        F.coalesce("marked", F.lit(False)).alias("marked"),
    )


@query
def text_intake_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as text, with quantities that are no numbers on every third item."""
    raw = D.raw_cr_import(spark, sf_dir)
    source = {new: old for old, new in CR_IMPORT.renames.items()}
    text = raw.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns))
    third = F.col(f"`{source['ITEM_NO']}`").cast("double") == 3
    quantity = F.when(third, "12,5").otherwise(F.col(f"`{source['QUANTITY']}`"))
    processed = S.process(text.withColumn(source["QUANTITY"], quantity), CR_IMPORT, D.lookups(spark, sf_dir))
    return Q.rule_summary(processed).filter("check_name = 'float'")


@query
def incremental_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows land in files, half of them before a first run, half before a second."""
    raw = T.stage(D.raw_cr_import(spark, sf_dir), "raw")
    lookups = D.lookups(spark, sf_dir).kept()
    landing, out, checkpoint = (
        T.new_path(spark, name) for name in ("landing", "incremental", "incremental-state")
    )
    early = F.coalesce(F.col("DATE") < "1998-07-01", F.lit(True))
    for part in (raw.filter(early), raw.filter(~early)):
        T.write_table(part, landing, mode="append")
        process_new_files(
            spark, landing, raw.schema, lambda batch: S.process(batch, CR_IMPORT, lookups),
            out, checkpoint, max_files_per_batch=8,
        )
    return read_processed(spark, out, S.processed_schema(raw, CR_IMPORT, lookups))


@query
def incremental_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals, the last one a file that came before: split rows of all micro-batches."""
    raw, lookups = T.stage(D.raw_cr_import(spark, sf_dir), "raw"), D.lookups(spark, sf_dir)
    landing, out = T.new_path(spark, "landing"), T.new_path(spark, "arrivals")
    early = F.coalesce(F.col("DATE") < "1995-07-01", F.lit(True))
    for part in (raw.filter(early), raw.filter(~early), raw.filter(early)):
        T.write_table(part, landing, mode="append")
        process_arrivals(spark, landing, raw.schema, CR_IMPORT, lookups, out, max_files_per_batch=8)
    schema = S.processed_schema(raw, CR_IMPORT, lookups, keep_source=True)
    return as_text(read_arrivals(spark, out, schema).drop(S.AS_CAME), "violations")
