"""Audit measures and row validation.

All counts of an audit come from one aggregate over the table, in long form:
``check_name, column_name, n``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cargoweave.functions.expressions import column, is_hs_code, is_ta_code
from cargoweave.layout import AUDITED_COLUMNS, SHIPMENT_FIELDS, Field, country_codes
from cargoweave.operators.conform import FAILED_CASTS, TYPE_RULES
from cargoweave.operators.lookup import Lookup, measured

TA_COLUMNS = ("IMPORTER_TA_CODE", "EXPORTER_TA_CODE")


class Measure(NamedTuple):
    check_name: str
    column_name: str
    condition: Column


def null_measures(columns: Sequence[str] = AUDITED_COLUMNS) -> list[Measure]:
    return [Measure("null", c, column(c).isNull()) for c in columns]


def hs_measures() -> list[Measure]:
    code, text = F.col("HS_CODE"), F.col("HS_CODE_DESCRIPTION")
    return [
        Measure("null_hs_code", "HS_CODE", code.isNull()),
        Measure("null_hs_code_description", "HS_CODE_DESCRIPTION", text.isNull()),
        Measure("invalid_hs_code_format", "HS_CODE", code.isNotNull() & ~is_hs_code(code)),
    ]


def ta_measures(columns: Sequence[str] = TA_COLUMNS) -> list[Measure]:
    return [Measure("invalid_ta_code", c, ~is_ta_code(column(c))) for c in columns]


def quantity_measures() -> list[Measure]:
    return [
        Measure("null_quantity", "QUANTITY", F.col("QUANTITY").isNull()),
        Measure("null_quantity_unit", "QUANTITY_UNIT", F.col("QUANTITY_UNIT").isNull()),
    ]


def count_measures(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Rows that meet each measure's condition, all counted in one pass."""
    counts = df.agg(*(F.count_if(m.condition).alias(f"m{i}") for i, m in enumerate(measures)))
    return counts.select(F.inline(F.array(*(
        F.struct(
            F.lit(m.check_name).alias("check_name"),
            F.lit(m.column_name).alias("column_name"),
            F.col(f"m{i}").alias("n"),
        )
        for i, m in enumerate(measures)
    ))))


def null_counts(df: DataFrame, columns: Sequence[str] = AUDITED_COLUMNS) -> DataFrame:
    return count_measures(df, null_measures(columns))


def hs_integrity(df: DataFrame) -> DataFrame:
    return count_measures(df, hs_measures())


def ta_format(
    df: DataFrame, columns: Sequence[str] = TA_COLUMNS, keep_zero: bool = False
) -> DataFrame:
    counts = count_measures(df, ta_measures(columns))
    return counts if keep_zero else counts.filter("n > 0")


def quantity_nulls(df: DataFrame) -> DataFrame:
    return count_measures(df, quantity_measures())


def unknown_values(df: DataFrame, value_column: str, known: Lookup) -> DataFrame:
    """Values a lookup does not know, NULL included, with the number of rows of each.

    Values are counted before the join, so a frequent one is one row by then.
    """
    (key,) = known.keys
    counts = df.groupBy(column(value_column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    keys = known.key_table()
    return counts.join(keys, counts["value"] == keys[key], "left_anti")


def unknown_countries(df: DataFrame, country_column: str, ports: Lookup) -> DataFrame:
    return unknown_values(df, country_column, ports).select(F.col("value").alias(country_column))


def unknown_units(df: DataFrame, units: Lookup, unit_column: str = "QUANTITY_UNIT") -> DataFrame:
    return unknown_values(df, unit_column, units).select(F.col("value").alias(unit_column))


def unknown_value_counts(df: DataFrame, known: Mapping[str, tuple[str, Lookup]]) -> DataFrame:
    """check_name, column_name, value, n: the unknown values of several columns, in one scan.

    ``known`` gives the column and the lookup of each check. Every row is counted once for each
    check before its shuffle, and only the distinct values meet the lookups.
    """
    def tagged(check: str, name: str, value: Column) -> Column:
        return F.struct(F.lit(check).alias("check_name"), F.lit(name).alias("column_name"), value.cast("string").alias("value"))

    each = F.array(*(tagged(check, name, column(name)) for check, (name, _) in known.items()))
    counts = df.select(F.explode(each).alias("v")).groupBy("v.check_name", "v.column_name", "v.value").agg(F.count(F.lit(1)).alias("n"))
    for check, (_, lookup) in known.items():
        (key,) = lookup.keys
        keys = lookup.key_table().select(F.lit(check).alias("known_check"), column(key).cast("string").alias("known_value"))
        if lookup.small:
            keys = F.broadcast(keys)
        counts = counts.join(keys, (F.col("check_name") == F.col("known_check")) & (F.col("value") == F.col("known_value")), "left_anti")
    return counts


def audit_measures() -> list[Measure]:
    """The scalar checks of an audit."""
    return null_measures() + hs_measures() + ta_measures() + quantity_measures()


def observed(df: DataFrame, observation: Observation, measures: Sequence[Measure]) -> DataFrame:
    """``df`` whose next action also counts the rows of each measure, at no other pass.

    Put it right before a write: there each task's rows are counted when the task is done, and
    once, also if tasks are tried again or an earlier stage is.
    """
    return df.observe(observation, *(F.count_if(m.condition).alias(f"m{i}") for i, m in enumerate(measures)))


def observed_counts(spark: SparkSession, observation: Observation, measures: Sequence[Measure]) -> DataFrame:
    """What ``observed`` has counted, in the form of :func:`count_measures`; a row for each measure."""
    n = observation.get
    rows = [(m.check_name, m.column_name, n[f"m{i}"] or 0) for i, m in enumerate(measures)]
    return spark.createDataFrame(rows, "check_name string, column_name string, n bigint")


def audit(
    df: DataFrame,
    ports: Lookup,
    units: Lookup,
    country_column: str = "COUNTRY_OF_ORIGIN",
    unit_column: str = "QUANTITY_UNIT",
    scalars: DataFrame | None = None,
) -> DataFrame:
    """All checks of a processed table: ``check_name, column_name, value, n``.

    ``scalars`` are the counts of ``audit_measures``, where they were taken while the table was
    written. Reads the table once for the unknown values, and once for the scalars unless they
    are given; give it a written table, not the plan that makes one.
    """
    if scalars is None:
        scalars = count_measures(df, audit_measures())
    ports, units = measured(ports, units)
    unknown = unknown_value_counts(df, {"unknown_country": (country_column, ports), "unknown_unit": (unit_column, units)})
    return (
        scalars.filter("check_name <> 'invalid_ta_code' or n > 0")
        .select("check_name", "column_name", F.lit(None).cast("string").alias("value"), "n")
        .unionByName(unknown)
    )


def rule_measures(
    fields: Sequence[Field] = SHIPMENT_FIELDS, codes: Sequence[str] | None = None
) -> list[Measure]:
    """Rules a row can break. A NULL breaks ``exist`` only; ``text`` is never broken."""
    listed = country_codes() if codes is None else list(codes)

    def broken(rule: str, value: Column) -> Column | None:
        match rule:
            case "exist":
                return value.isNull()
            case "float":
                return value.isNotNull() & value.try_cast("double").isNull()
            case "date":
                return value.isNotNull() & value.try_cast("date").isNull()
            case "short":
                return value.isNotNull() & value.try_cast("smallint").isNull()
            case "integer":
                return value.isNotNull() & value.try_cast("int").isNull()
            case "ta_code":
                return value.isNotNull() & ~is_ta_code(value)
            case "hs_code":
                return value.isNotNull() & ~is_hs_code(value)
            case "country":
                return value.isNotNull() & ~value.isin(listed)
            case "text":
                return None
        raise ValueError(f"unknown rule {rule!r}")

    checks = ((rule, f.name, broken(rule, column(f.name))) for f in fields for rule in f.rules)
    return [Measure(rule, name, test) for rule, name, test in checks if test is not None]


def typed_by(fields: Sequence[Field]) -> list[tuple[str, str]]:
    """The fields that have a type, each with the rule that gives it."""
    rules = ((f.name, next((r for r in TYPE_RULES if r in f.rules), None)) for f in fields)
    return [(name, rule) for name, rule in rules if rule]


def with_violations(
    df: DataFrame,
    fields: Sequence[Field] = SHIPMENT_FIELDS,
    codes: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``violations``: the broken rules of each row as ``COLUMN:rule``, in layout order.

    Values that did not fit their type when the table was typed break the rule of that type.
    """
    broken = F.array_compact(F.array(*(
        F.when(m.condition, F.lit(f"{m.column_name}:{m.check_name}"))
        for m in rule_measures(fields, codes)
    )))
    if FAILED_CASTS in df.columns:
        unfit = F.array_compact(F.array(*(
            F.when(F.map_contains_key(FAILED_CASTS, name), F.lit(f"{name}:{rule}")) for name, rule in typed_by(fields)
        )))
        broken = F.array_union(broken, unfit)
    return df.withColumn("violations", broken)


def accepted_rows(df: DataFrame, **options) -> DataFrame:
    """Rows that break no rule; what did not fit its type is in none of them."""
    return with_violations(df, **options).filter(F.size("violations") == 0).drop("violations", FAILED_CASTS)


def quarantined_rows(df: DataFrame, **options) -> DataFrame:
    return with_violations(df, **options).filter(F.size("violations") > 0)


def rule_summary(df: DataFrame, **options) -> DataFrame:
    """Rows per broken rule and column: ``check_name, column_name, n``, without the zeros; all in one
    pass. Values that did not fit their type have a row of their own."""
    measures = rule_measures(**options)
    if FAILED_CASTS in df.columns:
        measures += [
            Measure(rule, name, F.map_contains_key(FAILED_CASTS, name)) for name, rule in typed_by(options.get("fields", SHIPMENT_FIELDS))
        ]
    return count_measures(df, measures).filter("n > 0")
