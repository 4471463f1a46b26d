"""Shipment tables and lookups made out of the given tables, for queries and tests."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargoweave.operators.enrich import union_by_country
from cargoweave.plans.stages import Lookups
from cargoweave.profiles import AR_IMPORT_COLUMNS, CR_EXPORT, CR_IMPORT
from cargoweave.sources.tables import deal_out, read_table

# The codes that stand for the nations 0 to 24.
NATIONS = (
    "AD", "AE", "AF", "AG", "AI", "AL", "AM", "AO", "AQ", "AR", "AS", "AT", "AU", "AW", "AX", "AZ",
    "BA", "BB", "BD", "BE", "BF", "BG", "BH", "BI", "BJ",
)
NATION_CODES = "".join(NATIONS)


@lru_cache(maxsize=64)
def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def nation_code(key: Column) -> Column:
    return F.substr(F.lit(NATION_CODES), F.lit(1) + F.lit(2) * key, F.lit(2))


def numbered(key: Column) -> Column:
    return F.lpad(key.cast("string"), 8, "0")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their customer, part, supplier and both nations."""
    nation = base(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    seller = nation.toDF("sn_key", "sn_name")
    buyer = nation.toDF("cn_key", "cn_name")
    # orders meet their customers before the lines do, so that many lines are not shuffled by customer
    bought = base(spark, sf_dir, "orders").join(base(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    return (
        deal_out(base(spark, sf_dir, "lineitem"), "l_orderkey")
        .join(bought, F.expr("l_orderkey = o_orderkey"))
        .join(base(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .join(base(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(F.broadcast(seller), F.expr("s_nationkey = sn_key"))
        .join(F.broadcast(buyer), F.expr("c_nationkey = cn_key"))
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipment rows before enrichment, with gaps, bad codes and unevenly spelt names."""
    return lines(spark, sf_dir).selectExpr(
        "cast(l_shipdate as date) as ARRIVAL_DATE",
        "cast(l_orderkey as string) as DECLARATION_NUMBER",
        "cast(l_linenumber as double) as ITEM_NO",
        "cast(o_custkey as string) as IMPORTER_TAX_ID",
        "case when l_linenumber = 3 then replace(upper(c_name), '#', ' & ')"
        " when l_linenumber = 4 then '- . -' else upper(c_name) end as IMPORTER_NAME",
        "case when l_linenumber = 5 then replace(upper(s_name), '#', ', <+> ')"
        " else upper(s_name) end as EXPORTER_NAME",
        "case when l_partkey % 17 = 0 then null when l_partkey % 19 = 0 then 'HS-x'"
        " when l_partkey % 23 = 0 then '' else lpad(cast(l_partkey as string), 8, '0')"
        " end as HS_CODE",
        "case when l_partkey % 3 = 0 then p_name end as HS_CODE_DESCRIPTION",
        "p_name as PRODUCT_DETAILS",
        "case when l_suppkey % 7 <> 0 then sn_name end as COUNTRY_OF_ORIGIN",
        "case when l_suppkey % 5 <> 0 then sn_name end as EXPORTER_COUNTRY",
        "cn_name as IMPORTER_COUNTRY",
        "case when l_orderkey % 13 <> 0 then l_quantity end as QUANTITY",
        "case when l_orderkey % 11 <> 0 then p_type end as QUANTITY_UNIT",
        "l_extendedprice as CIF_VALUE",
        "cast(p_size * l_quantity as double) as NET_WEIGHT",
        "case when l_linenumber = 1 then 'PORT' end as PORT_OF_ARRIVAL",
        "case when l_linenumber = 2 then 'QUAY' end as PORT_OF_DEPARTURE",
        "case when l_linenumber = 6 then 'ZZ00000001' when l_linenumber = 7 then 'bad' end"
        " as IMPORTER_TA_CODE",
        "case when l_linenumber = 6 then 'ZZ00000002' end as EXPORTER_TA_CODE",
    )


def _raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw Costa Rica table under its target names, exporter name included."""
    return shipments(spark, sf_dir).select(
        "ARRIVAL_DATE", "DECLARATION_NUMBER", "ITEM_NO", "IMPORTER_TAX_ID", "IMPORTER_NAME",
        "HS_CODE", "PRODUCT_DETAILS", "COUNTRY_OF_ORIGIN",
        F.col("COUNTRY_OF_ORIGIN").alias("yedek_EXPORTER_COUNTRY"), "EXPORTER_COUNTRY",
        "QUANTITY", "QUANTITY_UNIT", "CIF_VALUE", "NET_WEIGHT",
        (F.col("NET_WEIGHT") * 2).alias("GROSS_WEIGHT"), "PORT_OF_ARRIVAL", "EXPORTER_NAME",
    )


def raw_cr_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_values(spark, sf_dir).toDF(*CR_IMPORT.renames, "EXPORTER_NAME")


def raw_cr_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export table; it lacks the date, which the profile then adds."""
    return _raw_values(spark, sf_dir).toDF(*CR_EXPORT.renames, "EXPORTER_NAME").drop("DATE")


def raw_ar_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Argentina table; day 31 is forced on some rows, so impossible dates occur."""
    values = {
        "DAY": "case when l_linenumber = 7 then 31 else day(l_shipdate) end",
        "MONTH": "month(l_shipdate)",
        "YEAR": "year(l_shipdate)",
        "IMPORT_ID": "cast(l_orderkey as string)",
        "OPER_TYPE": "l_returnflag",
        "CUSTOMS": "case when l_linenumber = 1 then 'PORT' end",
        "IMPORTER_ID": "cast(o_custkey as string)",
        "IMPORTER": "upper(c_name)",
        "SALES_COUNTRY": "sn_name",
        "TRANS_TYPE": "l_linestatus",
        "PACKAGES": "cast(p_size as double)",
        "G_WEIGHT": "cast(p_size * l_quantity as double)",
        "ORIGIN_COUNTRY": "case when l_suppkey % 7 <> 0 then sn_name end",
        "QUANTITY": "l_quantity",
        "UNIT_OF_QUANTITY": "p_type",
        "ITEM_FOB": "l_extendedprice",
        "HS_CODE": "lpad(cast(l_partkey as string), 8, '0')",
        "PRODUCT_DESC": "p_name",
        "BRAND": "p_brand",
    }
    return lines(spark, sf_dir).selectExpr(
        *(f"{values.get(c, 'cast(null as string)')} as {c}" for c in AR_IMPORT_COLUMNS)
    )


def country_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = base(spark, sf_dir, "nation").filter("n_nationkey < 20")
    return nation.select(
        F.col("n_name").alias("country2"), nation_code(F.col("n_nationkey")).alias("code")
    )


def country_uniq(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = base(spark, sf_dir, "nation").filter("n_nationkey < 15")
    region = base(spark, sf_dir, "region")
    named = nation.join(region, F.expr("n_regionkey = r_regionkey")).select(
        nation_code(F.col("n_nationkey")).alias("alpha2"),
        F.concat("r_name", F.lit(" "), "n_name").alias("short_name"),
    )
    home = nation.filter("n_nationkey = 0").select(
        F.lit("CR").alias("alpha2"), F.lit("COSTA RICA").alias("short_name")
    )
    return named.unionByName(home)


def hs_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = base(spark, sf_dir, "part")

    def described(text: str) -> DataFrame:
        return part.select(
            numbered(F.col("p_partkey")).alias("HS_CODE"),
            F.expr(text).alias("HS_CODE_DESC"),
            F.when(F.col("p_size") < 10, numbered(F.col("p_partkey") + 1000000)).alias("new_HS_CODE"),
            "p_partkey",
        )

    return union_by_country({
        "CR": described("concat(p_type, ' ', p_name)").filter("p_partkey % 4 <> 0"),
        "AR": described("concat(p_brand, ' ', p_name)").filter("p_partkey % 4 <> 1"),
    }).drop("p_partkey")


def unit_map(spark: SparkSession) -> DataFrame:
    columns = ("unit", "new_unit", "factor")
    return union_by_country({
        "CR": spark.sql(
            "values ('ECONOMY', 'Kilogram', 1000.0D), ('LARGE', 'Tonne', 0.001D),"
            " ('MEDIUM', 'Pieces', null), ('PROMO', 'Pieces', 12.0D)"
        ).toDF(*columns),
        "AR": spark.sql(
            "values ('ECONOMY', 'Gram', 1000000.0D), ('SMALL', 'Dozen', 0.5D)"
        ).toDF(*columns),
    })


def company_with_tax_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers at home and next door, customers at home and in Costa Rica. Customers have a tax
    id, every fifth that of the next one."""

    def listed(table: DataFrame, prefix: str, country: Column) -> DataFrame:
        key = {"s": "s_suppkey", "c": "c_custkey"}[prefix]
        tax_id = F.concat(F.lit("# "), F.when(F.col(key) % 5 == 0, F.col(key) + 1).otherwise(F.col(key)).cast("string"))
        return table.select(
            country.alias("country"),
            F.upper(f"{prefix}_name").alias("COMPANY_ham"),
            F.concat(country, numbered(F.col(key))).alias("TA_CODE"),
            (tax_id if prefix == "c" else F.lit(None).cast("string")).alias("COMPANY_TAX_ID"),
        )

    supplier, customer = base(spark, sf_dir, "supplier"), base(spark, sf_dir, "customer")
    home = nation_code(F.col("s_nationkey"))
    next_door = nation_code((F.col("s_nationkey") + 1) % 25)
    return (
        listed(supplier.filter("s_suppkey % 2 = 0"), "s", home)
        .unionByName(listed(supplier.filter("s_suppkey % 3 = 0"), "s", next_door))
        .unionByName(
            listed(customer.filter("c_custkey % 4 <> 0"), "c", nation_code(F.col("c_nationkey")))
        )
        .unionByName(listed(customer.filter("c_custkey % 3 <> 0"), "c", F.lit("CR")))
    )


def company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return company_with_tax_ids(spark, sf_dir).drop("COMPANY_TAX_ID")


def many_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The companies, and as many again as there are order lines, which never occur."""
    number = F.concat_ws(" ", "l_orderkey", "l_linenumber")
    return company(spark, sf_dir).unionByName(base(spark, sf_dir, "lineitem").select(
        F.lit("CR").alias("country"), F.concat(F.lit("TRADER "), number).alias("COMPANY_ham"),
        F.concat(F.lit("CR"), numbered(F.col("l_orderkey"))).alias("TA_CODE"),
    ))


def hot_importer(df: DataFrame) -> DataFrame:
    """A third of the declarations, all of one importer."""
    third = F.col("DECLARATION_NUMBER").cast("bigint") % 3 == 0
    return df.withColumns({
        "IMPORTER_NAME": F.when(third, "CUSTOMER#000000001").otherwise(F.col("IMPORTER_NAME")),
        "IMPORTER_COUNTRY": F.when(third, "CR").otherwise(F.col("IMPORTER_COUNTRY")),
    })


def raw_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Costa Rica import table with all columns as text, and odd values by item number."""
    raw = raw_cr_import(spark, sf_dir)
    heading = {new: old for old, new in CR_IMPORT.renames.items()}
    item = F.col(f"`{heading['ITEM_NO']}`")
    odd = {
        "CIF_VALUE": {1: "16777217", 6: "12345678901234567"},
        "QUANTITY": {2: "", 3: "12,5"},
        "ARRIVAL_DATE": {4: "2020-5", 5: "31/12/2020", 7: "2020"},
    }
    text = {c: F.col(f"`{c}`").cast("string") for c in raw.columns}
    for name, values in odd.items():
        for number, value in values.items():
            text[heading[name]] = F.when(item == number, value).otherwise(text[heading[name]])
    return raw.select(*(value.alias(c) for c, value in text.items()))


def hs_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tariff codes whose new code is that of the next part, and so listed itself."""
    nearby = numbered(F.col("HS_CODE").cast("bigint") + 1)
    return hs_desc(spark, sf_dir).withColumn("new_HS_CODE", F.when(F.col("new_HS_CODE").isNotNull(), nearby))


def _listed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).withColumn("table_name", F.concat(
        F.lit("yeni_veri_"), F.lower(nation_code(F.col("c_nationkey"))), F.lit("_"),
        F.date_format("l_shipdate", "yyyy_MM"),
        F.expr("case l_returnflag when 'R' then '_exp' when 'A' then '_imp' else '' end"),
        F.expr("case l_linestatus when 'F' then '_islendi' else '' end"),
    ))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of tables: raw ones, outputs, and others that are not to be taken up."""
    others = base(spark, sf_dir, "part").select(
        F.concat(F.lit("tmp_"), F.lower("p_brand")).alias("table_name")
    )
    return _listed_names(spark, sf_dir).select("table_name").unionByName(others).distinct()


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _listed_names(spark, sf_dir).filter("l_suppkey % 3 = 0").select("table_name").distinct()
    )


def lookups(spark: SparkSession, sf_dir: str, country: str = "CR", **options) -> Lookups:
    return Lookups.prepare(
        country,
        country_map(spark, sf_dir),
        country_uniq(spark, sf_dir),
        hs_desc(spark, sf_dir),
        unit_map(spark),
        company(spark, sf_dir),
        **options,
    )
