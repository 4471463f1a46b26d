"""The registered queries once more, as SQL for an independent engine.

Every text is self-contained: the stand-in tables and the steps before the one
in question are common table expressions in front of it.
"""

from __future__ import annotations

from cargoweave.layout import country_codes
from checks.stand_ins import NATION_CODES

# The shipment layout in its order with the types of the working table, stated here
# once more so that the package is checked against it.
_TYPES = {
    "ARRIVAL_DATE": "date",
    "BILL_OF_LADING_NO": "varchar",
    "DECLARATION_NUMBER": "varchar",
    "HS_CODE": "varchar",
    "HS_CODE_DESCRIPTION": "varchar",
    "PRODUCT_DETAILS": "varchar",
    "IMPORTER_TA_CODE": "varchar",
    "EXPORTER_TA_CODE": "varchar",
    "FOB_VALUE": "double",
    "FOB_CURRENCY": "varchar",
    "FREIGHT_AMOUNT": "double",
    "INSURANCE_AMOUNT": "double",
    "F_I_CURRENCY": "varchar",
    "CIF_VALUE": "double",
    "CIF_CURRENCY": "varchar",
    "STATISTICAL_VALUE_USD": "double",
    "UNIT_PRICE": "double",
    "NET_WEIGHT": "double",
    "NET_WEIGHT_UNIT": "varchar",
    "GROSS_WEIGHT": "double",
    "GROSS_WEIGHT_UNIT": "varchar",
    "QUANTITY": "double",
    "QUANTITY_UNIT": "varchar",
    "PACKAGE_AMOUNT": "double",
    "PACKAGES_UNIT": "varchar",
    "INCOTERMS": "varchar",
    "PAYMENT_TYPE": "varchar",
    "TRANSPORT_TYPE": "varchar",
    "REGIME": "varchar",
    "BRAND_NAME": "varchar",
    "MANUFACTURING_COMPANY": "varchar",
    "COUNTRY_OF_ORIGIN": "varchar",
    "PORT_OF_ARRIVAL": "varchar",
    "PORT_OF_DEPARTURE": "varchar",
    "CONDITION_New_Used": "varchar",
    "NOTIFY_PARTY": "varchar",
    "NOTIFY_ADDRESS": "varchar",
    "TRANSPORT_COMPANY": "varchar",
    "CONTAINER_COUNT": "double",
    "TOTAL_TEUS": "double",
    "EXPORT_DATA_TYPE": "integer",
    "IMPORT_DATA_TYPE": "integer",
    "ITEM_NO": "double",
    "DATA_TYPE": "varchar",
    "VESSEL_NAME": "varchar",
    "RECORD_ID": "varchar",
}
# The fields that a delivered row must carry.
P7_REQUIRED = (
    "ARRIVAL_DATE", "IMPORTER_TA_CODE", "EXPORTER_TA_CODE", "COUNTRY_OF_ORIGIN", "EXPORT_DATA_TYPE",
    "IMPORT_DATA_TYPE", "DATA_TYPE", "RECORD_ID",
)

CODES = "(" + ", ".join(f"'{code}'" for code in country_codes()) + ")"


def code_of(key: str) -> str:
    return f"substr('{NATION_CODES}', cast(1 + 2 * ({key}) as bigint), 2)"


def numbered(key: str) -> str:
    return f"lpad(cast({key} as varchar), 8, '0')"


def key_of(name: str) -> str:
    return f"""nullif(regexp_replace({name}, '[.,\\-"''&/#() +:<>]', '', 'g'), '')"""


def missing_fields(*present: str) -> str:
    """The layout's other fields as typed NULLs."""
    return ", ".join(
        f"cast(null as {kind}) as {name}" for name, kind in _TYPES.items() if name not in present
    )


def id_of(texts: str, numbers: str, order: str) -> str:
    parts = {c: f"cast({c} as varchar)" for c in texts.split()}
    parts |= {c: f"cast(cast(floor({c} * 1e6 + 0.5) as bigint) as varchar)" for c in numbers.split()}
    parts = {c: f"case when {c} is null then 'n' else concat(length({p}), ':', {p}) end" for c, p in parts.items()}
    return "md5(concat_ws('|', " + ", ".join(parts[c] for c in order.split()) + "))"


def is_ta(value: str) -> str:
    return f"coalesce(regexp_matches({value}, '^[A-Z]{{2}}[0-9]{{8}}$'), false)"


def is_hs(value: str) -> str:
    return f"coalesce(regexp_matches({value}, '^[0-9]+$'), false)"


def tag(condition: str, text: str) -> str:
    return f"case when {condition} then '{text}' end"


VIOLATIONS = "concat_ws(',', " + ", ".join([
    tag("ARRIVAL_DATE is null", "ARRIVAL_DATE:exist"),
    tag("HS_CODE is null", "HS_CODE:exist"),
    tag(f"HS_CODE is not null and not {is_hs('HS_CODE')}", "HS_CODE:hs_code"),
    tag("IMPORTER_TA_CODE is null", "IMPORTER_TA_CODE:exist"),
    tag(f"IMPORTER_TA_CODE is not null and not {is_ta('IMPORTER_TA_CODE')}",
        "IMPORTER_TA_CODE:ta_code"),
    tag("EXPORTER_TA_CODE is null", "EXPORTER_TA_CODE:exist"),
    tag(f"EXPORTER_TA_CODE is not null and not {is_ta('EXPORTER_TA_CODE')}",
        "EXPORTER_TA_CODE:ta_code"),
    tag("COUNTRY_OF_ORIGIN is null", "COUNTRY_OF_ORIGIN:exist"),
    tag(f"COUNTRY_OF_ORIGIN is not null and COUNTRY_OF_ORIGIN not in {CODES}",
        "COUNTRY_OF_ORIGIN:country"),
    tag("RECORD_ID is null", "RECORD_ID:exist"),
]) + ")"


def coded(table: str, *columns: str) -> str:
    """Country spellings replaced by codes."""
    joins = " ".join(
        f"left join country_map m{i} on t.{c} = m{i}.country2" for i, c in enumerate(columns)
    )
    new = ", ".join(f"coalesce(m{i}.code, t.{c}) as {c}" for i, c in enumerate(columns))
    return f"select t.* replace ({new}) from {table} t {joins}"


COUNTRY_COLUMNS = ("COUNTRY_OF_ORIGIN", "EXPORTER_COUNTRY", "IMPORTER_COUNTRY")


def ported(table: str, *pairs: tuple[str, str]) -> str:
    joins = " ".join(
        f"left join country_uniq u{i} on t.{country} = u{i}.alpha2"
        for i, (country, _) in enumerate(pairs)
    )
    new = ", ".join(f"coalesce(t.{p}, u{i}.short_name) as {p}" for i, (_, p) in enumerate(pairs))
    return f"select t.* replace ({new}) from {table} t {joins}"


PORTS = (("IMPORTER_COUNTRY", "PORT_OF_ARRIVAL"), ("EXPORTER_COUNTRY", "PORT_OF_DEPARTURE"))


def described(table: str, codes: str = "hs_desc", country: str = "CR") -> str:
    return f"""select t.* replace (coalesce(h.new_HS_CODE, t.HS_CODE) as HS_CODE,
      coalesce(h.HS_CODE_DESC, t.HS_CODE_DESCRIPTION) as HS_CODE_DESCRIPTION)
      from {table} t left join (select * from {codes} where country = '{country}') h
      on t.HS_CODE = h.HS_CODE"""


def converted(table: str, country: str = "CR") -> str:
    return f"""select t.* replace (coalesce(m.new_unit, t.QUANTITY_UNIT) as QUANTITY_UNIT,
      case when m.factor is not null then t.QUANTITY * m.factor else t.QUANTITY end as QUANTITY)
      from {table} t left join (select * from unit_map where country = '{country}') m
      on t.QUANTITY_UNIT = m.unit"""


def with_ta(table: str, *sides: str, keys: str = "company_keys") -> str:
    joins = " ".join(
        f"left join {keys} k{i} on t.{s}_COUNTRY = k{i}.country"
        f" and {key_of(f't.{s}_NAME')} = k{i}.company_key"
        for i, s in enumerate(sides)
    )
    new = ", ".join(
        f"coalesce(t.{s}_TA_CODE, k{i}.TA_CODE) as {s}_TA_CODE" for i, s in enumerate(sides)
    )
    return f"select t.* replace ({new}) from {table} t {joins}"


RAW = """ARRIVAL_DATE DECLARATION_NUMBER ITEM_NO IMPORTER_TAX_ID IMPORTER_NAME HS_CODE
PRODUCT_DETAILS COUNTRY_OF_ORIGIN yedek_EXPORTER_COUNTRY EXPORTER_COUNTRY QUANTITY QUANTITY_UNIT
CIF_VALUE NET_WEIGHT GROSS_WEIGHT PORT_OF_ARRIVAL EXPORTER_NAME"""
NUMBERS = "ITEM_NO QUANTITY CIF_VALUE NET_WEIGHT GROSS_WEIGHT"
RAW_ID = id_of(RAW, NUMBERS, RAW)
EXPORT_RAW = RAW.removeprefix("ARRIVAL_DATE ")
EXPORT_ID = id_of(EXPORT_RAW, NUMBERS, EXPORT_RAW)

CR_ADDED = """'Kilogram' as NET_WEIGHT_UNIT, 'Kilogram' as GROSS_WEIGHT_UNIT,
  'USD' as CIF_CURRENCY, 'CR' as IMPORTER_COUNTRY, cast(null as varchar) as PORT_OF_DEPARTURE,
  cast(null as varchar) as IMPORTER_TA_CODE, cast(null as varchar) as EXPORTER_TA_CODE,
  'Custom' as DATA_TYPE, 4 as EXPORT_DATA_TYPE, 1 as IMPORT_DATA_TYPE"""
CR_PRESENT = RAW.split() + """NET_WEIGHT_UNIT GROSS_WEIGHT_UNIT CIF_CURRENCY IMPORTER_COUNTRY
PORT_OF_DEPARTURE IMPORTER_TA_CODE EXPORTER_TA_CODE DATA_TYPE EXPORT_DATA_TYPE IMPORT_DATA_TYPE
RECORD_ID""".split()
SHIPMENT_COLUMNS = """ARRIVAL_DATE DECLARATION_NUMBER ITEM_NO HS_CODE HS_CODE_DESCRIPTION
PRODUCT_DETAILS COUNTRY_OF_ORIGIN QUANTITY QUANTITY_UNIT CIF_VALUE NET_WEIGHT PORT_OF_ARRIVAL
PORT_OF_DEPARTURE IMPORTER_TA_CODE EXPORTER_TA_CODE""".split()

VIEWS = {
    "lines": """select l.*, o.*, c.*, p.*, s.*, sn.n_name as sn_name, cn.n_name as cn_name
      from lineitem l join orders o on l_orderkey = o_orderkey
      join customer c on o_custkey = c_custkey join part p on l_partkey = p_partkey
      join supplier s on l_suppkey = s_suppkey join nation sn on s_nationkey = sn.n_nationkey
      join nation cn on c_nationkey = cn.n_nationkey""",
    "shipments": """select cast(l_shipdate as date) as ARRIVAL_DATE,
      cast(l_orderkey as varchar) as DECLARATION_NUMBER, cast(l_linenumber as double) as ITEM_NO,
      cast(o_custkey as varchar) as IMPORTER_TAX_ID,
      case when l_linenumber = 3 then replace(upper(c_name), '#', ' & ')
        when l_linenumber = 4 then '- . -' else upper(c_name) end as IMPORTER_NAME,
      case when l_linenumber = 5 then replace(upper(s_name), '#', ', <+> ')
        else upper(s_name) end as EXPORTER_NAME,
      case when l_partkey % 17 = 0 then null when l_partkey % 19 = 0 then 'HS-x'
        when l_partkey % 23 = 0 then '' else lpad(cast(l_partkey as varchar), 8, '0') end as HS_CODE,
      case when l_partkey % 3 = 0 then p_name end as HS_CODE_DESCRIPTION, p_name as PRODUCT_DETAILS,
      case when l_suppkey % 7 = 0 then null else sn_name end as COUNTRY_OF_ORIGIN,
      case when l_suppkey % 5 = 0 then null else sn_name end as EXPORTER_COUNTRY,
      cn_name as IMPORTER_COUNTRY,
      case when l_orderkey % 13 = 0 then null else l_quantity end as QUANTITY,
      case when l_orderkey % 11 = 0 then null else p_type end as QUANTITY_UNIT,
      l_extendedprice as CIF_VALUE, p_size * l_quantity as NET_WEIGHT,
      case when l_linenumber = 1 then 'PORT' end as PORT_OF_ARRIVAL,
      case when l_linenumber = 2 then 'QUAY' end as PORT_OF_DEPARTURE,
      case l_linenumber when 6 then 'ZZ00000001' when 7 then 'bad' end as IMPORTER_TA_CODE,
      case l_linenumber when 6 then 'ZZ00000002' end as EXPORTER_TA_CODE from lines""",
    "country_map": f"""select n_name as country2, {code_of('n_nationkey')} as code from nation
      where n_nationkey < 20""",
    "country_uniq": f"""select {code_of('n_nationkey')} as alpha2,
      concat(r_name, ' ', n_name) as short_name from nation join region on n_regionkey = r_regionkey
      where n_nationkey < 15 union all select 'CR', 'COSTA RICA'""",
    "hs_desc": f"""select 'CR' as country, {numbered('p_partkey')} as HS_CODE,
      concat(p_type, ' ', p_name) as HS_CODE_DESC,
      case when p_size < 10 then {numbered('p_partkey + 1000000')} end as new_HS_CODE
      from part where p_partkey % 4 <> 0
      union all select 'AR', {numbered('p_partkey')}, concat(p_brand, ' ', p_name),
      case when p_size < 10 then {numbered('p_partkey + 1000000')} end
      from part where p_partkey % 4 <> 1""",
    "unit_map": """select * from (values ('CR', 'ECONOMY', 'Kilogram', 1000.0e0),
      ('CR', 'LARGE', 'Tonne', 0.001e0), ('CR', 'MEDIUM', 'Pieces', cast(null as double)),
      ('CR', 'PROMO', 'Pieces', 12.0e0), ('AR', 'ECONOMY', 'Gram', 1000000.0e0),
      ('AR', 'SMALL', 'Dozen', 0.5e0)) as t(country, unit, new_unit, factor)""",
    "company": f"""select {code_of('n_nationkey')} as country, upper(s_name) as COMPANY_ham,
      concat({code_of('n_nationkey')}, {numbered('s_suppkey')}) as TA_CODE
      from supplier cross join nation where (s_suppkey % 2 = 0 and n_nationkey = s_nationkey)
      or (s_suppkey % 3 = 0 and n_nationkey = (s_nationkey + 1) % 25)
      union all select {code_of('c_nationkey')}, upper(c_name),
      concat({code_of('c_nationkey')}, {numbered('c_custkey')})
      from customer where c_custkey % 4 <> 0
      union all select 'CR', upper(c_name), concat('CR', {numbered('c_custkey')})
      from customer where c_custkey % 3 <> 0""",
    "company_keys": f"""select country, {key_of('COMPANY_ham')} as company_key,
      min(TA_CODE) as TA_CODE from company where {key_of('COMPANY_ham')} is not null group by 1, 2""",
    "many_keys": f"""select country, {key_of('COMPANY_ham')} as company_key, min(TA_CODE) as TA_CODE from (
      select * from company union all
      select 'CR', concat('TRADER ', l_orderkey, ' ', l_linenumber), concat('CR', {numbered('l_orderkey')}) from lineitem)
      where {key_of('COMPANY_ham')} is not null group by 1, 2""",
    "tax_keys": f"""select country, tax_key, min(TA_CODE) as TA_CODE from (
      select {code_of('c_nationkey')} as country, concat({code_of('c_nationkey')}, {numbered('c_custkey')}) as TA_CODE,
        cast(case when c_custkey % 5 = 0 then c_custkey + 1 else c_custkey end as varchar) as tax_key
      from customer where c_custkey % 4 <> 0
      union all select 'CR', concat('CR', {numbered('c_custkey')}),
        cast(case when c_custkey % 5 = 0 then c_custkey + 1 else c_custkey end as varchar)
      from customer where c_custkey % 3 <> 0) group by 1, 2""",
    "hs_chain": """select country, HS_CODE, HS_CODE_DESC,
      case when new_HS_CODE is not null then lpad(cast(cast(HS_CODE as bigint) + 1 as varchar), 8, '0') end as new_HS_CODE
      from hs_desc""",
    "names": f"""select concat('yeni_veri_', lower({code_of('c_nationkey')}), '_',
      strftime(l_shipdate, '%Y_%m'),
      case l_returnflag when 'R' then '_exp' when 'A' then '_imp' else '' end,
      case l_linestatus when 'F' then '_islendi' else '' end) as table_name, l_suppkey from lines""",
    "registry": """select table_name from names
      union select concat('tmp_', lower(p_brand)) from part""",
    "ledger": "select distinct table_name from names where l_suppkey % 3 = 0",
    "raw_names": r"""select table_name from registry
      where regexp_matches(table_name, '^yeni_veri_[a-z]{2}_20[0-9]{2}_[0-9]{2}')
      and right(table_name, 8) <> '_islendi'""",
    "unprocessed": """select table_name from raw_names
      where not exists (select 1 from ledger l where l.table_name = raw_names.table_name)""",
    "raw": f"""select * exclude (IMPORTER_COUNTRY, HS_CODE_DESCRIPTION, PORT_OF_DEPARTURE,
      IMPORTER_TA_CODE, EXPORTER_TA_CODE), COUNTRY_OF_ORIGIN as yedek_EXPORTER_COUNTRY,
      NET_WEIGHT * 2 as GROSS_WEIGHT from shipments""",
    "added": f"select raw.*, {CR_ADDED}, {RAW_ID} as RECORD_ID from raw",
    "conformed": f"select added.*, {missing_fields(*CR_PRESENT)} from added",
    "ships_coded": coded("shipments", *COUNTRY_COLUMNS),
    "p_coded": coded("conformed", *COUNTRY_COLUMNS),
    "p_country": ported("p_coded", *PORTS),
    "p_hs": described("p_country"),
    "p_quantity": converted("p_hs"),
    "processed": with_ta("p_quantity", "EXPORTER", "IMPORTER"),
    "checked": f"select *, {VIOLATIONS} as violations from processed",
}

_PRELUDE = "with " + ",\n".join(f"{name} as ({text})" for name, text in VIEWS.items())


def long_form(table: str, **conditions: str) -> str:
    """Counts as rows; each keyword is CHECK__COLUMN and its condition."""
    return " union all ".join(
        f"select '{key.split('__')[0]}' as check_name, '{key.split('__')[1]}' as column_name,"
        f" count(*) filter (where {condition}) as n from {table}"
        for key, condition in conditions.items()
    )


AUDITED = """PORT_OF_ARRIVAL PORT_OF_DEPARTURE HS_CODE HS_CODE_DESCRIPTION ARRIVAL_DATE
IMPORTER_TA_CODE EXPORTER_TA_CODE QUANTITY QUANTITY_UNIT COUNTRY_OF_ORIGIN""".split()


def null_counts(table: str) -> str:
    return long_form(table, **{f"null__{c}": f"{c} is null" for c in AUDITED})


def hs_integrity(table: str) -> str:
    return long_form(
        table,
        null_hs_code__HS_CODE="HS_CODE is null",
        null_hs_code_description__HS_CODE_DESCRIPTION="HS_CODE_DESCRIPTION is null",
        invalid_hs_code_format__HS_CODE=f"HS_CODE is not null and not {is_hs('HS_CODE')}",
    )


def ta_format(table: str) -> str:
    counts = long_form(table, **{
        f"invalid_ta_code__{c}": f"not {is_ta(c)}" for c in ("IMPORTER_TA_CODE", "EXPORTER_TA_CODE")
    })
    return f"select * from ({counts}) where n > 0"


def quantity_nulls(table: str) -> str:
    return long_form(
        table,
        null_quantity__QUANTITY="QUANTITY is null",
        null_quantity_unit__QUANTITY_UNIT="QUANTITY_UNIT is null",
    )


def unknown(table: str, value: str, known: str) -> str:
    return f"""select {value} as value, count(*) as n from {table}
      where not exists (select 1 from {known} k where k.known = {table}.{value}) group by 1"""


KNOWN_COUNTRIES = "(select alpha2 as known from country_uniq)"
KNOWN_UNITS = "(select unit as known from unit_map where country = 'CR')"


def audit(table: str) -> str:
    scalars = " union all ".join(
        f"select check_name, column_name, cast(null as varchar) as value, n from ({part(table)})"
        for part in (null_counts, hs_integrity, ta_format, quantity_nulls)
    )
    return f"""{scalars}
      union all select 'unknown_country', 'COUNTRY_OF_ORIGIN', value, n
        from ({unknown(table, 'COUNTRY_OF_ORIGIN', KNOWN_COUNTRIES)})
      union all select 'unknown_unit', 'QUANTITY_UNIT', value, n
        from ({unknown(table, 'QUANTITY_UNIT', KNOWN_UNITS)})"""


_DELIVERED = {"integer": "varchar", "double": "float"}
P7 = ", ".join(f"cast({name} as {_DELIVERED.get(kind, kind)}) as {name}" for name, kind in _TYPES.items())
P7_COMPLETE = " and ".join(f"{c} is not null" for c in P7_REQUIRED)
P7_MISSING = "concat_ws(',', " + ", ".join(tag(f"{c} is null", c) for c in P7_REQUIRED) + ")"

# A company named by its key alone, from all countries that occur as exporters.
TA_ANY = f"""select t.* replace (coalesce(t.EXPORTER_TA_CODE, k.TA_CODE) as EXPORTER_TA_CODE)
  from ships_coded t left join (
    select {key_of('COMPANY_ham')} as company_key, arg_min(TA_CODE, concat(country, TA_CODE)) as TA_CODE
    from company where country in (select EXPORTER_COUNTRY from ships_coded) group by 1) k
  on {key_of('t.EXPORTER_NAME')} = k.company_key"""

AR_ORDER = """DAY MONTH YEAR DECLARATION_NUMBER REGIME PORT_OF_ARRIVAL IMPORTER_TAX_ID IMPORTER_NAME
EXPORTER_COUNTRY TRANSPORT_TYPE PORT_OF_DEPARTURE INCOTERMS TOTAL_FOB TOTAL_FREIGHT TOTAL_INSURANCE
TOTAL_CIF PACKAGE_AMOUNT GROSS_WEIGHT ITEM_NUMBER COUNTRY_OF_ORIGIN QUANTITY QUANTITY_UNIT FOB_VALUE
FREIGHT_AMOUNT INSURANCE_AMOUNT HS_CODE PRODUCT_DETAILS CIF_VALUE SUBITEM_NUMBER BRAND_NAME VARIETY
ATTRIBUTES SUBITEM_FOB SUBITEM_QUANTITY"""
AR_ID = id_of(AR_ORDER, "PACKAGE_AMOUNT GROSS_WEIGHT QUANTITY FOB_VALUE", AR_ORDER)
_AR_KNOWN = """DECLARATION_NUMBER REGIME PORT_OF_ARRIVAL IMPORTER_TAX_ID IMPORTER_NAME EXPORTER_COUNTRY
TRANSPORT_TYPE PACKAGE_AMOUNT GROSS_WEIGHT COUNTRY_OF_ORIGIN QUANTITY QUANTITY_UNIT FOB_VALUE HS_CODE
PRODUCT_DETAILS BRAND_NAME DAY MONTH YEAR""".split()
_AR_NULLS = ", ".join(
    f"cast(null as varchar) as {c}" for c in AR_ORDER.split() if c not in _AR_KNOWN
)
_AR_ADDED = """ARRIVAL_DATE PACKAGES_UNIT GROSS_WEIGHT_UNIT FOB_CURRENCY F_I_CURRENCY CIF_CURRENCY
EXPORT_DATA_TYPE IMPORT_DATA_TYPE DATA_TYPE IMPORTER_TA_CODE EXPORTER_TA_CODE RECORD_ID""".split()
CONFORM_AR = f"""select r.*,
    try_cast(concat(YEAR, '-', lpad(cast(MONTH as varchar), 2, '0'), '-', lpad(cast(DAY as varchar), 2, '0'))
      as date) as ARRIVAL_DATE,
    'Pieces' as PACKAGES_UNIT, 'Kilogram' as GROSS_WEIGHT_UNIT, 'USD' as FOB_CURRENCY,
    'USD' as F_I_CURRENCY, 'USD' as CIF_CURRENCY, 'AR' as IMPORTER_COUNTRY, 4 as EXPORT_DATA_TYPE,
    1 as IMPORT_DATA_TYPE, 'Custom' as DATA_TYPE, cast(null as varchar) as IMPORTER_TA_CODE,
    cast(null as varchar) as EXPORTER_TA_CODE, {AR_ID} as RECORD_ID,
    cast(null as varchar) as EXPORTER_NAME, {missing_fields(*AR_ORDER.split(), *_AR_ADDED)}
  from (select case when l_linenumber = 7 then 31 else cast(day(l_shipdate) as integer) end as DAY,
    cast(month(l_shipdate) as integer) as MONTH, cast(year(l_shipdate) as integer) as YEAR,
    cast(l_orderkey as varchar) as DECLARATION_NUMBER, l_returnflag as REGIME,
    case when l_linenumber = 1 then 'PORT' end as PORT_OF_ARRIVAL,
    cast(o_custkey as varchar) as IMPORTER_TAX_ID, upper(c_name) as IMPORTER_NAME,
    sn_name as EXPORTER_COUNTRY, l_linestatus as TRANSPORT_TYPE,
    cast(p_size as double) as PACKAGE_AMOUNT, p_size * l_quantity as GROSS_WEIGHT,
    case when l_suppkey % 7 = 0 then null else sn_name end as COUNTRY_OF_ORIGIN,
    l_quantity as QUANTITY, p_type as QUANTITY_UNIT, l_extendedprice as FOB_VALUE,
    lpad(cast(l_partkey as varchar), 8, '0') as HS_CODE, p_name as PRODUCT_DETAILS,
    p_brand as BRAND_NAME, {_AR_NULLS} from lines) r"""

HOT_IMPORTER = """select * replace (
  case when cast(DECLARATION_NUMBER as bigint) % 3 = 0 then 'CUSTOMER#000000001' else IMPORTER_NAME end as IMPORTER_NAME,
  case when cast(DECLARATION_NUMBER as bigint) % 3 = 0 then 'CR' else IMPORTER_COUNTRY end as IMPORTER_COUNTRY)
  from ships_coded"""

# Tax id before name, on either side; exporters have none here.
BY_RANK = f"""select t.* replace (
    coalesce(t.EXPORTER_TA_CODE, e.TA_CODE) as EXPORTER_TA_CODE,
    coalesce(t.IMPORTER_TA_CODE, x.TA_CODE, i.TA_CODE) as IMPORTER_TA_CODE),
    case when t.EXPORTER_TA_CODE is null and e.TA_CODE is not null then 'name' end as EXPORTER_TA_CODE_BY,
    case when t.IMPORTER_TA_CODE is not null then null when x.TA_CODE is not null then 'tax id'
      when i.TA_CODE is not null then 'name' end as IMPORTER_TA_CODE_BY
  from p_country t
  left join company_keys e on t.EXPORTER_COUNTRY = e.country and {key_of('t.EXPORTER_NAME')} = e.company_key
  left join tax_keys x on t.IMPORTER_COUNTRY = x.country and {key_of('t.IMPORTER_TAX_ID')} = x.tax_key
  left join company_keys i on t.IMPORTER_COUNTRY = i.country and {key_of('t.IMPORTER_NAME')} = i.company_key"""

# The table of texts: what its odd values make of a row, by item number.
_TEXT_READ = """case when ITEM_NO in (4, 5, 7) then null else ARRIVAL_DATE end as ARRIVAL_DATE,
  case ITEM_NO when 1 then 16777217 when 6 then null else CIF_VALUE end as CIF_VALUE,
  case when ITEM_NO in (2, 3) then null else QUANTITY end as QUANTITY"""
_TEXT_FAILED = """case ITEM_NO when 3 then 'QUANTITY=12,5' when 4 then 'ARRIVAL_DATE=2020-5'
  when 5 then 'ARRIVAL_DATE=31/12/2020' when 6 then 'CIF_VALUE=12345678901234567'
  when 7 then 'ARRIVAL_DATE=2020' else '' end"""
_TEXT_BROKEN = """case when failed <> '' then concat(split_part(failed, '=', 1), case when failed like 'ARRIVAL%'
  then ':date' else ':float' end) end"""
_TEXT_COLUMNS = """DECLARATION_NUMBER, ITEM_NO, ARRIVAL_DATE, CIF_VALUE, QUANTITY, QUANTITY_UNIT, HS_CODE,
  HS_CODE_DESCRIPTION, failed"""
TEXT_PROCESS = f"""select {_TEXT_COLUMNS}, concat_ws(',', nullif({VIOLATIONS}, ''), {_TEXT_BROKEN}) as violations
  from (select * replace ({_TEXT_READ}), {_TEXT_FAILED} as failed from processed)"""
_LOCAL_VIEWS = {
    "l_came": """select * replace (
      case when ITEM_NO in (4, 7) then null when ITEM_NO = 5 then date '2020-12-31' else ARRIVAL_DATE end as ARRIVAL_DATE,
      case ITEM_NO when 1 then 16777217 when 6 then null else CIF_VALUE end as CIF_VALUE,
      case ITEM_NO when 2 then null when 3 then 12.5 else QUANTITY end as QUANTITY) from p_country""",
    "l_quantity": converted("l_came"),
}
TEXT_LOCAL = """select DECLARATION_NUMBER, ITEM_NO, ARRIVAL_DATE, CIF_VALUE, QUANTITY,
  case ITEM_NO when 3 then 'QUANTITY=number ,' when 5 then 'ARRIVAL_DATE=date dd/MM/yyyy' else '' end as parsed_by,
  case when ITEM_NO in (4, 7) then 'ARRIVAL_DATE' when ITEM_NO = 6 then 'CIF_VALUE' else '' end as failed
  from l_quantity"""


def repaired(came: str, failed: str, codes: str = "hs_desc") -> dict[str, str]:
    """Views from ``came``, which has the values before any lookup as came_ columns, processed and
    with its violations, to ``r_done``: the rows that were held, repaired."""
    return {
        "r_filled": f"""select * exclude (violations) replace (nullif(came_hs, '') as HS_CODE, null as HS_CODE_DESCRIPTION,
          came_quantity as QUANTITY, came_unit as QUANTITY_UNIT,
          coalesce(COUNTRY_OF_ORIGIN, EXPORTER_COUNTRY, 'ZZ') as COUNTRY_OF_ORIGIN,
          coalesce(EXPORTER_COUNTRY, COUNTRY_OF_ORIGIN, 'ZZ') as EXPORTER_COUNTRY),
          HS_CODE as old_hs, HS_CODE_DESCRIPTION as old_text, COUNTRY_OF_ORIGIN as old_origin, EXPORTER_COUNTRY as old_exporter,
          EXPORTER_TA_CODE as old_code from {came} where violations <> ''""",
        "r_hs": described("r_filled", codes),
        "r_quantity": converted("r_hs"),
        "r_ta": with_ta("r_quantity", "EXPORTER", "IMPORTER"),
        "r_done": f"select * replace ({failed} as failed) from r_ta",
    }


_TEXT_VIEWS = {
    "t_came": f"""select * replace ({_TEXT_READ}), {_TEXT_FAILED} as failed, HS_CODE as came_hs, QUANTITY_UNIT as came_unit,
      case when ITEM_NO = 2 then null when ITEM_NO = 3 then 12.5 else QUANTITY end as came_quantity from p_country""",
    "t_hs": described("t_came"),
    "t_quantity": converted("t_hs"),
    "t_processed": with_ta("t_quantity", "EXPORTER", "IMPORTER"),
    "t_checked": f"select *, concat_ws(',', nullif({VIOLATIONS}, ''), {_TEXT_BROKEN}) as violations from t_processed",
    **repaired("t_checked", "case when ITEM_NO in (3, 5) then '' else failed end"),
}
TEXT_REMEDIATED = f"""select {_TEXT_COLUMNS}, violations
  from (select *, concat_ws(',', nullif({VIOLATIONS}, ''), {_TEXT_BROKEN}) as violations from (
    select * replace (case when ITEM_NO = 5 then date '2020-12-31' else ARRIVAL_DATE end as ARRIVAL_DATE) from r_done))"""

_ROUND_VIEWS = {
    "t_came": """select *, '' as failed, HS_CODE as came_hs, QUANTITY_UNIT as came_unit, QUANTITY as came_quantity from p_country""",
    "t_hs": described("t_came", "hs_chain"),
    "t_quantity": converted("t_hs"),
    "t_processed": with_ta("t_quantity", "EXPORTER", "IMPORTER"),
    "t_checked": f"select *, {VIOLATIONS} as violations from t_processed",
    **repaired("t_checked", "''", "hs_chain"),
}
_ROUND_COLUMNS = """RECORD_ID, DECLARATION_NUMBER, ITEM_NO, HS_CODE, HS_CODE_DESCRIPTION, COUNTRY_OF_ORIGIN, EXPORTER_TA_CODE,
  QUANTITY, QUANTITY_UNIT, violations"""
_CHANGED = " or ".join(f"{c} is distinct from {old}" for c, old in {
    "HS_CODE": "old_hs", "HS_CODE_DESCRIPTION": "old_text", "COUNTRY_OF_ORIGIN": "old_origin",
    "EXPORTER_COUNTRY": "old_exporter", "EXPORTER_TA_CODE": "old_code",
}.items())
REMEDIATION_ROUNDS = f"""select {_ROUND_COLUMNS}, 'accepted' as outcome, 0 as rounds from t_checked where violations = ''
  union all select {_ROUND_COLUMNS}, case when violations = '' then 'accepted' else 'quarantined' end as outcome,
    case when {_CHANGED} then 1 else 0 end as rounds
  from (select *, {VIOLATIONS} as violations from r_done)"""

REMEDIATED = f"""select *, {VIOLATIONS} as violations from (
  {with_ta('r_hs', 'EXPORTER', 'IMPORTER')})"""
_REMEDY_VIEWS = {
    "r_filled": """select * exclude (violations) replace (nullif(HS_CODE, '') as HS_CODE,
      coalesce(COUNTRY_OF_ORIGIN, EXPORTER_COUNTRY, 'ZZ') as COUNTRY_OF_ORIGIN,
      coalesce(EXPORTER_COUNTRY, COUNTRY_OF_ORIGIN, 'ZZ') as EXPORTER_COUNTRY)
      from checked where violations <> ''""",
    "r_hs": described("r_filled"),
}

COMPANY_FILE = f"""select distinct IMPORTER_TA_CODE as TA_CODE, IMPORTER_TAX_ID as COMPANY_TAX_ID,
      IMPORTER_NAME as COMPANY_NAME, cast(null as varchar) as COMPANY_ADDRESS,
      cast(null as varchar) as CITY_STATE from ({with_ta('ships_coded', 'IMPORTER')})"""

_BODIES = {
    "scan_shipments": "select * from shipments",
    "roundtrip_write": "select * from shipments",
    "csv_roundtrip": "select * from shipments",
    "discover_unprocessed": "select table_name from unprocessed",
    "ledger_append": "select table_name from ledger union all select table_name from unprocessed",
    "raw_name_parse": r"""select table_name, upper(substr(table_name, 11, 2)) as country_code,
      cast(substr(table_name, 14, 4) as integer) as year,
      cast(substr(table_name, 19, 2) as integer) as month from raw_names""",
    "search_docs": """select RECORD_ID, ARRIVAL_DATE, HS_CODE, IMPORTER_NAME, EXPORTER_NAME,
      CIF_VALUE, QUANTITY, QUANTITY_UNIT, IMPORT_DATA_TYPE from processed""",
    "search_actions": """select t.*, (select 2 * count(*) from processed) as written_ids
      from (select * from processed union all select * from processed) t""",
    "csv_drift": """select DECLARATION_NUMBER, ITEM_NO, ARRIVAL_DATE, CIF_VALUE,
      case when ITEM_NO <= 3 then PRODUCT_DETAILS end as PRODUCT_DETAILS, cast(null as varchar) as record,
      case when ITEM_NO <= 3 then 'a' else 'b' end as folder from shipments where ITEM_NO <= 5
      union all select null, null, null, null, null, concat(DECLARATION_NUMBER, ',', cast(cast(ITEM_NO as integer) as varchar), '.0,no date,torn'), 'c'
      from shipments where ITEM_NO > 5""",
    "rename_columns": "select * from raw",
    "add_columns": "select * from added",
    "record_id": "select DECLARATION_NUMBER, ITEM_NO, RECORD_ID from added",
    "add_typed_columns": f"select *, {missing_fields(*SHIPMENT_COLUMNS)} from shipments",
    "reorder_columns": "select * from shipments",
    "finalize": f"select *, {missing_fields(*SHIPMENT_COLUMNS)} from shipments",
    "p7_projection": f"select {P7} from processed where {P7_COMPLETE}",
    "p7_rejects": f"""select {P7}, {P7_MISSING} as MISSING_FIELDS
      from processed where not ({P7_COMPLETE})""",
    "data_type_from_name": """select table_name, case when contains(upper(table_name), 'IMP')
      then 'IMPORT' when contains(upper(table_name), 'EXP') then 'EXPORT' end as data_type
      from registry""",
    "conform_cr_import": "select * from conformed",
    "conform_cr_export": f"""select * exclude (ARRIVAL_DATE, RECORD_ID),
      date '1900-01-01' as ARRIVAL_DATE, {EXPORT_ID} as RECORD_ID from conformed""",
    "conform_ar_import": CONFORM_AR,
    "rules_of_text": """select DECLARATION_NUMBER, ITEM_NO, case when ITEM_NO in (2, 3) then 'ARRIVAL_DATE:date'
      when ITEM_NO in (4, 5) then 'EXPORT_DATA_TYPE:short' when ITEM_NO = 6 then 'QUANTITY:float' else '' end as violations
      from shipments""",
    "company_rules": f"""select *, concat_ws(',', {tag('TA_CODE is null', 'TA_CODE:exist')},
      {tag(f"TA_CODE is not null and not {is_ta('TA_CODE')}", 'TA_CODE:ta_code')}, {tag('COMPANY_NAME is null', 'COMPANY_NAME:exist')}) as violations
      from ({COMPANY_FILE})""",
    "company_file": COMPANY_FILE,
    "blank_to_null": "select * replace (nullif(HS_CODE, '') as HS_CODE) from shipments",
    "hs_enrich": described("shipments"),
    "country_code_map": coded("shipments", "EXPORTER_COUNTRY"),
    "country_all": "select * from ships_coded",
    "country_crossfill": """select * replace (
      coalesce(COUNTRY_OF_ORIGIN, EXPORTER_COUNTRY, 'ZZ') as COUNTRY_OF_ORIGIN,
      coalesce(EXPORTER_COUNTRY, COUNTRY_OF_ORIGIN, 'ZZ') as EXPORTER_COUNTRY) from shipments""",
    "port_fill": ported("ships_coded", PORTS[0]),
    "port_all": ported("ships_coded", *PORTS),
    "company_key": f"""select DECLARATION_NUMBER, ITEM_NO, IMPORTER_NAME,
      {key_of('IMPORTER_NAME')} as importer_key, {key_of('EXPORTER_NAME')} as exporter_key
      from shipments""",
    "ta_code_country": with_ta("ships_coded", "EXPORTER"),
    "ta_code_any": TA_ANY,
    "ta_code_both": with_ta("ships_coded", "EXPORTER", "IMPORTER"),
    "present_countries": f"""select distinct EXPORTER_COUNTRY as country from ships_coded
      where EXPORTER_COUNTRY in {CODES}""",
    "unit_convert": converted("shipments"),
    "hs_enrich_shuffled": described("shipments"),
    "ta_code_both_shuffled": with_ta("ships_coded", "EXPORTER", "IMPORTER"),
    "ta_code_any_shuffled": TA_ANY,
    "ta_code_reduced": with_ta(f"({HOT_IMPORTER})", "EXPORTER", "IMPORTER", keys="many_keys"),
    "ta_code_by_rank": BY_RANK,
    "ta_code_by_rank_shuffled": BY_RANK,
    "process_full_shuffled": "select * from processed",
    "text_process": TEXT_PROCESS,
    "run_unprocessed": """select concat('yeni_veri_cr_2024_0', m.month, '_imp') as table_name,
      count(*) filter (where violations = '') as accepted, count(*) filter (where violations <> '') as quarantined,
      month < 5 as marked from (select unnest(range(1, 6)) as month) m
      left join checked c on month < 5 and cast(ITEM_NO as bigint) % 4 = month - 1 group by month""",
    "text_intake_violations": """select 'float' as check_name, 'QUANTITY' as column_name, count(*) as n
      from raw where ITEM_NO = 3""",
    "null_counts": null_counts("shipments"),
    "hs_integrity": hs_integrity("shipments"),
    "ta_format": ta_format("shipments"),
    "quantity_nulls": quantity_nulls("shipments"),
    "unknown_countries": f"""select value as COUNTRY_OF_ORIGIN
      from ({unknown('ships_coded', 'COUNTRY_OF_ORIGIN', KNOWN_COUNTRIES)})""",
    "unknown_units": f"""select value as QUANTITY_UNIT
      from ({unknown('shipments', 'QUANTITY_UNIT', KNOWN_UNITS)})""",
    "audit": audit("processed"),
    "run_table": audit("processed"),
    "rule_violations": "select RECORD_ID, DECLARATION_NUMBER, ITEM_NO, violations from checked",
    "rule_summary": """select split_part(v, ':', 2) as check_name, split_part(v, ':', 1) as column_name,
      count(*) as n from (select unnest(string_split(violations, ',')) as v from checked
      where violations <> '') group by 1, 2""",
    "accepted_rows": "select * exclude (violations) from checked where violations = ''",
    "quarantined_rows": "select * from checked where violations <> ''",
    "split_sinks": """select *, case when violations = '' then 'accepted' else 'quarantined' end
      as outcome from checked""",
    "stage_columns": "select * from conformed",
    "stage_country": "select * from p_country",
    "stage_hs": described("conformed"),
    "stage_quantity": converted("conformed"),
    "stage_ta": with_ta("p_country", "EXPORTER", "IMPORTER"),
    "process_full": "select * from processed",
    "incremental_equals_batch": "select * from processed",
    "incremental_resent": """select distinct *, case when violations = '' then 'accepted' else 'quarantined' end as outcome from checked""",
}


_AR_VIEWS = {
    "a_conformed": CONFORM_AR,
    "a_coded": coded("a_conformed", *COUNTRY_COLUMNS),
    "a_country": ported("a_coded", *PORTS),
    "a_hs": described("a_country", country="AR"),
    "a_quantity": converted("a_hs", "AR"),
    "a_processed": with_ta("a_quantity", "EXPORTER", "IMPORTER"),
}
PROCESS_AR = """select RECORD_ID, DECLARATION_NUMBER, ARRIVAL_DATE, HS_CODE, HS_CODE_DESCRIPTION, QUANTITY, QUANTITY_UNIT,
  COUNTRY_OF_ORIGIN, EXPORTER_COUNTRY, IMPORTER_COUNTRY, PORT_OF_ARRIVAL, PORT_OF_DEPARTURE, IMPORTER_TA_CODE, EXPORTER_TA_CODE,
  FOB_VALUE, FOB_CURRENCY, GROSS_WEIGHT, DATA_TYPE from a_processed"""

#: Bodies with views of their own.
_WITH_VIEWS = {
    "process_ar": (_AR_VIEWS, PROCESS_AR),
    "remediated_rows": (_REMEDY_VIEWS, REMEDIATED),
    "text_local": (_LOCAL_VIEWS, TEXT_LOCAL),
    "text_remediated": (_TEXT_VIEWS, TEXT_REMEDIATED),
    "remediation_rounds": (_ROUND_VIEWS, REMEDIATION_ROUNDS),
}


def oracle_sql() -> dict[str, str]:
    texts = {name: f"{_PRELUDE}\n{body}" for name, body in _BODIES.items()}
    for name, (views, body) in _WITH_VIEWS.items():
        own = ",\n".join(f"{view} as ({text})" for view, text in views.items())
        texts[name] = f"{_PRELUDE},\n{own}\n{body}"
    return texts
