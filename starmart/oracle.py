"""DuckDB SQL for the correctness check: the same derivations as the
Spark code, written as plain SQL over the driver's pre-registered views.

These strings are the *independent* statement of each result (a second
engine, a second formulation); they are not used by the library itself.
"""
from __future__ import annotations

# RAW mapping (FIXTURES.md §3, DuckDB dialect).
RAW = """
select cast(l_orderkey * 10 + l_linenumber as varchar) as trans_index,
       md5(concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
           cast(l_partkey as varchar), cast(l_suppkey as varchar), amt)) as trans_num,
       strftime(ts, '%Y-%m-%d %H:%M:%S') as trans_date_trans_time,
       cc_num, merchant, category, amt, cust_first, cust_last, gender, street,
       city, state, zip, lat, home_lon, city_pop, job,
       cast(date '1950-01-01' + cast(c_custkey * 37 % 18000 as int) as varchar) as dob,
       cast(cast(epoch(ts) as bigint) as varchar) as unix_time,
       merch_lat, merch_long, is_fraud
from (
  select *, l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 86400) as ts,
    cast(cast(l_extendedprice as decimal(12,2)) as varchar) as amt,
    (case c_custkey % 5 when 0 then '3' when 1 then '4' when 2 then '5' when 3 then '6' else '9' end)
      || lpad(cast(c_custkey as varchar), 15, '0') as cc_num,
    'fraud_' || s_name as merchant, p_brand as category,
    substr(c_name, 1, 8) as cust_first,
    case when c_custkey % 50 = 0 then null else substr(c_name, 10) end as cust_last,
    case when c_custkey % 2 = 0 then 'M' else 'F' end as gender,
    cast(c_custkey % 9999 as varchar) || ' ' || c_mktsegment || ' St' as street,
    'City ' || cast(n_nationkey as varchar) as city, n_name as state, lpad(cast(n_nationkey * 137 as varchar), 5, '0') as zip,
    cast(n_nationkey + 25 as varchar) || '.5' as lat, '-' || cast(n_nationkey + 70 as varchar) || '.25' as home_lon,
    cast(n_nationkey * 1000 + 500 as varchar) as city_pop, c_mktsegment as job,
    cast(n_nationkey + 25 as varchar) || '.75' as merch_lat, '-' || cast(n_nationkey + 70 as varchar) || '.125' as merch_long,
    case when l_orderkey % 200 = 0 then '1' else '0' end as is_fraud
  from lineitem join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey join part on l_partkey = p_partkey
    join supplier on l_suppkey = s_suppkey join nation on c_nationkey = n_nationkey) x
"""

STG = """
select trans_num as transaction_id,
       cast(trans_date_trans_time as timestamp) as transaction_ts,
       cast(cc_num as varchar) as card_number,
       merchant as merchant_name,
       category as merchant_category,
       cast(amt as decimal(12,2)) as amount,
       cust_first as first_name,
       cust_last as last_name,
       gender, street, city, state,
       cast(zip as varchar) as postal_code,
       cast(lat as double) as home_lat,
       cast(home_lon as double) as home_long,
       cast(city_pop as bigint) as city_population,
       job,
       cast(dob as date) as date_of_birth,
       cast(unix_time as bigint) as unix_time,
       cast(merch_lat as double) as merch_lat,
       cast(merch_long as double) as merch_long,
       cast(is_fraud as integer) = 1 as is_fraud
from raw
"""

_TOKEN = "'_dbt_utils_surrogate_key_null_'"


def skey(*cols: str) -> str:
    """md5 of '-'-joined text parts, NULL parts replaced by the token."""
    parts = [f"coalesce(cast({c} as varchar), {_TOKEN})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


CUST_NK = ("first_name", "last_name", "date_of_birth", "street", "city", "state", "postal_code")
_FIRST = "transaction_ts asc nulls last, transaction_id asc nulls first"

AS_OF = "2025-06-30"


def dim_customer(as_of: str = AS_OF) -> str:
    return f"""
select {skey(*CUST_NK)} as customer_key, first_name, last_name,
       first_name || ' ' || last_name as full_name, gender, date_of_birth,
       cast(date_diff('year', date_of_birth, date '{as_of}') as integer) as age,
       street, city, state, postal_code, home_lat, home_long, city_population, job
from (select *, row_number() over (partition by {", ".join(CUST_NK)} order by {_FIRST}) as rn
      from stg) d
where rn = 1
"""


DIM_ACCOUNT = f"""
select {skey("card_number")} as account_key, card_number,
       'XXXX-XXXX-XXXX-' || right(card_number, 4) as card_masked,
       case left(card_number, 1) when '4' then 'Visa' when '5' then 'Mastercard'
            when '3' then 'American Express' when '6' then 'Discover' else 'Other' end as card_brand
from (select *, row_number() over (partition by card_number order by {_FIRST}) as rn from stg) d
where rn = 1
"""

DIM_MERCHANT = f"""
select {skey("merchant_name", "merchant_category")} as merchant_key, merchant_name,
       merchant_category, replace(merchant_name, 'fraud_', '') as merchant_name_clean
from (select *, row_number() over (partition by merchant_name, merchant_category
                                   order by {_FIRST}) as rn from stg) d
where rn = 1
"""

# Whole years covering the staged timestamps.
DIM_DATE = """
select cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) as date_key,
       cast(d as date) as full_date,
       cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
       cast(month(d) as integer) as month, strftime(d, '%b') as month_name,
       cast(day(d) as integer) as day_of_month, cast(isodow(d) as integer) as day_of_week,
       strftime(d, '%a') as day_name, isodow(d) in (6, 7) as is_weekend
from (select cast(unnest(generate_series(
        cast(date_trunc('year', min(transaction_ts)) as date),
        cast(date_trunc('year', max(transaction_ts)) + interval 1 year - interval 1 day as date),
        interval 1 day)) as date) as d
      from stg) s
"""

FACT = f"""
select transaction_id,
       cast(year(transaction_ts) * 10000 + month(transaction_ts) * 100 + day(transaction_ts) as integer) as date_key,
       {skey(*CUST_NK)} as customer_key,
       {skey("card_number")} as account_key,
       {skey("merchant_name", "merchant_category")} as merchant_key,
       transaction_ts, amount, is_fraud, merch_lat, merch_long
from stg
"""


def with_star(body: str, as_of: str = AS_OF) -> str:
    """``body`` preceded by CTEs for raw, staging and the five marts."""
    return f"""with raw as ({RAW}),
stg as ({STG}),
stg_transactions as (select * from stg),
dim_customer as ({dim_customer(as_of)}),
dim_account as ({DIM_ACCOUNT}),
dim_merchant as ({DIM_MERCHANT}),
dim_date as ({DIM_DATE}),
fact_transactions as ({FACT})
{body}"""


def contents_sql(schemas) -> str:
    """Rows and content digest of each table (name -> StructType)."""
    def text(name: str, kind: str) -> str:
        if kind == "double":
            name = f"cast(round({name} * 1000000) as bigint)"
        elif kind.startswith("timestamp"):
            name = f"strftime({name}, '%Y-%m-%d %H:%M:%S')"
        return f"coalesce(cast({name} as varchar), '~')"

    return "\nunion all\n".join(
        f"select '{t}' as table_name, count(*) as n_rows, cast(coalesce(sum(cast('0x' || substr(md5("
        + " || '|' || ".join(text(f.name, f.dataType.simpleString()) for f in schema)
        + f"), 1, 8) as bigint)), 0) as bigint) as digest from {t}" for t, schema in schemas.items())


def quality_report_sql(suite, named=None) -> str:
    """One SELECT per check of ``suite``, unioned (failures, passed).
    ``named``: relations that stand in for models."""
    named = named or {}
    parts = []
    for i, c in enumerate(suite, start=1):
        model, to_model = named.get(c.model, c.model), named.get(c.to_model, c.to_model)
        if c.test == "not_null":
            f = f"(select count(*) from {model} where {c.column} is null)"
        elif c.test == "unique":
            f = (f"(select count(*) from (select {c.column} from {model} where {c.column} "
                 f"is not null group by {c.column} having count(*) > 1) u)")
        else:
            f = (f"(select count(*) from {model} ch where ch.{c.column} is not null and not "
                 f"exists (select 1 from {to_model} p where p.{c.to_column} = ch.{c.column}))")
        parts.append(f"select {i} as test_id, '{c.model}' as model, '{c.column}' as column_name, "
                     f"'{c.test}' as test, cast({f} as bigint) as failures")
    return ("select *, failures = 0 as passed from (\n" + "\nunion all\n".join(parts)
            + "\n) q order by test_id")
