"""

Every query reads the driver tables of ``sf_dir`` (through the RAW mapping of
FIXTURES.md) and derives staging and the star from them with Spark, so its
work grows with the tables.  ``oracle_sql`` states the same result in DuckDB
SQL over the same parquet views.  Sums are compared as decimal(38,2) and
averages as the library's own, in whole millionths (the engines type them
differently); everything else is compared as the library returns it.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import oracle as O
from starmart.functions import (
    card_brand,
    card_masked,
    covering_bounds,
    customer_age,
    date_key,
    full_name,
    merchant_clean,
    spine_from_bounds,
    surrogate_key,
)
from starmart.operators import marts, quality
from starmart.operators.dedupe import dedupe_first
from starmart.plans import adhoc, bi, questions
from starmart.plans.build import build_all
from starmart.plans.star import DIMS, star_from_tables
from starmart.sources import folder_sink
from starmart.sources.csv_ingest import ingest_csv, sample_n
from starmart.sources.fixtures import (
    AMOUNT_OF,
    CARD_OF,
    ID_OF,
    MERCHANT_OF,
    PERSON_OF,
    TIME_OF,
    raw_transactions,
    read_table,
)
from starmart.sources.tables import Warehouse, delete_folder, load_raw, scan_table, write_table
from starmart.schemas import MART_SCHEMAS
from starmart.session import scratch_dir
from starmart.sizing import checked_rows

# The training-data operators come as a removable part: their subpackage and
# the pipeline at the top.  Without them everything else works as before.
_llm = _pipeline = None
try:
    import starmart.llm.queries as _llm
    import corpus_pipeline as _pipeline
except ModuleNotFoundError as error:
    if not (error.name or "").startswith(("starmart.llm", "corpus_pipeline")):
        raise

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = O.AS_OF  # pinned "today" for customer ages

# Report parameters used by the registered filtered reports.
FILTER = bi.Filters(start="1996-03-01", end="1998-06-30",
                    categories=("Brand#12", "Brand#23", "Brand#7"))
EDGES = bi.Filters(start="1996-03-17", end="1998-06-11")  # days at both ends of whole months
EMPTY = bi.Filters(start="2030-01-01", end="2030-12-31")
SAMPLE_ROWS = 500
SQL_FILTER = ("f.transaction_ts >= timestamp '1996-03-01 00:00:00' "
              "and f.transaction_ts < timestamp '1998-07-01 00:00:00' "
              "and m.merchant_category in ('Brand#12', 'Brand#23', 'Brand#7')")
SQL_EDGES = ("f.transaction_ts >= timestamp '1996-03-17 00:00:00' "
             "and f.transaction_ts < timestamp '1998-06-12 00:00:00'")
SQL_EMPTY = ("f.transaction_ts >= timestamp '2030-01-01 00:00:00' "
             "and f.transaction_ts < timestamp '2031-01-01 00:00:00'")
FROM_JOIN = "fact_transactions f join dim_merchant m on f.merchant_key = m.merchant_key"
ADHOC_SQL = """select d.year, d.month, count(*) as txns,
       cast(sum(f.amount) as decimal(38,2)) as spend
from fact_transactions f join dim_date d on f.date_key = d.date_key
group by d.year, d.month"""
ADHOC_LIMIT_SQL = """select transaction_id, amount from fact_transactions
order by amount desc, transaction_id limit 1500"""
# Fixed calendar used to show a failing relationships test.
PARTIAL_CALENDAR = ("1995-01-01", "1998-01-01")
# Source-file header names of the RAW columns (index unnamed, SQL words).
SOURCE_HEADER = {"trans_index": "Unnamed: 0", "cust_first": "first",
                 "cust_last": "last", "home_lon": "long"}
# What reports read of the joined rows (see ``fixtures.py``).
MERCHANTS = (*MERCHANT_OF, *AMOUNT_OF)
MERCHANT_DAYS = (*MERCHANTS, *TIME_OF)
PERSONS = (*PERSON_OF, *ID_OF, *TIME_OF)  # the earliest row of each: by time, then id
CARDS = (*CARD_OF, *AMOUNT_OF)
# Plain CSV text is several times its rows' parquet: from so many rows on it is
# written, ingested and deleted part by part, in so many parts at most.
PART_ROWS, MAX_PARTS = 8_000_000, 4

def _star(spark: SparkSession, sf_dir: str, keep=False):
    return star_from_tables(spark, sf_dir, as_of=AS_OF, keep=keep)


def _checked_star(spark: SparkSession, sf_dir: str, *dims: str, keep=True):
    """The lazy star with the sizes of ``dims`` measured (one job each), so
    reports take the broadcast join-first plan where it fits."""
    s = _star(spark, sf_dir, keep=keep)
    sizes = {d: checked_rows(getattr(s, d)) for d in dims}
    return replace(s, rows={d: n for d, n in sizes.items() if n is not None})


def _money(name: str) -> F.Column:
    return F.col(name).cast("decimal(38,2)").alias(name)


def _micros(name: str) -> F.Column:
    """An average as the library returns it, in whole millionths."""
    return (F.col(name) * 1_000_000).cast("long").alias(f"{name}_micros")


# --- sources -----------------------------------------------------------------

def q_ingest_csv(spark, sf_dir):
    """RAW written as a source-layout CSV (gzip, a file a task), read
    back and normalised."""
    raw = raw_transactions(spark, sf_dir).withColumnsRenamed(SOURCE_HEADER)
    path = scratch_dir(spark, "csv")
    raw.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
    return ingest_csv(spark, path)


def q_sample_n(spark, sf_dir):
    return sample_n(raw_transactions(spark, sf_dir), SAMPLE_ROWS)


def q_load_raw(spark, sf_dir):
    return load_raw(Warehouse.fresh(spark), raw_transactions(spark, sf_dir))


def q_write_table(spark, sf_dir):
    """S8 + S9: staging written as a parquet table and scanned back."""
    path = scratch_dir(spark, "stg")
    write_table(_star(spark, sf_dir).stg_transactions, path, fmt="parquet")
    return scan_table(spark, path)


# --- staging and marts -------------------------------------------------------------

def q_stg_transactions(spark, sf_dir):
    return _star(spark, sf_dir).stg_transactions


def q_dim_customer(spark, sf_dir):
    return _star(spark, sf_dir).dim_customer


def q_dim_account(spark, sf_dir):
    return _star(spark, sf_dir).dim_account


def q_dim_merchant(spark, sf_dir):
    return _star(spark, sf_dir).dim_merchant


def q_dim_date(spark, sf_dir):
    return _star(spark, sf_dir).dim_date


def q_fact_transactions(spark, sf_dir):
    return _star(spark, sf_dir).fact_transactions


def q_dedupe_first(spark, sf_dir):
    """M6: each card's earliest staged transaction (whole row)."""
    return dedupe_first(_star(spark, sf_dir).stg_transactions, ["card_number"])


def q_surrogate_key(spark, sf_dir):
    """M7: keys with a NULL-able part, in both part orders."""
    stg = _star(spark, sf_dir).stg_transactions
    return stg.select("transaction_id",
                      surrogate_key("last_name", "card_number").alias("key_last_card"),
                      surrogate_key("card_number", "last_name").alias("key_card_last"))


def q_date_spine(spark, sf_dir):
    """M8: every day of the whole years the staged timestamps cover."""
    return spine_from_bounds(covering_bounds(_star(spark, sf_dir).stg_transactions))


def q_build_all(spark, sf_dir):
    """M9: full build into a fresh warehouse; the written marts' rows and
    content digests."""
    return build_all(spark, raw_transactions(spark, sf_dir), as_of=AS_OF).contents()


def q_build_report(spark, sf_dir):
    """M9: the quality report of a full build."""
    return build_all(spark, raw_transactions(spark, sf_dir), as_of=AS_OF).report


# --- scalar functions ------------------------------------------------------------

def _stg_cols(spark, sf_dir, *cols):
    return _star(spark, sf_dir).stg_transactions.select("transaction_id", *cols)


def q_customer_age(spark, sf_dir):
    return _stg_cols(spark, sf_dir, "date_of_birth",
                     customer_age("date_of_birth", AS_OF).alias("age"))


def q_card_masked(spark, sf_dir):
    return _stg_cols(spark, sf_dir, card_masked("card_number").alias("card_masked"))


def q_card_brand(spark, sf_dir):
    return _stg_cols(spark, sf_dir, card_brand("card_number").alias("card_brand"))


def q_merchant_clean(spark, sf_dir):
    return _stg_cols(spark, sf_dir, merchant_clean("merchant_name").alias("merchant_name_clean"))


def q_date_key(spark, sf_dir):
    return _stg_cols(spark, sf_dir, date_key("transaction_ts").alias("date_key"))


def q_full_name(spark, sf_dir):
    return _stg_cols(spark, sf_dir, full_name("first_name", "last_name").alias("full_name"))


# --- quality -------------------------------------------------------------------------

def q_not_null(spark, sf_dir):
    return quality.not_null(_star(spark, sf_dir).dim_customer, "last_name")


def q_unique(spark, sf_dir):
    return quality.unique(_star(spark, sf_dir).stg_transactions, "card_number")


def q_relationships(spark, sf_dir):
    s = _star(spark, sf_dir, keep=True)
    return quality.relationships(s.fact_transactions, "date_key",
                                 marts.dim_date(spark, *PARTIAL_CALENDAR), "date_key")


def q_quality_report(spark, sf_dir):
    return quality.quality_report(_star(spark, sf_dir, keep=True).tables())


# --- BI reports ------------------------------------------------------------------------

def q_filter_where(spark, sf_dir):
    s = _star(spark, sf_dir, keep=True)
    return bi.filter_where(s.fact_transactions, s.dim_merchant, FILTER)


def q_fact_merchant_join(spark, sf_dir):
    s = _star(spark, sf_dir, keep=True)
    return bi.fact_merchant_join(s.fact_transactions, s.dim_merchant)


def q_bounds(spark, sf_dir):
    return bi.bounds(_star(spark, sf_dir).fact_transactions)


def q_category_list(spark, sf_dir):
    return bi.category_list(_star(spark, sf_dir).dim_merchant)


def _kpis(spark, sf_dir, f):
    s = _star(spark, sf_dir, keep=True)
    k = bi.kpis(s.fact_transactions, s.dim_merchant, f)
    return k.select(_money("total_spend"), "txns",
                    _micros("avg_txn"), "customers")


def q_kpis(spark, sf_dir):
    return _kpis(spark, sf_dir, bi.Filters())


def q_kpis_filtered(spark, sf_dir):
    return _kpis(spark, sf_dir, FILTER)


def q_kpis_empty(spark, sf_dir):
    return _kpis(spark, sf_dir, EMPTY)


def q_spend_by_category(spark, sf_dir):
    s = _star(spark, sf_dir, keep=MERCHANTS)
    return bi.spend_by_category(s.fact_transactions, s.dim_merchant).select(
        "category", _money("spend"))


def q_spend_by_category_filtered(spark, sf_dir):
    s = _star(spark, sf_dir, keep=MERCHANT_DAYS)
    return bi.spend_by_category(s.fact_transactions, s.dim_merchant, FILTER).select(
        "category", _money("spend"))


def q_spend_by_month(spark, sf_dir):
    s = _star(spark, sf_dir, keep=MERCHANT_DAYS)
    return bi.spend_by_month(s.fact_transactions, s.dim_merchant, FILTER).select(
        "month", _money("spend"))


def q_top_merchants(spark, sf_dir):
    s = _star(spark, sf_dir, keep=MERCHANTS)
    return bi.top_merchants(s.fact_transactions, s.dim_merchant).select(
        "merchant", _money("spend"), "txns")


def q_spend_top10_stg(spark, sf_dir):
    return bi.spend_top10_stg(_star(spark, sf_dir).stg_transactions).select(
        "merchant_category", _money("spend"))


# --- questions ----------------------------------------------------------------------

def q_top5_categories_spend(spark, sf_dir):
    s = _star(spark, sf_dir, keep=MERCHANTS)
    return questions.top5_categories_spend(s.fact_transactions, s.dim_merchant).select(
        "merchant_category", _money("total_spend"))


def q_spend_by_brand(spark, sf_dir):
    s = _star(spark, sf_dir, keep=CARDS)
    return questions.spend_by_brand(s.fact_transactions, s.dim_account).select(
        "card_brand", _money("total_spend"))


def q_top5_states_avg(spark, sf_dir):
    s = _star(spark, sf_dir, keep=PERSONS)
    r = questions.top5_states_avg(s.fact_transactions, s.dim_customer)
    return r.select("state", _micros("avg_amount"))


def q_weekend_vs_weekday(spark, sf_dir):
    s = _star(spark, sf_dir, keep=TIME_OF)
    return questions.weekend_vs_weekday(s.fact_transactions, s.dim_date)


def q_top5_states_spend(spark, sf_dir):
    s = _star(spark, sf_dir, keep=PERSONS)
    return questions.top5_states_spend(s.fact_transactions, s.dim_customer).select(
        "state", _money("total_spend"))


def q_guarded_select(spark, sf_dir):
    adhoc.register_views(_star(spark, sf_dir, keep=True).tables())
    return adhoc.run_select(spark, ADHOC_SQL)


# --- the same reports on the broadcast join-first plan -------------------------

def q_spend_by_category_checked(spark, sf_dir):
    s = _checked_star(spark, sf_dir, "dim_merchant", keep=MERCHANT_DAYS)
    return bi.spend_by_category(s.fact_transactions, s.dim_merchant, FILTER,
                                dim_rows=s.dim_rows("dim_merchant")).select(
        "category", _money("spend"))


def q_spend_by_month_checked(spark, sf_dir):
    s = _checked_star(spark, sf_dir, "dim_merchant", keep=MERCHANT_DAYS)
    return bi.spend_by_month(s.fact_transactions, s.dim_merchant, FILTER,
                             dim_rows=s.dim_rows("dim_merchant")).select(
        "month", _money("spend"))


def q_top_merchants_checked(spark, sf_dir):
    s = _checked_star(spark, sf_dir, "dim_merchant", keep=MERCHANTS)
    return bi.top_merchants(s.fact_transactions, s.dim_merchant,
                            dim_rows=s.dim_rows("dim_merchant")).select(
        "merchant", _money("spend"), "txns")


def q_kpis_filtered_checked(spark, sf_dir):
    s = _checked_star(spark, sf_dir, "dim_merchant")
    k = bi.kpis(s.fact_transactions, s.dim_merchant, FILTER,
                dim_rows=s.dim_rows("dim_merchant"))
    return k.select(_money("total_spend"), "txns",
                    _micros("avg_txn"), "customers")


def q_spend_by_brand_checked(spark, sf_dir):
    s = _checked_star(spark, sf_dir, "dim_account", keep=CARDS)
    return questions.spend_by_brand(s.fact_transactions, s.dim_account,
                                    dim_rows=s.dim_rows("dim_account")).select(
        "card_brand", _money("total_spend"))


def q_top5_states_avg_checked(spark, sf_dir):
    s = _checked_star(spark, sf_dir, "dim_customer", keep=PERSONS)
    r = questions.top5_states_avg(s.fact_transactions, s.dim_customer,
                                  dim_rows=s.dim_rows("dim_customer"))
    return r.select("state", _micros("avg_amount"))


def q_weekend_vs_weekday_checked(spark, sf_dir):
    s = _checked_star(spark, sf_dir, "dim_date", keep=TIME_OF)
    return questions.weekend_vs_weekday(s.fact_transactions, s.dim_date,
                                        dim_rows=s.dim_rows("dim_date"))


def q_relationships_checked(spark, sf_dir):
    """Q3 rows against the calendar with its row count checked (broadcast
    anti join) -- the same rows as the orphan-keys-first plan."""
    cal = marts.dim_date(spark, *PARTIAL_CALENDAR)
    return quality.relationships(_star(spark, sf_dir, keep=True).fact_transactions, "date_key",
                                 cal, "date_key", parent_rows=checked_rows(cal))


def q_quality_report_checked(spark, sf_dir):
    s = _checked_star(spark, sf_dir, *DIMS)
    return quality.quality_report(s.tables(), rows=s.rows)


# --- a star with faults, so that every kind of test has something to count ------

def _faulty(spark, sf_dir, *dims):
    """Doubled fraud rows and merchants, NULL amounts and customers, a calendar
    that ends early, and accounts of one brand missing."""
    s = _checked_star(spark, sf_dir, *dims)
    t = s.tables()
    fact, merchant = t["fact_transactions"], t["dim_merchant"]
    doubled = fact.unionByName(fact.filter("is_fraud"))
    t["fact_transactions"] = doubled.withColumn(
        "amount", F.when(F.col("date_key") % 97 != 0, F.col("amount")))
    t["dim_merchant"] = merchant.unionByName(merchant.filter("merchant_category = 'Brand#12'"))
    t["dim_customer"] = t["dim_customer"].withColumn(
        "customer_key", F.when(F.col("state") != "NATION_3", F.col("customer_key")))
    t["dim_account"] = t["dim_account"].filter("card_brand <> 'Visa'")
    t["dim_date"] = marts.dim_date(spark, *PARTIAL_CALENDAR)
    return t, s.rows


def q_quality_report_faults(spark, sf_dir):
    t, _ = _faulty(spark, sf_dir)
    return quality.quality_report(t)


def q_quality_report_faults_checked(spark, sf_dir):
    t, rows = _faulty(spark, sf_dir, *DIMS)
    return quality.quality_report(t, rows=rows)


def q_top5_states_avg_nulls(spark, sf_dir):
    """A3 where amounts are missing: the average is over those that are there."""
    t, _ = _faulty(spark, sf_dir)
    s = _star(spark, sf_dir, keep=True)
    return questions.top5_states_avg(t["fact_transactions"], s.dim_customer).select(
        "state", _micros("avg_amount"))


def q_ingest_csv_quoted(spark, sf_dir):
    """Line breaks and quotes inside quoted fields, files read in many tasks."""
    rows = read_table(spark, sf_dir, "lineitem").count()
    parts = max(1, min(MAX_PARTS, -(-rows // PART_ROWS)))
    raw = raw_transactions(spark, sf_dir, keep=parts > 1)
    return quoted_csv(raw.withColumn("job", F.concat("job", F.lit('\n"'), "city", F.lit('",\n.'))), parts)


def quoted_csv(raw: DataFrame, parts: int) -> DataFrame:
    """``raw`` written as plain CSV (a file that splits can't be gzip) and
    ingested, a part of the rows at a time: each part but the last is kept as
    the parquet of its ingested rows, and its CSV is deleted, before the next
    is written.  ``raw`` is scanned once a part."""
    spark, done = raw.sparkSession, []
    part = F.pmod(F.xxhash64("trans_index"), F.lit(parts))
    for k in range(parts):
        path = scratch_dir(spark, "quoted")
        rows = raw.filter(part == k) if parts > 1 else raw
        rows.withColumnsRenamed(SOURCE_HEADER).write.option("header", True).option("escape", '"').csv(path)
        found = ingest_csv(spark, path, multi_line="split")
        if k < parts - 1:
            kept = scratch_dir(spark, "ingested")
            write_table(found, kept)
            delete_folder(spark, path)
            found = scan_table(spark, kept)
        done.append(found)
    return reduce(DataFrame.unionByName, done)


def q_consecutive_index(spark, sf_dir):
    """Files without an index column, numbered 0 to n - 1."""
    path = scratch_dir(spark, "unnumbered")
    raw_transactions(spark, sf_dir).drop("trans_index").withColumnsRenamed(SOURCE_HEADER).write.option(
        "header", True).option("escape", '"').csv(path)
    at = F.col("trans_index").cast("long")
    return ingest_csv(spark, path, consecutive=True).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(at).alias("first_index"), F.max(at).alias("last_index"),
        F.count_distinct(at).alias("n_indexes"))


def _built(spark, sf_dir):
    return build_all(spark, raw_transactions(spark, sf_dir), as_of=AS_OF).star


def q_bounds_written(spark, sf_dir):
    """B3 over a written fact: its first and last month folder."""
    return bi.bounds(_built(spark, sf_dir).facts())


def q_top5_states_spend_kept(spark, sf_dir):
    """A5 from the customers' totals, bucket by bucket with the customers."""
    s = build_all(spark, raw_transactions(spark, sf_dir), as_of=AS_OF, customer_buckets=16).star
    return questions.top5_states_spend(s.fact_transactions, s.dim_customer, kept=s.customers).select(
        "state", _money("total_spend"))


def q_spend_by_month_cube(spark, sf_dir):
    """B7 from the month cube, with days at both edges."""
    s = _built(spark, sf_dir)
    return bi.spend_by_month(s.facts(), s.dim_merchant, EDGES, dim_rows=s.dim_rows("dim_merchant"),
                             cube=s.cube).select("month", _money("spend"))


def q_spend_by_category_cube(spark, sf_dir):
    """B6 from the month cube."""
    s = _built(spark, sf_dir)
    return bi.spend_by_category(s.facts(), s.dim_merchant, FILTER, dim_rows=s.dim_rows("dim_merchant"),
                                cube=s.cube).select("category", _money("spend"))


def q_write_external(spark, sf_dir):
    """Staging written through the two-phase sink and read back."""
    folder_sink.register(spark)
    stg = _star(spark, sf_dir).stg_transactions
    path = scratch_dir(spark, "external")
    write_table(stg, path, fmt=folder_sink.FORMAT, as_path=True)
    return folder_sink.read_folder(spark, path, stg.schema)


def q_guarded_select_limit(spark, sf_dir):
    """An outer LIMIT above the cap is the query's own."""
    adhoc.register_views(_star(spark, sf_dir, keep=True).tables())
    return adhoc.run_select(spark, ADHOC_LIMIT_SQL)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_csv": q_ingest_csv,
    "sample_n": q_sample_n,
    "load_raw": q_load_raw,
    "write_table": q_write_table,
    "stg_transactions": q_stg_transactions,
    "dim_customer": q_dim_customer,
    "dim_account": q_dim_account,
    "dim_merchant": q_dim_merchant,
    "dim_date": q_dim_date,
    "fact_transactions": q_fact_transactions,
    "dedupe_first": q_dedupe_first,
    "surrogate_key": q_surrogate_key,
    "date_spine": q_date_spine,
    "build_all": q_build_all,
    "build_report": q_build_report,
    "customer_age": q_customer_age,
    "card_masked": q_card_masked,
    "card_brand": q_card_brand,
    "merchant_clean": q_merchant_clean,
    "date_key": q_date_key,
    "full_name": q_full_name,
    "not_null": q_not_null,
    "unique": q_unique,
    "relationships": q_relationships,
    "quality_report": q_quality_report,
    "filter_where": q_filter_where,
    "fact_merchant_join": q_fact_merchant_join,
    "bounds": q_bounds,
    "category_list": q_category_list,
    "kpis": q_kpis,
    "kpis_filtered": q_kpis_filtered,
    "kpis_empty": q_kpis_empty,
    "spend_by_category": q_spend_by_category,
    "spend_by_category_filtered": q_spend_by_category_filtered,
    "spend_by_month": q_spend_by_month,
    "top_merchants": q_top_merchants,
    "spend_top10_stg": q_spend_top10_stg,
    "top5_categories_spend": q_top5_categories_spend,
    "spend_by_brand": q_spend_by_brand,
    "top5_states_avg": q_top5_states_avg,
    "weekend_vs_weekday": q_weekend_vs_weekday,
    "top5_states_spend": q_top5_states_spend,
    "guarded_select": q_guarded_select,
    "spend_by_category_checked": q_spend_by_category_checked,
    "spend_by_month_checked": q_spend_by_month_checked,
    "top_merchants_checked": q_top_merchants_checked,
    "kpis_filtered_checked": q_kpis_filtered_checked,
    "spend_by_brand_checked": q_spend_by_brand_checked,
    "top5_states_avg_checked": q_top5_states_avg_checked,
    "weekend_vs_weekday_checked": q_weekend_vs_weekday_checked,
    "quality_report_checked": q_quality_report_checked,
    "quality_report_faults": q_quality_report_faults,
    "quality_report_faults_checked": q_quality_report_faults_checked,
    "guarded_select_limit": q_guarded_select_limit,
    "relationships_checked": q_relationships_checked,
    "top5_states_avg_nulls": q_top5_states_avg_nulls,
    "ingest_csv_quoted": q_ingest_csv_quoted,
    "consecutive_index": q_consecutive_index,
    "bounds_written": q_bounds_written,
    "top5_states_spend_kept": q_top5_states_spend_kept,
    "spend_by_month_cube": q_spend_by_month_cube,
    "spend_by_category_cube": q_spend_by_category_cube,
    "write_external": q_write_external,
}

W = O.with_star
_KPI_SQL = """select cast(coalesce(sum(f.amount), 0) as decimal(38,2)) as total_spend,
       count(*) as txns,
       {a} as avg_txn_micros,
       count(distinct f.customer_key) as customers
from {j} where {w}"""
# The average in millionths, half up, from cents and count.
_MICROS = ("cast(case when count(f.amount) = 0 then 0 else (2 * cast(sum(f.amount) * 100 as hugeint) * 10000 "
           "+ count(f.amount)) // (2 * count(f.amount)) end as bigint)")
_FAULTS = """, f_fact as (select * exclude (amount), case when date_key % 97 <> 0 then amount end as amount
  from (select * from fact_transactions union all select * from fact_transactions where is_fraud) x),
f_merchant as (select * from dim_merchant union all
  select * from dim_merchant where merchant_category = 'Brand#12'),
f_customer as (select * exclude (customer_key),
  case when state <> 'NATION_3' then customer_key end as customer_key from dim_customer),
f_account as (select * from dim_account where card_brand <> 'Visa'),
f_date as ({keys})
"""
_FAULTY = {"fact_transactions": "f_fact", "dim_merchant": "f_merchant", "dim_customer": "f_customer",
           "dim_account": "f_account", "dim_date": "f_date"}
_PARTIAL_KEYS = (f"select cast(strftime(d, '%Y%m%d') as integer) as date_key from "
                 f"generate_series(date '{PARTIAL_CALENDAR[0]}', date '{PARTIAL_CALENDAR[1]}'"
                 f" - interval 1 day, interval 1 day) t(d)")
_FACT_MERCHANT = ("select f.*, m.merchant_category, m.merchant_name_clean from " + FROM_JOIN)

_ORACLE: dict[str, str] = {
    "ingest_csv": W("select * from raw"),
    "sample_n": W(f"select * from raw order by md5(trans_num || '42') limit {SAMPLE_ROWS}"),
    "load_raw": W("select * from raw"),
    "write_table": W("select * from stg"),
    "stg_transactions": W("select * from stg"),
    "dim_customer": W("select * from dim_customer"),
    "dim_account": W("select * from dim_account"),
    "dim_merchant": W("select * from dim_merchant"),
    "dim_date": W("select * from dim_date"),
    "fact_transactions": W("select * from fact_transactions"),
    "dedupe_first": W("select * exclude (rn) from (select *, row_number() over (partition by "
                      "card_number order by transaction_ts asc nulls last, transaction_id asc "
                      "nulls first) as rn from stg) d where rn = 1"),
    "surrogate_key": W(f"select transaction_id, {O.skey('last_name', 'card_number')} as "
                       f"key_last_card, {O.skey('card_number', 'last_name')} as key_card_last "
                       f"from stg"),
    "date_spine": W("select full_date as date_day from dim_date"),
    "build_all": W(O.contents_sql(MART_SCHEMAS)),
    "build_report": W(O.quality_report_sql(quality.SUITE)),
    "customer_age": W(f"select transaction_id, date_of_birth, cast(date_diff('year', "
                      f"date_of_birth, date '{AS_OF}') as integer) as age from stg"),
    "card_masked": W("select transaction_id, 'XXXX-XXXX-XXXX-' || right(card_number, 4) "
                     "as card_masked from stg"),
    "card_brand": W("select transaction_id, case left(card_number, 1) when '4' then 'Visa' "
                    "when '5' then 'Mastercard' when '3' then 'American Express' when '6' "
                    "then 'Discover' else 'Other' end as card_brand from stg"),
    "merchant_clean": W("select transaction_id, replace(merchant_name, 'fraud_', '') as "
                        "merchant_name_clean from stg"),
    "date_key": W("select transaction_id, cast(strftime(transaction_ts, '%Y%m%d') as integer) "
                  "as date_key from stg"),
    "full_name": W("select transaction_id, first_name || ' ' || last_name as full_name "
                   "from stg"),
    "not_null": W("select * from dim_customer where last_name is null"),
    "unique": W("select card_number, count(*) as n_records from stg where card_number is "
                "not null group by card_number having count(*) > 1"),
    "relationships": W(f"select * from fact_transactions where date_key is not null and "
                       f"date_key not in ({_PARTIAL_KEYS})"),
    "quality_report": W(O.quality_report_sql(quality.SUITE)),
    "quality_report_faults": W(_FAULTS.format(keys=_PARTIAL_KEYS)
                               + O.quality_report_sql(quality.SUITE, _FAULTY)),
    "filter_where": W(f"select f.* from {FROM_JOIN} where {SQL_FILTER}"),
    "fact_merchant_join": W(_FACT_MERCHANT),
    "bounds": W("select cast(min(transaction_ts) as date) as min_d, "
                "cast(max(transaction_ts) as date) as max_d from fact_transactions"),
    "category_list": W("select distinct merchant_category from dim_merchant order by 1"),
    "kpis": W(_KPI_SQL.format(a=_MICROS, j=FROM_JOIN, w="true")),
    "kpis_filtered": W(_KPI_SQL.format(a=_MICROS, j=FROM_JOIN, w=SQL_FILTER)),
    "kpis_empty": W(_KPI_SQL.format(a=_MICROS, j=FROM_JOIN, w=SQL_EMPTY)),
    "spend_by_category": W(f"select m.merchant_category as category, cast(sum(f.amount) as "
                           f"decimal(38,2)) as spend from {FROM_JOIN} group by 1 "
                           f"order by spend desc, category"),
    "spend_by_category_filtered": W(f"select m.merchant_category as category, "
                                    f"cast(sum(f.amount) as decimal(38,2)) as spend from "
                                    f"{FROM_JOIN} where {SQL_FILTER} group by 1 "
                                    f"order by spend desc, category"),
    "spend_by_month": W(f"select date_trunc('month', f.transaction_ts) as month, "
                        f"cast(sum(f.amount) as decimal(38,2)) as spend from {FROM_JOIN} "
                        f"where {SQL_FILTER} group by 1 order by 1"),
    "top_merchants": W(f"select m.merchant_name_clean as merchant, cast(sum(f.amount) as "
                       f"decimal(38,2)) as spend, count(*) as txns from {FROM_JOIN} "
                       f"group by 1 order by spend desc, merchant limit 10"),
    "spend_top10_stg": W("select merchant_category, cast(round(sum(amount), 2) as "
                         "decimal(38,2)) as spend from stg group by 1 "
                         "order by spend desc, merchant_category limit 10"),
    "top5_categories_spend": W(f"select m.merchant_category, cast(sum(f.amount) as "
                               f"decimal(38,2)) as total_spend from {FROM_JOIN} group by 1 "
                               f"order by total_spend desc, merchant_category limit 5"),
    "spend_by_brand": W("select a.card_brand, cast(sum(f.amount) as decimal(38,2)) as "
                        "total_spend from fact_transactions f join dim_account a on "
                        "f.account_key = a.account_key group by 1 order by total_spend desc"),
    "top5_states_avg": W(f"select c.state, {_MICROS} as avg_amount_micros from  fact_transactions f join dim_customer c on "
                         "f.customer_key = c.customer_key group by 1 "
                         "order by sum(f.amount) / count(*) desc, state limit 5"),
    "weekend_vs_weekday": W("select d.is_weekend, count(*) as txn_count from "
                            "fact_transactions f join dim_date d on f.date_key = d.date_key "
                            "group by 1 order by 1"),
    "top5_states_spend": W("select c.state, cast(sum(f.amount) as decimal(38,2)) as "
                           "total_spend from fact_transactions f join dim_customer c on "
                           "f.customer_key = c.customer_key group by 1 "
                           "order by total_spend desc, state limit 5"),
    "top5_states_avg_nulls": W(_FAULTS.format(keys=_PARTIAL_KEYS)
                               + f"select c.state, {_MICROS} as avg_amount_micros from f_fact f join dim_customer c "
                                 "on f.customer_key = c.customer_key group by 1 "
                                 "order by avg(f.amount) desc, state limit 5"),
    "ingest_csv_quoted": W("select * replace (job || chr(10) || '\"' || city || '\",' || chr(10) || '.' as job) from raw"),
    "consecutive_index": W("select count(*) as n_rows, 0::bigint as first_index, count(*) - 1 as last_index, "
                           "count(*) as n_indexes from raw"),
    "bounds_written": W("select cast(min(transaction_ts) as date) as min_d, "
                        "cast(max(transaction_ts) as date) as max_d from fact_transactions"),
    "spend_by_month_cube": W(f"select date_trunc('month', f.transaction_ts) as month, cast(sum(f.amount) as "
                             f"decimal(38,2)) as spend from {FROM_JOIN} where {SQL_EDGES} group by 1 order by 1"),
    "spend_by_category_cube": W(f"select m.merchant_category as category, cast(sum(f.amount) as decimal(38,2)) as "
                                f"spend from {FROM_JOIN} where {SQL_FILTER} group by 1 order by spend desc, category"),
    "write_external": W("select * from stg"),
    "guarded_select": W(ADHOC_SQL),
    "guarded_select_limit": W(ADHOC_LIMIT_SQL),
}
# Other plans state the same results as their twins.
_CHECKED_TWINS = {
    "spend_by_category_checked": "spend_by_category_filtered",
    "spend_by_month_checked": "spend_by_month",
    "top_merchants_checked": "top_merchants",
    "kpis_filtered_checked": "kpis_filtered",
    "spend_by_brand_checked": "spend_by_brand",
    "top5_states_avg_checked": "top5_states_avg",
    "weekend_vs_weekday_checked": "weekend_vs_weekday",
    "quality_report_checked": "quality_report",
    "quality_report_faults_checked": "quality_report_faults",
    "relationships_checked": "relationships",
    "top5_states_spend_kept": "top5_states_spend",
}
for _name, _twin in _CHECKED_TWINS.items():
    _ORACLE[_name] = _ORACLE[_twin]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: spend by merchant category, raw tables to answer (sf0.001)."""
    return q_spend_by_category(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return (dict(_QUERIES) | (_llm.QUERIES if _llm else {})
            | ({"pipeline": _pipeline.run} if _pipeline else {}))


def oracle_sql() -> dict[str, str]:
    piped = _pipeline.ORACLE_SQL if _pipeline else None
    return (dict(_ORACLE) | (_llm.ORACLE_SQL if _llm else {})
            | ({"pipeline": piped} if piped else {}))
