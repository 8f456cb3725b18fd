"""BI reports over the star (B1-B9), parameterised by date range and categories.

Scale notes.  The fact is the only table that grows without bound.  Reports
that group by a dimension attribute go through ``rollup``: broadcast-and-join
first when the dimension's checked row count is small, else pre-aggregate
the fact per key before joining.  ``dim_rows`` is that checked count (from a
written table, see ``Star.rows``); ``None`` (unknown) takes the pre-aggregate
plan, which is safe at any size.
"""
from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.constants import DIGESTS, FACT_MONTH
from starmart.functions.keys import packed, unpacked
from starmart.operators.bloom import bit_filter
from starmart.plans.cube import month_start as cube_month_start
from starmart.plans.cube import selected
from starmart.plans.rollup import SPEND, TXNS, fits_broadcast, rollup


@dataclass(frozen=True)
class Filters:
    """Date range (whole end day included) and merchant categories.

    ``None`` bounds mean unbounded on that side (the reference falls back to
    the data's own bounds, which selects the same rows).  An empty category
    list means every category.
    """

    start: dt.date | str | None = None
    end: dt.date | str | None = None
    categories: Sequence[str] = field(default_factory=tuple)


def _date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def ts_predicate(f: Filters, ts: str = "transaction_ts") -> Column:
    """``start <= ts < end + 1 day`` as literals on the stored NTZ column, so
    the bounds reach the parquet scan as pushed filters."""
    cond = F.lit(True)
    if f.start is not None:
        cond = cond & (F.col(ts) >= F.lit(_date(f.start)).cast("timestamp_ntz"))
    if f.end is not None:
        nxt = _date(f.end) + dt.timedelta(days=1)
        cond = cond & (F.col(ts) < F.lit(nxt).cast("timestamp_ntz"))
    return cond


def category_predicate(f: Filters, col: str = "merchant_category") -> Column:
    """``col IN (categories)``; always true for an empty list.  Values are
    compared as literals, so quotes in a category need no escaping."""
    if not f.categories:
        return F.lit(True)
    return F.col(col).isin(list(f.categories))


def month_predicate(f: Filters) -> Column:
    """The months the date range touches, on the stored fact's partition
    column: other folders are never listed or opened."""
    cond = F.lit(True)
    for bound, compare in ((f.start, "__ge__"), (f.end, "__le__")):
        if bound is not None:
            d = _date(bound)
            cond = cond & getattr(F.col(FACT_MONTH), compare)(F.lit(d.year * 100 + d.month))
    return cond


def _fact(fact: DataFrame, f: Filters) -> DataFrame:
    """The fact inside the date range, without the partition column."""
    if f.start or f.end:
        if FACT_MONTH in fact.columns:
            fact = fact.filter(month_predicate(f))
        fact = fact.filter(ts_predicate(f))
    return fact.drop(FACT_MONTH)


def _merchants(dim_merchant: DataFrame, f: Filters, *cols: str) -> DataFrame:
    dm = dim_merchant.filter(category_predicate(f)) if f.categories else dim_merchant
    return dm.select("merchant_key", *cols)


# --- B1, B2 ----------------------------------------------------------------

def filter_where(fact: DataFrame, dim_merchant: DataFrame, f: Filters,
                 dim_rows: int | None = None) -> DataFrame:
    """B1: fact rows inside the filters (joined to the merchant for the
    category test)."""
    return fact_merchant_join(fact, dim_merchant, f, dim_rows).drop(
        "merchant_category", "merchant_name_clean")


def fact_merchant_join(fact: DataFrame, dim_merchant: DataFrame,
                       f: Filters | None = None, dim_rows: int | None = None) -> DataFrame:
    """B2: fact ⋈ dim_merchant on merchant_key (inner), with the merchant's
    category and display name.  Broadcast when the checked row count fits.
    Otherwise Spark sizes it (AQE may still broadcast it from measured shuffle
    output, or splits a skewed partition of the shuffle join); with categories
    a bit filter of the selected merchants' keys, of bounded size, is tested
    by the fact's scan first, so only rows that may match are shuffled.  Their
    digests are exchanged as the bytes they stand for."""
    f = f or Filters()
    dm = _merchants(dim_merchant, f, "merchant_category", "merchant_name_clean")
    rows = _fact(fact, f)
    if fits_broadcast(dim_rows):
        return rows.join(F.broadcast(dm), "merchant_key")
    if f.categories:
        rows = bit_filter(dm, "merchant_key").passed(rows, F.col("merchant_key")).filter("__may").drop("__may")
    digests = [c for c, t in rows.dtypes if c in DIGESTS and t == "string"]
    met = rows.withColumns({c: packed(c) for c in digests}).join(
        dm.withColumn("merchant_key", packed("merchant_key")), "merchant_key")
    return met.withColumns({c: unpacked(c) for c in digests})


# --- B3, B4 ----------------------------------------------------------------

def month_range(fact: DataFrame) -> tuple[int, int] | None:
    """First and last month with rows of a fact stored by month, from the
    names of its folders (no file is opened); ``None`` without one."""
    months = [int(m[1]) for m in (re.search(rf"/{FACT_MONTH}=(\d+)/", f) for f in fact.inputFiles()) if m]
    return (min(months), max(months)) if months else None


def bounds(fact: DataFrame) -> DataFrame:
    """First and last transaction date (unfiltered).  Of a fact stored by
    month only the first and the last folder are read."""
    if FACT_MONTH in fact.columns and (ends := month_range(fact)):
        fact = fact.filter(F.col(FACT_MONTH).isin(*ends))
    return fact.agg(F.min("transaction_ts").cast("date").alias("min_d"),
                    F.max("transaction_ts").cast("date").alias("max_d"))


def category_list(dim_merchant: DataFrame) -> DataFrame:
    """Distinct merchant categories, ascending (NULL last)."""
    return (dim_merchant.select("merchant_category").distinct()
            .orderBy(F.col("merchant_category").asc_nulls_last()))


# --- B5 --------------------------------------------------------------------

def kpis(fact: DataFrame, dim_merchant: DataFrame, f: Filters | None = None,
         approx_customers: bool = False, rsd: float = 0.01,
         dim_rows: int | None = None) -> DataFrame:
    """Total spend, transactions, average amount, distinct customers.

    Always exactly one row (zeros on an empty selection); types as Spark's
    ``sum``/``avg`` over decimal(12,2) give them: decimal(22,2) and
    decimal(16,6).  The distinct count is exact; ``approx_customers`` opts
    in to a HyperLogLog estimate (relative error about ``rsd``): on the
    pre-aggregating plan one sketch for each merchant, merged after the join,
    so no (merchant, customer) pair is shuffled.

    Plans, by the merchant dimension's checked size: a small one is
    broadcast and the fact rows are joined map-side.  Otherwise the fact is
    first reduced to one row per (merchant, customer) -- partial + final, so
    a hot merchant or customer collapses map-side -- and only those rows are
    joined; the distinct count needs nothing finer than the customer.
    """
    f = f or Filters()
    customers = (F.approx_count_distinct("customer_key", rsd) if approx_customers
                 else F.count_distinct("customer_key"))
    if fits_broadcast(dim_rows):
        j = fact_merchant_join(fact, dim_merchant, f, dim_rows)
        return j.agg(
            F.coalesce(F.sum("amount"), F.lit(0)).alias("total_spend"),
            F.count(F.lit(1)).alias("txns"),
            F.coalesce(F.avg("amount"), F.lit(0)).alias("avg_txn"),
            customers.alias("customers"),
        )
    sums = (F.sum("amount").alias(SPEND), F.count(F.lit(1)).alias(TXNS), F.count("amount").alias("_amounts"))
    if approx_customers:
        size = min(21, max(4, math.ceil(math.log2((1.04 / rsd) ** 2))))
        pairs = _fact(fact, f).groupBy("merchant_key").agg(
            *sums, F.hll_sketch_agg("customer_key", F.lit(size)).alias("_sketch"))
        customers = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("_sketch")), F.lit(0))
    else:
        pairs = _fact(fact, f).groupBy("merchant_key", "customer_key").agg(*sums)
    j = pairs.join(_merchants(dim_merchant, f), "merchant_key")
    out = j.agg(F.sum(SPEND).cast("decimal(22,2)").alias("s"),
                F.sum(TXNS).alias("n"), F.sum("_amounts").alias("m"),
                customers.cast("long").alias("customers"))
    # avg as Spark computes it: decimal sum / count of non-NULL amounts as
    # decimal(20,0), to (16,6)
    avg = (F.col("s") / F.col("m").cast("decimal(20,0)")).cast("decimal(16,6)")
    return out.select(
        F.coalesce(F.col("s"), F.lit(0)).alias("total_spend"),
        F.coalesce(F.col("n"), F.lit(0)).alias("txns"),
        F.coalesce(avg, F.lit(0)).alias("avg_txn"),
        "customers",
    )


# --- B6, B7, B8 --------------------------------------------------------------

def _by_merchant(fact: DataFrame, dim_merchant: DataFrame, f: Filters, by: list[str],
                 dim_rows: int | None, month: bool = False, cube: DataFrame | None = None) -> DataFrame:
    """Totals by merchant attributes (and month).  With ``cube`` whole months
    come from the month cube, and only days at the edges from the fact."""
    dim = _merchants(dim_merchant, f, *by)
    if cube is None:
        return rollup(_fact(fact, f), dim, "merchant_key", by, dim_rows, {"month": month_start()} if month else {})
    rows = selected(cube, f.start and _date(f.start), f.end and _date(f.end),
                    lambda a, b: _fact(fact, Filters(a, b)))
    extra = ["month"] if month else []
    per_key = (rows.withColumn("month", cube_month_start()).groupBy("merchant_key", *extra)
               .agg(F.sum(SPEND).alias(SPEND), F.sum(TXNS).alias(TXNS)))
    met = per_key.join(F.broadcast(dim) if fits_broadcast(dim_rows) else dim, "merchant_key")
    return (met.groupBy(*by, *extra).agg(F.sum(SPEND).cast("decimal(22,2)").alias(SPEND), F.sum(TXNS).alias(TXNS)))


def spend_by_category(fact: DataFrame, dim_merchant: DataFrame, f: Filters | None = None,
                      dim_rows: int | None = None, cube: DataFrame | None = None) -> DataFrame:
    """Spend per category, highest first (ties: category ascending)."""
    r = _by_merchant(fact, dim_merchant, f or Filters(), ["merchant_category"], dim_rows, cube=cube)
    return (r.select(F.col("merchant_category").alias("category"), F.col(SPEND).alias("spend"))
            .orderBy(F.col("spend").desc_nulls_first(), F.col("category").asc_nulls_last()))


def month_start(ts: str | Column = "transaction_ts") -> Column:
    """First instant of the month, as a zone-free timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(F.to_date(c), "month").cast("timestamp_ntz")


def spend_by_month(fact: DataFrame, dim_merchant: DataFrame, f: Filters | None = None,
                   dim_rows: int | None = None, cube: DataFrame | None = None) -> DataFrame:
    """Spend per calendar month, ascending; months without rows absent."""
    r = _by_merchant(fact, dim_merchant, f or Filters(), [], dim_rows, month=True, cube=cube)
    return (r.select("month", F.col(SPEND).alias("spend"))
            .orderBy(F.col("month").asc_nulls_last()))


def top_merchants(fact: DataFrame, dim_merchant: DataFrame,
                  f: Filters | None = None, n: int = 10,
                  dim_rows: int | None = None, cube: DataFrame | None = None) -> DataFrame:
    """Top ``n`` display names by spend, with transaction counts.

    Groups by the cleaned name, so one merchant under two categories is one
    row.  The top-n is a TakeOrderedAndProject over the per-name totals.
    """
    r = _by_merchant(fact, dim_merchant, f or Filters(), ["merchant_name_clean"], dim_rows, cube=cube)
    return (r.select(F.col("merchant_name_clean").alias("merchant"),
                     F.col(SPEND).alias("spend"), F.col(TXNS).alias("txns"))
            .orderBy(F.col("spend").desc_nulls_first(), F.col("merchant").asc_nulls_last())
            .limit(n))


# --- B9 --------------------------------------------------------------------

def spend_top10_stg(stg: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` categories by spend straight off staging, rounded to
    cents (ties: category ascending)."""
    return (stg.groupBy("merchant_category")
            .agg(F.round(F.sum("amount"), 2).alias("spend"))
            .orderBy(F.col("spend").desc_nulls_first(),
                     F.col("merchant_category").asc_nulls_last())
            .limit(n))
