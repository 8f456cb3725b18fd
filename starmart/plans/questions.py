"""Named star-join questions (A1-A5).

Each is a ``rollup`` of the fact over one dimension (broadcast-and-join
first when the dimension's checked row count is small, else pre-aggregate
per key before the join), then a small sort or top-k over the totals.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.plans.rollup import AMOUNTS, SPEND, TXNS, rollup


def _avg(total: str, count: str):
    """Average amount as Spark's avg over decimal(12,2) types it (NULL for a
    group without amounts)."""
    return (F.col(total) / F.nullif(F.col(count), F.lit(0)).cast("decimal(20,0)")).cast("decimal(16,6)")


def top5_categories_spend(fact: DataFrame, dim_merchant: DataFrame, n: int = 5,
                          dim_rows: int | None = None) -> DataFrame:
    """A1: top ``n`` merchant categories by total spend (ties: name)."""
    r = rollup(fact, dim_merchant, "merchant_key", ["merchant_category"], dim_rows)
    return (r.select("merchant_category", F.col(SPEND).alias("total_spend"))
            .orderBy(F.col("total_spend").desc_nulls_first(),
                     F.col("merchant_category").asc_nulls_last())
            .limit(n))


def spend_by_brand(fact: DataFrame, dim_account: DataFrame,
                   dim_rows: int | None = None) -> DataFrame:
    """A2: total spend per card brand (Other included), highest first."""
    r = rollup(fact, dim_account, "account_key", ["card_brand"], dim_rows)
    return (r.select("card_brand", F.col(SPEND).alias("total_spend"))
            .orderBy(F.col("total_spend").desc_nulls_first(),
                     F.col("card_brand").asc_nulls_last()))


def _by_state(fact: DataFrame, dim_customer: DataFrame, dim_rows: int | None,
              kept: DataFrame | None) -> DataFrame:
    r = rollup(fact, dim_customer, "customer_key", ["state"], dim_rows, kept=kept)
    return r.select("state", F.col(SPEND).alias("total_spend"), F.col(TXNS).alias("txn_count"),
                    F.col(AMOUNTS).alias("amount_count"))


def top5_states_avg(fact: DataFrame, dim_customer: DataFrame, n: int = 5,
                    with_parts: bool = False, dim_rows: int | None = None,
                    kept: DataFrame | None = None) -> DataFrame:
    """A3: ``n`` states with the highest average transaction amount.

    The average is over transactions with an amount, as ``avg(amount)`` is,
    not over customers.  ``with_parts`` keeps ``total_spend``, ``txn_count``
    and ``amount_count`` as well; ``kept`` are the customers' totals of the
    build (``Star.customers``).
    """
    s = _by_state(fact, dim_customer, dim_rows, kept).withColumn(
        "avg_amount", _avg("total_spend", "amount_count"))
    s = s.orderBy(F.col("avg_amount").desc_nulls_first(), F.col("state").asc_nulls_last()).limit(n)
    return s if with_parts else s.select("state", "avg_amount")


def weekend_vs_weekday(fact: DataFrame, dim_date: DataFrame,
                       dim_rows: int | None = None) -> DataFrame:
    """A4: transaction counts on weekend vs weekday days (two rows)."""
    r = rollup(fact, dim_date, "date_key", ["is_weekend"], dim_rows)
    return r.select("is_weekend", F.col(TXNS).alias("txn_count")).orderBy("is_weekend")


def top5_states_spend(fact: DataFrame, dim_customer: DataFrame, n: int = 5,
                      dim_rows: int | None = None, kept: DataFrame | None = None) -> DataFrame:
    """A5: ``n`` states with the highest total spend (ties: state); ``kept``
    as in A3."""
    return (_by_state(fact, dim_customer, dim_rows, kept).select("state", "total_spend")
            .orderBy(F.col("total_spend").desc_nulls_first(), F.col("state").asc_nulls_last())
            .limit(n))
