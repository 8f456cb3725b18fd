"""Customers' totals next to the customers: joins without an exchange.

The fact isn't bucketed itself: a customer that holds a third of all rows
would be one bucket, so one task.  What joins and tests on the customer key
need of it is one row a customer (its totals), and that row has no hot key.  A
build with ``customer_buckets`` writes these totals and ``dim_customer`` dealt
by the customer key into the same number of buckets, so that the join of the
two, the orphan test and the uniqueness test read bucket with bucket.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.plans.rollup import TXNS, per_key

#: Name of the table in the marts layer, and the key both tables are dealt by.
CUSTOMERS, KEY = "agg_customer", "customer_key"


def per_customer(fact: DataFrame) -> DataFrame:
    """Totals of each customer (NULL keys have a row of their own)."""
    return per_key(fact, KEY)


def dealt(df: DataFrame, buckets: int) -> DataFrame:
    """Rows dealt as the buckets are, so that a task writes few files; Spark
    cuts a large bucket into several files and joins small ones in a task."""
    return df.hint("rebalance", buckets, KEY)


def kept_keys(customers: DataFrame) -> dict[tuple[str, str], DataFrame]:
    """The rows of each key that the fact's relationship test counts."""
    return {("fact_transactions", KEY): customers.select(KEY, F.col(TXNS).alias("n_rows"))}
