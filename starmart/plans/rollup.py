"""The one join-and-aggregate shape behind every report: fact ⋈ dimension
on a key, amounts summed and rows counted per dimension attribute.

Two plans, chosen by the dimension's *checked* size (its row count, known
for written tables; ``None`` means unknown):

* small dimension (``fits_broadcast``): broadcast it and join
  first.  The fact is never shuffled; each task partially aggregates to a
  handful of attribute rows before the only (tiny) shuffle.
* large or unknown: aggregate the fact per key first (partial + final, so a
  key holding a third of the rows collapses map-side), then join one row
  per key to the dimension and aggregate again.  No join sees raw fact rows.

Both give the same rows: inner-join semantics (keys without a dimension row
drop out) and the same totals.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.sizing import fits_broadcast

SPEND = "_spend"  # decimal(22,2): the type of sum over decimal(12,2)
TXNS = "_txns"
AMOUNTS = "_amounts"  # rows whose amount isn't NULL: what an average divides by


def per_key(fact: DataFrame, key: str, *extra: Column) -> DataFrame:
    """The fact's totals for each key (and ``extra`` column)."""
    return fact.groupBy(key, *extra).agg(F.sum("amount").alias(SPEND), F.count(F.lit(1)).alias(TXNS),
                                         F.count("amount").alias(AMOUNTS))


def rollup(fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str],
           dim_rows: int | None = None, extra: Mapping[str, Column] | None = None,
           kept: DataFrame | None = None) -> DataFrame:
    """Columns ``by`` + ``extra`` names + ``_spend`` (sum of amount) +
    ``_txns`` (row count) + ``_amounts`` (rows with an amount) of
    ``fact ⋈ dim`` on ``key``.

    ``extra`` are grouping columns computed from the fact (e.g. the month).
    ``kept`` is :func:`per_key` of the whole fact as written at build; the
    fact is then not read (not with ``extra``).
    """
    extra = dict(extra or {})
    ex_cols = [c.alias(n) for n, c in extra.items()]
    dim_side = dim.select(key, *by)
    small = fits_broadcast(dim_rows)
    if small and kept is None:
        j = fact.select(key, "amount", *ex_cols).join(F.broadcast(dim_side), key)
        out = j.groupBy(*by, *extra).agg(F.sum("amount").alias(SPEND),
                                         F.count(F.lit(1)).alias(TXNS),
                                         F.count("amount").alias(AMOUNTS))
    else:
        totals = per_key(fact, key, *ex_cols) if kept is None else kept
        out = totals.join(F.broadcast(dim_side) if small else dim_side, key).groupBy(*by, *extra).agg(
            F.sum(SPEND).alias(SPEND), F.sum(TXNS).alias(TXNS), F.sum(AMOUNTS).alias(AMOUNTS))
    return out.withColumn(SPEND, F.col(SPEND).cast("decimal(22,2)"))
