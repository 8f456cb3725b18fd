"""The month cube: sums and counts by month and merchant, kept at build.

Dashboards ask the same totals again and again over ranges of months.  The
cube holds one row for each month and merchant, so whole months of a range
are answered from it and only the days at its edges read the fact (whose
folders by month keep that to two of them).
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.constants import FACT_MONTH
from starmart.functions.keys import packed, unpacked
from starmart.plans.rollup import AMOUNTS, SPEND, TXNS

#: Name of the table in the marts layer.
CUBE = "agg_month_merchant"


def month_merchant(fact: DataFrame) -> DataFrame:
    """(month, merchant_key, spend, transactions, amounts) of a fact; a NULL
    timestamp has a NULL month."""
    ts = F.col("transaction_ts")
    month = F.col(FACT_MONTH) if FACT_MONTH in fact.columns else F.year(ts) * 100 + F.month(ts)
    totals = fact.groupBy(month.cast("int").alias(FACT_MONTH), packed("merchant_key").alias("merchant_key")).agg(
        F.sum("amount").alias(SPEND), F.count(F.lit(1)).alias(TXNS), F.count("amount").alias(AMOUNTS))
    return totals.withColumn("merchant_key", unpacked("merchant_key"))


@dataclass(frozen=True)
class Parts:
    """A date range as whole months (``None``: unbounded; no ``months`` at
    all if ``whole`` is false) and the ranges of days at its edges."""

    whole: bool
    first: int | None
    last: int | None
    edges: list[tuple[dt.date, dt.date]]


def _number(d: dt.date) -> int:
    return d.year * 100 + d.month


def _next_month(d: dt.date) -> dt.date:
    return dt.date(d.year + d.month // 12, d.month % 12 + 1, 1)


def parts_of(start: dt.date | None, end: dt.date | None) -> Parts:
    """``start`` to ``end`` (both included) as whole months and edge days."""
    if start and end and start > end:
        return Parts(False, None, None, [])
    edges = []
    first, last = start, end and end + dt.timedelta(days=1)  # [first, last)
    if first and first.day > 1:
        until = _next_month(first)
        if last and until > last:  # inside one month
            return Parts(False, None, None, [(start, end)])
        edges.append((start, until - dt.timedelta(days=1)))
        first = until
    if last and last.day > 1:
        since = last.replace(day=1)
        edges.append((since, end))
        last = since
    if first and last and first >= last:
        return Parts(False, None, None, edges)
    return Parts(True, first and _number(first), last and _number(last - dt.timedelta(days=1)), edges)


def month_start() -> F.Column:
    """First instant of the cube's month, as a zone-free timestamp."""
    month = F.col(FACT_MONTH)
    day = F.make_date(F.floor(month / 100).cast("int"), month % 100, F.lit(1))
    return day.cast("timestamp_ntz")


def selected(cube: DataFrame, start: dt.date | None, end: dt.date | None, days) -> DataFrame:
    """Cube rows of a date range: whole months as stored, edges counted from
    the fact; ``days(start, end)`` gives the fact's rows of some days."""
    parts = parts_of(start, end)
    rows = cube
    if not parts.whole:
        rows = rows.filter(F.lit(False))
    if parts.first is not None:
        rows = rows.filter(F.col(FACT_MONTH) >= parts.first)
    if parts.last is not None:
        rows = rows.filter(F.col(FACT_MONTH) <= parts.last)
    for a, b in parts.edges:
        rows = rows.unionByName(month_merchant(days(a, b)))
    return rows


__all__ = ["CUBE", "Parts", "month_merchant", "month_start", "parts_of", "selected"]
