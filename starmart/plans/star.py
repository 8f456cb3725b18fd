"""The star schema as a set of DataFrames."""
from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from starmart.operators import marts
from starmart.operators.staging import stage_transactions
from starmart.plans.customers import kept_keys
from starmart.sources.fixtures import raw_transactions

MARTS = ("dim_customer", "dim_account", "dim_merchant", "dim_date", "fact_transactions")
DIMS = MARTS[:-1]


@dataclass(frozen=True)
class Star:
    """Staging plus the five marts (lazy DataFrames or read-back tables)."""

    stg_transactions: DataFrame
    dim_customer: DataFrame
    dim_account: DataFrame
    dim_merchant: DataFrame
    dim_date: DataFrame
    fact_transactions: DataFrame
    #: The written fact with its partition column, for reports with dates.
    fact_months: DataFrame | None = None
    #: The month cube kept with the written fact (see ``cube.py``).
    cube: DataFrame | None = None
    #: Totals of each customer, dealt into the same buckets as ``dim_customer``
    #: (see ``customers.py``).
    customers: DataFrame | None = None
    #: Row counts of dimensions whose size was checked (written tables);
    #: reports use them to decide whether a dimension may be broadcast.
    rows: Mapping[str, int] = field(default_factory=dict)

    def facts(self) -> DataFrame:
        """The fact for reports: with the partition column if it has one."""
        return self.fact_transactions if self.fact_months is None else self.fact_months

    def dim_rows(self, name: str) -> int | None:
        return self.rows.get(name)

    def kept_keys(self) -> dict[tuple[str, str], DataFrame]:
        """(model, column) -> (column, n_rows) kept at build, for the tests."""
        return {} if self.customers is None else kept_keys(self.customers)

    def tables(self) -> dict[str, DataFrame]:
        return {"stg_transactions": self.stg_transactions,
                **{m: getattr(self, m) for m in MARTS}}


def star_from_staging(
    spark: SparkSession,
    stg: DataFrame,
    calendar: tuple[str | dt.date, str | dt.date] | None = None,
    as_of: str | dt.date | Column | None = None,
) -> Star:
    """Lazy marts over ``stg``.

    ``calendar`` = ``(start, end)`` gives the reference's fixed calendar;
    ``None`` builds whole years covering the staged timestamps.
    """
    date_dim = (marts.dim_date(spark, *calendar) if calendar is not None
                else marts.dim_date_covering(stg))
    return Star(
        stg_transactions=stg,
        dim_customer=marts.dim_customer(stg, as_of),
        dim_account=marts.dim_account(stg),
        dim_merchant=marts.dim_merchant(stg),
        dim_date=date_dim,
        fact_transactions=marts.fact_transactions(stg),
    )


def star_from_tables(spark: SparkSession, sf_dir: str, as_of=None, calendar=None,
                     keep: bool | Sequence[str] = False) -> Star:
    """Lazy star over the RAW mapping of the driver tables in ``sf_dir``;
    ``keep`` for readers of more than one of its tables (see ``fixtures.py``)."""
    stg = stage_transactions(raw_transactions(spark, sf_dir, keep=keep))
    return star_from_staging(spark, stg, calendar=calendar, as_of=as_of)
