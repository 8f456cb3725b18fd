"""Full build (M9): RAW -> staging -> five marts, gated by the quality suite.

Models are built in waves, each behind the models it reads: staging, then the
marts, then a calendar that covers the written fact.  After a wave the tests
whose models are all there are run.  A model with a failing test stops the
models behind it, and then nothing is published: the candidates are deleted
and :class:`BuildFailed` names the failing tests and the skipped models.  A
green build publishes RAW, staging and marts at once (see
``sources/tables.py``), so readers see the old warehouse or the new one.

RAW and every mart are written as tables and read back before the next step
reads them, so the written tables cut the lineage and a lost executor never
forces a recomputation from the source.  Staging is a view by default, as in
the reference: it is a pure projection with casts, each mart reads only the
RAW columns it needs (parquet column pruning), and skipping it saves one
full write of the data set.  ``staging_table=True`` writes it instead
(worth it when many readers parse the same text columns).
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.constants import DIGESTS, FACT_MONTH
from starmart.functions.keys import packed, unpacked
from starmart.operators import marts
from starmart.operators.quality import SUITE, Check, quality_report
from starmart.operators.staging import stage_transactions
from starmart.plans.cube import CUBE, month_merchant
from starmart.plans.customers import CUSTOMERS, KEY, dealt, kept_keys, per_customer
from starmart.plans.star import DIMS, MARTS, Star, star_from_staging
from starmart.schemas import MART_SCHEMAS, STG_TRANSACTIONS, conform
from starmart.sizing import checked_rows
from starmart.sources.tables import Candidate, Warehouse, stage_raw

#: Table of one row that tells how the last build made staging.
BUILD_INFO, STAGED = "build_info", "staging_table"
STG = "stg_transactions"

#: What each model reads.  A fixed calendar reads nothing; a covering one
#: takes its years from the written fact's typed timestamps, not from another
#: parse of every RAW timestamp text.
READS = {STG: (), "fact_transactions": (STG,), "dim_customer": (STG,), "dim_account": (STG,),
         "dim_merchant": (STG,), "dim_date": ("fact_transactions",), CUBE: ("fact_transactions",)}
#: Tables kept for reports and tests; they are no models of the star.
KEPT = (CUBE, CUSTOMERS)
REPORT_SCHEMA = "test_id int, model string, column_name string, test string, failures long, passed boolean"


@dataclass(frozen=True)
class Build:
    warehouse: Warehouse
    star: Star
    report: DataFrame

    def contents(self) -> DataFrame:
        """Rows and content digest of every mart as written."""
        return contents({m: getattr(self.star, m) for m in MARTS})


class BuildFailed(RuntimeError):
    """Tests failed; nothing was published.  ``report`` has a row for each
    test of the suite (those not run: NULL), ``skipped`` the models that were
    not built."""

    def __init__(self, report: DataFrame, failed: list[str], skipped: list[str]):
        super().__init__(f"tests failed: {', '.join(failed)}; models not built: {', '.join(skipped) or 'none'}; "
                         "the warehouse is as it was")
        self.report, self.failed, self.skipped = report, failed, skipped


def waves(reads: Mapping[str, tuple[str, ...]]) -> list[list[str]]:
    """The models in order: each wave reads only models of earlier ones."""
    out: list[list[str]] = []
    done: set[str] = set()
    while len(done) < len(reads):
        wave = [m for m, needs in reads.items() if m not in done and done.issuperset(needs)]
        if not wave:
            raise ValueError(f"models read each other: {sorted(set(reads) - done)}")
        out.append(wave)
        done.update(wave)
    return out


def build_all(
    spark: SparkSession,
    raw: DataFrame,
    warehouse: Warehouse | None = None,
    calendar: tuple[str | dt.date, str | dt.date] | None = None,
    as_of: str | dt.date | Column | None = None,
    strict: bool = True,
    threads: int = 4,
    staging_table: bool = False,
    cluster_fact: bool = True,
    gate: bool = True,
    customer_buckets: int | None = None,
) -> Build:
    """Build the warehouse from a RAW frame and publish it if all tests pass.

    ``calendar`` = ``(start, end)`` fixes the date dimension (the reference's
    default is ``("2019-01-01", "2022-01-01")``); ``None`` covers the data's
    years.  Re-running replaces every table, so the content is the same.
    Models of a wave are submitted by ``threads`` threads as concurrent Spark
    jobs (the reference builds models with 4 threads); the threads only submit
    jobs, Spark's scheduler shares the executors.  ``gate=False`` publishes
    without running tests; the report is then lazy.  ``customer_buckets``
    keeps the customers' totals in as many buckets as ``dim_customer`` (see
    ``customers.py``); choose it so that a bucket of one row a customer fits a
    task (about 128 MB).
    """
    wh = warehouse or Warehouse.fresh(spark)
    made: dict[str, Candidate] = {}
    try:
        made["raw_transactions"], _ = stage_raw(wh, raw)
        stg = conform(stage_transactions(made["raw_transactions"].df, strict=strict), STG_TRANSACTIONS, STG)
        # Which staging form this build made; readers follow it, so a table left
        # by an earlier build of the same root is never taken for this one's.
        made[BUILD_INFO] = wh.stage(spark.range(1).select(F.lit(staging_table).alias(STAGED)), "staging", BUILD_INFO)
        if staging_table:
            made[STG] = wh.stage(stg, "staging", STG)
            stg = made[STG].df
        lazy = star_from_staging(spark, stg, calendar=calendar, as_of=as_of)
        for m, schema in MART_SCHEMAS.items():
            conform(getattr(lazy, m), schema, m)

        def write(m: str) -> None:
            if m == CUBE:
                made[m] = wh.stage(month_merchant(made["fact_transactions"].df), "marts", m)
                return
            if m == CUSTOMERS:
                made[m] = wh.stage(dealt(per_customer(made["fact_transactions"].df), customer_buckets), "marts", m,
                                   bucket_by=(KEY, customer_buckets))
                return
            df = getattr(lazy, m)
            if m == "dim_customer" and customer_buckets:
                made[m] = wh.stage(dealt(df, customer_buckets), "marts", m, bucket_by=(KEY, customer_buckets))
                return
            if m == "dim_date" and calendar is None:
                df = marts.dim_date_covering(made["fact_transactions"].df)
            if m == "fact_transactions" and cluster_fact:
                made[m] = wh.stage(_by_month(df), "marts", m, [FACT_MONTH], hidden=[FACT_MONTH])
            else:
                made[m] = wh.stage(df, "marts", m)

        reads = READS | ({"dim_date": ()} if calendar is not None else {}) | (
            {CUSTOMERS: ("fact_transactions",)} if customer_buckets else {})
        gated = _Gate() if gate else None
        tables: dict[str, DataFrame] = {}
        rows: dict[str, int] = {}
        for wave in waves(reads):
            todo = [m for m in wave if gated is None or not gated.stopped(reads[m])]
            with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
                list(pool.map(write, [m for m in todo if m != STG]))
            new = {m: stg if m == STG else made[m].df.drop(FACT_MONTH) for m in todo if m not in KEPT}
            tables |= new
            rows |= dim_row_counts(new)
            if gated is not None:
                gated.run(tables, rows, wait=CUSTOMERS in reads,
                          kept=kept_keys(made[CUSTOMERS].df) if CUSTOMERS in made else {})
        if gated is not None and gated.bad:
            raise gated.failure(spark, reads)
    except BaseException:
        wh.discard(list(made.values()))
        raise
    wh.publish(list(made.values()))
    if not staging_table:
        stg.createOrReplaceTempView(STG)
    fact = made["fact_transactions"].df
    star = Star(**{m: tables[m] for m in (STG, *MARTS)}, rows=rows, cube=made[CUBE].df,
                customers=made[CUSTOMERS].df if CUSTOMERS in made else None,
                fact_months=fact if FACT_MONTH in fact.columns else None)
    report = gated.report(spark) if gated is not None else quality_report(star.tables(), rows=rows, kept=star.kept_keys())
    return Build(wh, star, report)


class _Gate:
    """The suite's tests, each run once all its models are there."""

    def __init__(self):
        self.failures: dict[int, int] = {}
        self.bad: set[str] = set()
        self.built: set[str] = set()

    def stopped(self, needs: tuple[str, ...]) -> bool:
        return any(m in self.bad or m not in self.built for m in needs)

    def run(self, tables: Mapping[str, DataFrame], rows: Mapping[str, int],
            kept: Mapping[tuple[str, str], DataFrame], wait: bool) -> None:
        """Run what is ready; with ``wait`` the test that reads the customers'
        totals is so only when they are in ``kept``."""
        self.built = set(tables)
        ready = {i for i, c in enumerate(SUITE, start=1)
                 if i not in self.failures and c.model in tables and (c.to_model or c.model) in tables
                 and (not wait or kept or (c.test, c.column) != ("relationships", KEY))}
        if ready:
            for r in quality_report(tables, rows=rows, ids=ready, kept=kept).collect():
                self.failures[r["test_id"]] = r["failures"]
                if r["failures"]:
                    self.bad.add(r["model"])

    def report(self, spark: SparkSession) -> DataFrame:
        def row(i: int, c: Check):
            n = self.failures.get(i)
            return (i, c.model, c.column, c.test, n, None if n is None else n == 0)

        return spark.createDataFrame([row(i, c) for i, c in enumerate(SUITE, start=1)], REPORT_SCHEMA)

    def failure(self, spark: SparkSession, reads: Mapping[str, tuple[str, ...]]) -> BuildFailed:
        failed = [f"{c.test} {c.model}.{c.column}" for i, c in enumerate(SUITE, start=1) if self.failures.get(i)]
        return BuildFailed(self.report(spark), failed, [m for m in reads if m not in self.built and m not in KEPT])


def _by_month(fact: DataFrame) -> DataFrame:
    """The fact dealt by month and sorted by time, for a write by month.

    ``rebalance`` deals rows by month in one shuffle that Spark cuts by size:
    a large month becomes several files, small months share a task, and no
    task writes to many folders.  Keys travel as the bytes they stand for.
    """
    ts = F.col("transaction_ts")
    narrow = fact.withColumns({FACT_MONTH: F.year(ts) * 100 + F.month(ts), **{k: packed(k) for k in DIGESTS}})
    dealt_rows = narrow.hint("rebalance", FACT_MONTH).sortWithinPartitions(FACT_MONTH, "transaction_ts")
    return dealt_rows.withColumns({k: unpacked(k) for k in DIGESTS})


def _star(stg: DataFrame, written: Mapping[str, DataFrame], cube: DataFrame | None = None,
          customers: DataFrame | None = None) -> Star:
    """The star of written marts; the partition column stays inside."""
    fact = written["fact_transactions"]
    tables = dict(written) | {"fact_transactions": fact.drop(FACT_MONTH)}
    return Star(stg_transactions=stg, **tables, rows=dim_row_counts(tables), cube=cube, customers=customers,
                fact_months=fact if FACT_MONTH in fact.columns else None)


def _text(name: str, kind: str) -> Column:
    """A value as text that any engine can print alike."""
    c = F.col(f"`{name}`")
    if kind == "double":  # in millionths
        c = F.round(c * 1_000_000).cast("long")
    elif kind.startswith("timestamp"):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(c.cast("string"), F.lit("~"))


def contents(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, digest) of each table: its rows and the sum of a
    32-bit hash of each row's text, columns in order -- the same for the same
    rows in any order."""
    parts = []
    for name, df in tables.items():
        row = F.md5(F.concat_ws("|", *(_text(c, k) for c, k in df.dtypes)).cast("binary"))
        parts.append(df.select(F.conv(F.substring(row, 1, 8), 16, 10).cast("long").alias("h")).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(F.sum("h"), F.lit(0)).alias("digest")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dim_row_counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Row counts of the written dimensions that may be broadcast: those
    whose measured bytes are within the bound."""
    counts = {d: checked_rows(tables[d]) for d in DIMS if d in tables}
    return {d: n for d, n in counts.items() if n is not None}


def open_star(spark: SparkSession, root: str, fmt: str = "parquet") -> Star:
    """The star of a warehouse written by ``build_all`` (tables read back).

    Staging is read from its table if the last build wrote one, else derived
    from the RAW table as the view it is.
    """
    wh = Warehouse(spark, root.rstrip("/"), fmt)
    if wh.read("staging", BUILD_INFO).first()[STAGED]:
        stg = wh.read("staging", "stg_transactions")
    else:
        stg = stage_transactions(wh.read("raw", "raw_transactions"))
    # What an earlier build kept doesn't stand for this build's fact.
    cube, customers = (wh.read("marts", k) if wh.published_with("marts", k, "fact_transactions") else None
                       for k in KEPT)
    return _star(stg, {m: wh.read("marts", m) for m in MARTS}, cube, customers)
