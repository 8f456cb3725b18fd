"""Customers' totals in like buckets: equal rows, no exchange by customer."""
import re

import pytest
from pyspark.sql import functions as F

from starmart.operators import quality
from starmart.plans import questions
from starmart.plans.build import BuildFailed, build_all, open_star
from starmart.sources.fixtures import raw_transactions
from starmart.sources.tables import Warehouse

BUCKETS = 6


@pytest.fixture(scope="module")
def unsized(spark):
    """A session that broadcasts nothing, so that every dimension is large."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    if adaptive is None:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    else:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)


@pytest.fixture(scope="module")
def hot(unsized, sf_dir):
    """RAW rows with a customer that holds a third of them."""
    raw = raw_transactions(unsized, sf_dir)
    one = raw.select("cust_first", "cust_last", "dob", "street", "city", "state", "zip").first()
    third = F.col("trans_index").cast("long") % 3 == 0
    return raw.withColumns({c: F.when(third, F.lit(one[c])).otherwise(F.col(c)) for c in one.asDict()})


@pytest.fixture(scope="module")
def built(unsized, hot):
    return build_all(unsized, hot, as_of="2025-06-30", customer_buckets=BUCKETS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (\w+)(?:\(([a-z_]+))?", plan(df))


def reports(star, kept):
    for q in (questions.top5_states_avg, questions.top5_states_spend):
        yield q(star.fact_transactions, star.dim_customer, n=100, kept=kept)


def test_answers_equal_those_from_the_fact(built):
    for got, want in zip(reports(built.star, built.star.customers), reports(built.star, None), strict=True):
        assert got.dtypes == want.dtypes and got.collect() == want.collect() != []


def test_a_broadcast_dimension_meets_the_totals(built):
    s = built.star
    got = questions.top5_states_spend(s.fact_transactions, s.dim_customer, dim_rows=10, kept=s.customers)
    assert "BroadcastHashJoin" in plan(got)
    assert got.collect() == questions.top5_states_spend(s.fact_transactions, s.dim_customer).collect()


def test_join_orphans_and_uniqueness_need_no_exchange_by_customer(built):
    s = built.star
    for got in reports(s, s.customers):
        assert "SortMergeJoin" in plan(got) and [x for x in exchanges(got) if x[1]] == [("hashpartitioning", "state")]
    assert exchanges(quality.unique(s.dim_customer, "customer_key")) == []
    orphans = quality.quality_report(s.tables(), suite=[c for c in quality.SUITE if c.test == "relationships" and
                                                        c.column == "customer_key"], kept=s.kept_keys())
    assert not any(key for _, key in exchanges(orphans)) and "LeftAnti" in plan(orphans)
    assert "customer_key" in [x[1] for x in exchanges(next(reports(s, None)))]


def test_a_hot_customer_is_one_row(built):
    s = built.star
    rows = s.customers.select("customer_key", F.col("_txns").alias("n"))
    assert rows.agg(F.max("n")).first()[0] >= 2000
    assert rows.count() == s.fact_transactions.select("customer_key").distinct().count()
    assert rows.agg(F.sum("n")).first()[0] == s.fact_transactions.count()


def test_a_session_without_the_entry_makes_it(unsized, built):
    wh = built.warehouse
    for table in ("dim_customer", "agg_customer"):
        version = wh.history()["marts", table][0]
        unsized.sql(f"DROP TABLE {wh._entry('marts', table, version)}")
    star = open_star(unsized, wh.root)
    for got, want in zip(reports(star, star.customers), reports(star, None), strict=True):
        assert [x[1] for x in exchanges(got) if x[1]] == ["state"]
        assert got.collect() == want.collect() != []
    unsized.sql(f"DROP VIEW IF EXISTS {wh.database('marts')}.dim_customer")


def test_a_later_build_without_buckets_leaves_no_stale_totals(unsized, sf_dir):
    raw, wh = raw_transactions(unsized, sf_dir), Warehouse.fresh(unsized)
    build_all(unsized, raw, warehouse=wh, as_of="2025-06-30", customer_buckets=2)
    assert open_star(unsized, wh.root).customers is not None
    build_all(unsized, raw.filter("cast(trans_index as long) % 2 = 0"), warehouse=wh, as_of="2025-06-30", gate=False)
    star = open_star(unsized, wh.root)
    assert star.customers is None and star.kept_keys() == {} and star.cube is not None


def test_orphans_are_counted_from_the_totals(built):
    s = built.star
    tables = s.tables() | {"dim_customer": s.dim_customer.filter("state <> 'NATION_10'")}
    want = {r["test_id"]: r["failures"] for r in quality.quality_report(tables).collect()}
    got = {r["test_id"]: r["failures"] for r in quality.quality_report(tables, kept=s.kept_keys()).collect()}
    assert got == want and any(want.values())


def test_the_gate_waits_for_the_totals(unsized, built, hot, monkeypatch):
    assert built.report.filter("passed is null or not passed").count() == 0
    from starmart.operators import marts
    whole = marts.dim_customer
    monkeypatch.setattr(marts, "dim_customer", lambda stg, as_of=None: whole(stg, as_of).filter("state <> 'NATION_10'"))
    with pytest.raises(BuildFailed) as err:
        build_all(unsized, hot, as_of="2025-06-30", customer_buckets=2)
    assert err.value.failed == ["relationships fact_transactions.customer_key"]
