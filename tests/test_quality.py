"""Negative quality tests: each injected fault fails exactly its test."""
import pytest
from pyspark.sql import functions as F

from starmart.operators.quality import SUITE, quality_report
from starmart.plans.star import star_from_tables


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    t = star_from_tables(spark, sf_dir, as_of="2025-06-30").tables()
    return {k: v.cache() for k, v in t.items()}


def failing(report):
    return {(r.model, r.column_name, r.test): r.failures
            for r in report.collect() if not r.passed}


def test_clean_star_passes_all_23(tables):
    from starmart.schemas import QUALITY_REPORT, same_columns
    df = quality_report(tables)
    assert same_columns(df.schema, QUALITY_REPORT)
    rep = df.collect()
    assert len(rep) == 23 == len(SUITE)
    assert all(r.passed for r in rep)
    assert [r.test_id for r in rep] == list(range(1, 24))


def test_null_key_fails_not_null_only(tables):
    t = dict(tables)
    one = t["dim_account"].limit(1).withColumn("account_key", F.lit(None).cast("string"))
    t["dim_account"] = t["dim_account"].unionByName(one)
    assert failing(quality_report(t)) == {("dim_account", "account_key", "not_null"): 1}


def test_duplicate_key_fails_unique_only(tables):
    t = dict(tables)
    t["dim_merchant"] = t["dim_merchant"].unionByName(t["dim_merchant"].limit(2))
    assert failing(quality_report(t)) == {("dim_merchant", "merchant_key", "unique"): 2}


def test_orphan_key_fails_relationships_only(tables):
    t = dict(tables)
    fact = t["fact_transactions"]
    orphan = fact.limit(3).withColumn("customer_key", F.lit("orphan")).withColumn(
        "transaction_id", F.concat(F.lit("x"), F.col("transaction_id")))
    t["fact_transactions"] = fact.unionByName(orphan)
    assert failing(quality_report(t)) == {
        ("fact_transactions", "customer_key", "relationships"): 3}


def test_reference_calendar_fails_date_relationship(spark, tables):
    from starmart.operators.marts import dim_date
    t = dict(tables)
    t["dim_date"] = dim_date(spark)  # 2019-2021: the driver data is 1995-2001
    f = failing(quality_report(t))
    assert f == {("fact_transactions", "date_key", "relationships"):
                 tables["fact_transactions"].count()}


def test_checked_sizes_give_the_same_report(tables):
    rows = {d: tables[d].count() for d in ("dim_customer", "dim_account", "dim_merchant",
                                           "dim_date")}
    t = dict(tables)
    fact = t["fact_transactions"]
    orphan = fact.limit(2).withColumn("merchant_key", F.lit("orphan")).withColumn(
        "transaction_id", F.concat(F.lit("y"), F.col("transaction_id")))
    t["fact_transactions"] = fact.unionByName(orphan)
    a = quality_report(t, rows=rows).collect()
    b = quality_report(t).collect()
    assert a == b
    assert failing(quality_report(t, rows=rows)) == {
        ("fact_transactions", "merchant_key", "relationships"): 2}


def test_duplicate_parent_key_does_not_fan_out_checked_pass(tables):
    """With checked sizes the fact's relationship tests share its not-null
    scan; a duplicated parent key must still fail only its unique test."""
    rows = {d: tables[d].count() for d in ("dim_customer", "dim_account", "dim_merchant",
                                           "dim_date")}
    t = dict(tables)
    t["dim_merchant"] = t["dim_merchant"].unionByName(t["dim_merchant"].limit(2))
    assert failing(quality_report(t, rows=rows)) == {
        ("dim_merchant", "merchant_key", "unique"): 2}


def test_relationships_rows_same_on_both_plans(spark, tables):
    from starmart.operators.marts import dim_date
    from starmart.operators.quality import relationships
    cal = dim_date(spark, "1995-01-01", "1998-01-01")
    fact = tables["fact_transactions"]
    small = relationships(fact, "date_key", cal, "date_key", parent_rows=cal.count())
    unknown = relationships(fact, "date_key", cal, "date_key")
    got = sorted(unknown.collect())
    assert got == sorted(small.collect()) and len(got) > 0
    assert all(r.date_key >= 19980101 for r in got)
