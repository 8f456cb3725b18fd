"""Physical plan shapes that matter at scale."""
import pytest

from starmart.operators.dedupe import dedupe_first
from starmart.plans import bi, questions
from starmart.plans.build import build_all
from starmart.sources.fixtures import raw_transactions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    return build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30")


def test_fact_is_map_only(built):
    from starmart.operators.marts import fact_transactions
    p = plan(fact_transactions(built.star.stg_transactions))
    assert "Exchange" not in p


def test_dedupe_reduces_before_shuffle(built):
    p = plan(dedupe_first(built.star.stg_transactions, ["card_number"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_date_filter_pushed_to_scan(built):
    f = bi.Filters(start="1996-01-01", end="1996-12-31")
    p = plan(bi.spend_by_category(built.star.fact_transactions, built.star.dim_merchant, f))
    assert "PushedFilters: [IsNotNull(transaction_ts), GreaterThanOrEqual(transaction_ts" in p


def test_reports_pre_aggregate_fact_when_size_unknown(built):
    s = built.star
    for df in (bi.spend_by_category(s.fact_transactions, s.dim_merchant),
               questions.spend_by_brand(s.fact_transactions, s.dim_account),
               bi.kpis(s.fact_transactions, s.dim_merchant)):
        p = plan(df)
        # the partial aggregate on the fact sits below the join
        j = p.find("Join")
        assert "partial_sum" in p[j:]


def test_column_pruning(built):
    p = plan(questions.weekend_vs_weekday(built.star.fact_transactions, built.star.dim_date))
    assert "ReadSchema: struct<date_key:int>" in p


def _both_paths(built):
    s = built.star
    fa = s.fact_transactions
    f = bi.Filters(start="1996-01-01", end="1998-12-31", categories=("Brand#12", "Brand#7"))
    return {
        "spend_by_category": lambda r: bi.spend_by_category(fa, s.dim_merchant, f, dim_rows=r),
        "spend_by_month": lambda r: bi.spend_by_month(fa, s.dim_merchant, f, dim_rows=r),
        "top_merchants": lambda r: bi.top_merchants(fa, s.dim_merchant, dim_rows=r),
        "kpis": lambda r: bi.kpis(fa, s.dim_merchant, f, dim_rows=r),
        "kpis_empty": lambda r: bi.kpis(fa, s.dim_merchant, bi.Filters(start="2030-01-01"),
                                        dim_rows=r),
        "filter_where": lambda r: bi.filter_where(fa, s.dim_merchant, f, dim_rows=r),
        "top5_categories_spend": lambda r: questions.top5_categories_spend(
            fa, s.dim_merchant, dim_rows=r),
        "spend_by_brand": lambda r: questions.spend_by_brand(fa, s.dim_account, dim_rows=r),
        "top5_states_avg": lambda r: questions.top5_states_avg(fa, s.dim_customer, dim_rows=r),
        "weekend_vs_weekday": lambda r: questions.weekend_vs_weekday(fa, s.dim_date, dim_rows=r),
        "top5_states_spend": lambda r: questions.top5_states_spend(
            fa, s.dim_customer, dim_rows=r),
    }


def test_join_first_and_pre_aggregate_agree(built):
    for name, run in _both_paths(built).items():
        small, unknown = run(1), run(None)
        assert [(f.name, f.dataType) for f in small.schema] == [
            (f.name, f.dataType) for f in unknown.schema], name
        assert sorted(small.collect()) == sorted(unknown.collect()), name


def test_small_dimension_is_broadcast_before_any_shuffle(built):
    s = built.star
    assert s.dim_rows("dim_merchant") == 250
    p = plan(bi.spend_by_category(s.fact_transactions, s.dim_merchant,
                                  dim_rows=s.dim_rows("dim_merchant")))
    # the fact scan feeds the broadcast join directly; partial agg after it
    j = p.find("BroadcastHashJoin")
    assert j >= 0 and "Exchange" not in p[j:].split("Scan parquet")[0].split("BroadcastExchange")[0]


def test_sample_is_a_filter_on_the_order_key(built, monkeypatch):
    """Beyond the one-scan bound the result neither sorts nor shuffles the
    input: one filter on the key of the last row taken."""
    from starmart.sources import csv_ingest
    from starmart.sources.csv_ingest import sample_n
    monkeypatch.setattr(csv_ingest, "ONE_SCAN_ROWS", 0)
    p = plan(sample_n(built.warehouse.read("raw", "raw_transactions"), 500))
    assert p.count("Scan parquet") == 1 and "Sort [" not in p and "TakeOrdered" not in p and "Exchange" not in p


def final_plan(df):
    """The plan after AQE, with plan-time broadcasts off, as at scale."""
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.autoBroadcastJoinThreshold")
    conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df.write.format("noop").mode("overwrite").save()
        return plan(df).split("== Initial Plan ==")[0]
    finally:
        conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_relationships_unknown_size_never_shuffles_the_child(built, spark):
    """Orphan keys are written first; the child's rows meet them by broadcast,
    with no exchange above the child's scan."""
    from starmart.operators.marts import dim_date
    from starmart.operators.quality import relationships
    s = built.star
    none = relationships(s.fact_transactions, "customer_key", s.dim_customer, "customer_key")
    assert none.count() == 0 and "Scan parquet" not in plan(none)
    some = relationships(s.fact_transactions, "date_key", dim_date(spark, "1995-01-01", "1998-01-01"), "date_key")
    p = final_plan(some)
    assert "LeftSemi" in p and "BroadcastExchange" in p
    assert " Exchange" not in p and "ShuffleQueryStage" not in p
    assert some.count() > 0


def test_unique_is_one_scan_and_one_shuffle(built):
    from starmart.operators.quality import unique
    p = final_plan(unique(built.star.fact_transactions, "transaction_id"))
    assert p.count("Scan parquet") == 1 and p.count(" Exchange ") == 1


def fact_scans(df):
    """Scans of the fact's files in a lazy report's plan."""
    return plan(df).count("marts/fact_transactions/v-")


def test_report_scans_the_fact_at_most_three_times(built, spark):
    from starmart.operators.quality import quality_report
    s = built.star
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        for rows, most in (({}, 3), (s.rows, 2)):
            report = quality_report(s.tables(), rows=rows)
            assert 1 <= fact_scans(report) <= most, rows
            assert all(r.passed for r in report.collect())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_date_filters_prune_months(built, spark):
    """B1/B6/B7 on the written fact list and read only the range's folders;
    no schema shows the partition column."""
    from starmart.constants import FACT_MONTH
    from starmart.schemas import FACT_TRANSACTIONS, same_columns
    s = built.star
    f = bi.Filters(start="1996-11-15", end="1997-02-10")
    for df in (bi.filter_where(s.facts(), s.dim_merchant, f), bi.spend_by_category(s.facts(), s.dim_merchant, f),
               bi.spend_by_month(s.facts(), s.dim_merchant, f)):
        p = plan(df)
        assert f"{FACT_MONTH}" in p.split("PartitionFilters: [")[1].split("]")[0]
        assert FACT_MONTH not in df.columns
    rows = bi.filter_where(s.facts(), s.dim_merchant, f)
    assert sorted(rows.collect()) == sorted(bi.filter_where(s.fact_transactions, s.dim_merchant, f).collect())
    assert same_columns(s.fact_transactions.schema, FACT_TRANSACTIONS)
    view = spark.table(f"{built.warehouse.database('marts')}.fact_transactions")
    assert same_columns(view.schema, FACT_TRANSACTIONS) and view.count() == 6000
    months = s.fact_months.select(FACT_MONTH).distinct().count()
    assert len(s.fact_months.inputFiles()) <= 2 * months  # no file for every task and month


def test_bounds_read_the_first_and_last_month_only(built):
    s = built.star
    df = bi.bounds(s.facts())
    assert df.collect() == bi.bounds(s.fact_transactions).collect()
    first, last = bi.month_range(s.facts())
    assert f"IN ({first},{last})" in plan(df).split("PartitionFilters: [")[1].split("]")[0].replace(", ", ",")
    files = s.facts().filter(f"_month in ({first}, {last})").select("_metadata.file_path").distinct().count()
    assert 0 < files < len(s.facts().inputFiles()) / 10


def test_approximate_customers_shuffle_sketches_not_pairs(built):
    s = built.star
    exact = bi.kpis(s.fact_transactions, s.dim_merchant).first()
    df = bi.kpis(s.fact_transactions, s.dim_merchant, approx_customers=True)
    p = plan(df)
    assert "hll_sketch_agg" in p and "hashpartitioning(merchant_key" in p
    assert "hashpartitioning(customer_key" not in p and ", customer_key" not in p.split("Exchange")[-1]
    got = df.first()
    assert got[:3] == exact[:3] and abs(got.customers - exact.customers) <= max(2, 0.03 * exact.customers)
    none = bi.kpis(s.fact_transactions, s.dim_merchant, bi.Filters(start="2030-01-01"), approx_customers=True).first()
    assert tuple(none) == (0, 0, 0, 0)


def test_categories_of_a_large_dimension_filter_the_fact_before_its_shuffle(built, spark):
    s = built.star
    f = bi.Filters(categories=("Brand#12",))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    want = sorted(bi.filter_where(s.fact_transactions, s.dim_merchant, f, s.dim_rows("dim_merchant")).collect())
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = bi.filter_where(s.fact_transactions, s.dim_merchant, f)
        assert sorted(df.collect()) == want and want
        p = final_plan(df)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" in p and "bitmap" in p
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_samples_are_one_scan(built):
    from starmart.sources.csv_ingest import sample_n
    raw = built.warehouse.read("raw", "raw_transactions")
    p = plan(sample_n(raw, 500))
    assert "TakeOrderedAndProject" in p and p.count("Scan parquet") == 1
