"""Hand-made edge rows (FIXTURES.md §4)."""
import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.functions import card_brand, customer_age, merchant_clean, surrogate_key
from starmart.operators import marts
from starmart.operators.dedupe import dedupe_first
from starmart.operators.staging import stage_transactions
from starmart.plans import bi
from starmart.plans.star import star_from_staging
from starmart.schemas import RAW_COLUMNS, STG_TRANSACTIONS, MART_SCHEMAS, same_columns
from starmart.sources.csv_ingest import ingest_csv, normalise_raw, read_csv, sample_n


def raw_row(**kw):
    base = dict(trans_index="0", trans_date_trans_time="2020-05-03 10:00:00",
                cc_num="4000000000000001", merchant="fraud_Shop", category="grocery_pos",
                amt="10.00", cust_first="Ann", cust_last="Lee", gender="F", street="1 A St",
                city="Boston", state="MA", zip="02108", lat="42.1", home_lon="-71.0",
                city_pop="1000", job="clerk", dob="1980-01-01", trans_num="t0",
                unix_time="1588500000", merch_lat="42.2", merch_long="-71.1", is_fraud="0")
    base.update(kw)
    return tuple(base[c] for c in RAW_COLUMNS)


def raw_df(spark, rows):
    return spark.createDataFrame(rows, schema=",".join(f"{c} string" for c in RAW_COLUMNS))


def test_csv_blank_header_quotes_and_text_kept(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text(',trans_num,zip,cc_num,First,LAST,long,note\n'
                 '7,a,02108,4000000000000001,Ann,Lee,-71.0,"a ""q"" b, c"\n')
    df = normalise_raw(read_csv(spark, str(p)))
    assert df.columns == ["trans_index", "trans_num", "zip", "cc_num", "cust_first",
                          "cust_last", "home_lon", "note"]
    r = df.first()
    assert r.trans_index == "7" and r.zip == "02108" and r.cc_num == "4000000000000001"
    assert r.note == 'a "q" b, c'


def test_csv_without_index_gets_unique_one(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("trans_num,amt\na,1\nb,2\nc,3\n")
    df = ingest_csv(spark, str(p))
    assert df.columns[0] == "trans_index"
    assert df.select("trans_index").distinct().count() == 3


def test_csv_na_values(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("trans_num,amt\na,NA\nb,\nc,3\n")
    assert ingest_csv(spark, str(p)).filter("amt is null").count() == 1
    assert ingest_csv(spark, str(p), na_values=["NA"]).filter("amt is null").count() == 2


def test_csv_multi_line_quoted_field(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text(',trans_num,note\n0,a,"line one\nline two"\n1,b,plain\n')
    df = normalise_raw(read_csv(spark, str(p), multi_line=True))
    got = {r.trans_num: r.note for r in df.collect()}
    assert got == {"a": "line one\nline two", "b": "plain"}
    with pytest.raises(Exception, match="multi_line=True"):  # line records: halves
        normalise_raw(read_csv(spark, str(p))).count()


def test_staging_types_and_rounding(spark):
    stg = stage_transactions(raw_df(spark, [raw_row(amt="1.005", trans_num="a"),
                                            raw_row(amt="-1.005", trans_num="b")]))
    assert same_columns(stg.schema, STG_TRANSACTIONS)
    got = {r.transaction_id: r.amount for r in stg.collect()}
    assert got == {"a": Decimal("1.01"), "b": Decimal("-1.01")}
    r = stg.first()
    assert r.postal_code == "02108" and r.card_number == "4000000000000001"
    assert r.transaction_ts == dt.datetime(2020, 5, 3, 10, 0) and r.is_fraud is False


def test_staging_lenient_mode(spark):
    bad = raw_df(spark, [raw_row(dob="not a date", amt="x")])
    r = stage_transactions(bad, strict=False).first()
    assert r.date_of_birth is None and r.amount is None


def test_person_with_two_cards(spark):
    stg = stage_transactions(raw_df(spark, [
        raw_row(trans_num="a", cc_num="4000000000000001"),
        raw_row(trans_num="b", cc_num="5000000000000002",
                trans_date_trans_time="2020-05-04 10:00:00")]))
    s = star_from_staging(spark, stg, as_of="2021-01-01")
    assert s.dim_customer.count() == 1 and s.dim_account.count() == 2
    for name, schema in MART_SCHEMAS.items():
        assert same_columns(getattr(s, name).schema, schema), name


def test_dedupe_tie_keeps_lower_id_and_null_ts_last(spark):
    df = spark.createDataFrame(
        [("k", dt.datetime(2020, 1, 1), "b", 1), ("k", dt.datetime(2020, 1, 1), "a", 2),
         ("n", None, "a", 3), ("n", dt.datetime(2021, 1, 1), "z", 4)],
        "key string, transaction_ts timestamp_ntz, transaction_id string, v int")
    got = {r.key: r.v for r in dedupe_first(df, ["key"]).collect()}
    assert got == {"k": 2, "n": 4}


def test_null_key_parts(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None)], "x string, y string")
    keys = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert None not in keys and len(set(keys)) == 3


def test_null_last_name_keys_and_full_name(spark):
    stg = stage_transactions(raw_df(spark, [raw_row(cust_last=None)]))
    s = star_from_staging(spark, stg, as_of="2021-01-01")
    c = s.dim_customer.first()
    f = s.fact_transactions.first()
    assert c.full_name is None and c.customer_key == f.customer_key


def test_merchant_two_categories_and_clean_name(spark):
    stg = stage_transactions(raw_df(spark, [
        raw_row(trans_num="a", merchant="fraud_a_fraud_b", category="x"),
        raw_row(trans_num="b", merchant="fraud_a_fraud_b", category="y")]))
    s = star_from_staging(spark, stg, as_of="2021-01-01")
    assert s.dim_merchant.count() == 2
    top = bi.top_merchants(s.fact_transactions, s.dim_merchant).collect()
    assert [(r.merchant, r.txns) for r in top] == [("a_b", 2)]
    assert spark.range(1).select(merchant_clean(F.lit("fraud_a_fraud_b"))).first()[0] == "a_b"


def test_brand_other(spark):
    df = spark.createDataFrame([("9123",), (None,), ("4123",)], "c string")
    assert [r[0] for r in df.select(card_brand("c")).collect()] == ["Other", "Other", "Visa"]


def test_age_counts_year_boundaries(spark):
    r = spark.range(1).select(customer_age(F.lit("2020-12-31").cast("date"),
                                           "2021-01-01")).first()
    assert r[0] == 1


def test_calendar(spark):
    d = marts.dim_date(spark)
    assert d.count() == 1096
    assert d.agg(F.max("full_date")).first()[0] == dt.date(2021, 12, 31)
    sun = d.filter("full_date = date'2020-05-03'").first()
    assert (sun.day_of_week, sun.day_name, sun.month_name, sun.is_weekend,
            sun.date_key) == (7, "Sun", "May", True, 20200503)
    assert marts.dim_date(spark, "2020-01-02", "2020-01-01").count() == 0


def test_filter_half_open_and_quotes(spark):
    stg = stage_transactions(raw_df(spark, [
        raw_row(trans_num="in", trans_date_trans_time="2020-05-03 23:59:59", category="o'x"),
        raw_row(trans_num="out", trans_date_trans_time="2020-05-04 00:00:00", category="o'x")]))
    s = star_from_staging(spark, stg, as_of="2021-01-01")
    f = bi.Filters(start="2020-05-03", end="2020-05-03", categories=["o'x"])
    got = [r.transaction_id for r in bi.filter_where(s.fact_transactions, s.dim_merchant,
                                                      f).collect()]
    assert got == ["in"]


def test_empty_filter(spark):
    stg = stage_transactions(raw_df(spark, [raw_row()]))
    s = star_from_staging(spark, stg, as_of="2021-01-01")
    f = bi.Filters(start="2030-01-01", end="2030-01-02")
    k = bi.kpis(s.fact_transactions, s.dim_merchant, f).collect()
    assert len(k) == 1 and (k[0].total_spend, k[0].txns, k[0].avg_txn, k[0].customers) == (0, 0, 0, 0)
    assert bi.spend_by_category(s.fact_transactions, s.dim_merchant, f).count() == 0


@pytest.fixture(params=["one scan", "histogram"])
def sample_way(request, monkeypatch):
    """Both ways to cut a sample."""
    from starmart.sources import csv_ingest
    if request.param == "histogram":
        monkeypatch.setattr(csv_ingest, "ONE_SCAN_ROWS", 0)


def test_sample_all_rows_when_n_large(spark, sample_way):
    df = raw_df(spark, [raw_row(trans_num=str(i), trans_index=str(i)) for i in range(5)])
    assert sample_n(df, 10).count() == 5
    assert sample_n(df, 3).count() == 3
    assert sample_n(df, 0).count() == 0


def test_sample_cut_equals_plain_order(spark, sample_way):
    import starmart.sources.csv_ingest as ci
    df = raw_df(spark, [raw_row(trans_num=f"t{i}", trans_index=str(i)) for i in range(3000)])
    order = [r.trans_num for r in df.withColumn("h", ci.sample_hash()).orderBy("h").collect()]
    for n in (1, 1234, 2999):
        assert sorted(r.trans_num for r in sample_n(df, n).collect()) == sorted(order[:n])


def test_sample_jobs_do_not_grow_with_copies(spark, sample_way):
    others = [raw_row(trans_num=f"t{i}") for i in range(50)]
    digest = lambda k: hashlib.md5(f"{k}42".encode()).hexdigest()
    before = sum(digest(f"t{i}") < digest("same") for i in range(50))
    sc = spark.sparkContext
    counts = []
    for copies in (20, 2000):  # the cut falls among the copies
        df = raw_df(spark, [raw_row(trans_num="same", trans_index="7")] * copies + others)
        group = f"sample-{len(counts)}"
        sc.setJobGroup(group, group)
        try:
            assert sample_n(df, before + copies // 2).count() == before + copies // 2
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        counts.append(len(sc.statusTracker().getJobIdsForGroup(group)))
    assert counts[1] <= counts[0] + 3 and max(counts) <= 32, counts


def _brute_sample(df, n):
    """The sample order stated plainly: hash, tie, row digest, NULL last."""
    import starmart.sources.csv_ingest as ci
    digest = F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return df.orderBy(ci.sample_hash().asc_nulls_last(), F.col("trans_index").asc_nulls_last(),
                      digest.asc_nulls_last()).limit(n)


def _rows(df):
    return sorted(tuple(r) for r in df.fillna("<null>").collect())


def test_sample_null_keys_and_hot_copies_match_brute_force(spark, sample_way):
    """A third of the rows copy one trans_num (distinct index); some keys and
    indexes are NULL.  Every cut equals the plain order."""
    rows = [raw_row(trans_num=f"t{i}", trans_index=str(i)) for i in range(400)]
    rows += [raw_row(trans_num="hot", trans_index=str(1000 + i), amt=f"{i}.00")
             for i in range(300)]
    rows += [raw_row(trans_num=None, trans_index=str(5000 + i)) for i in range(150)]
    rows += [raw_row(trans_num="hot", trans_index=None, amt=f"{i}.50") for i in range(40)]
    df = raw_df(spark, rows).repartition(4)
    hot_rank = _brute_sample(df, len(rows)).collect()
    first_hot = next(i for i, r in enumerate(hot_rank) if r.trans_num == "hot")
    first_null = next(i for i, r in enumerate(hot_rank) if r.trans_num is None)
    for n in (1, first_hot + 123, first_hot + 310, first_null + 7, len(rows) - 3):
        got = sample_n(df, n)
        assert got.columns == df.columns
        assert _rows(got) == _rows(_brute_sample(df, n)), n


def test_sample_identical_copies_exact_size(spark, sample_way):
    """Rows equal in every column: the cut takes exactly k of them without
    ordering the group (positions within partitions)."""
    rows = [raw_row(trans_num=f"t{i}", trans_index=str(i)) for i in range(60)]
    rows += [raw_row(trans_num="same", trans_index="7")] * 500
    df = raw_df(spark, rows).repartition(5)
    for n in (61, 333):
        want = _rows(_brute_sample(df, n))
        assert _rows(sample_n(df, n)) == want, n


def test_missing_csv_raises(spark, tmp_path):
    import pytest
    with pytest.raises(Exception):
        ingest_csv(spark, str(tmp_path / "nope.csv"))


def test_load_raw_is_idempotent_and_tables_scan(spark):
    from starmart.sources.tables import Warehouse, load_counts, load_raw, load_raw_counted, scan_table, write_table
    df = raw_df(spark, [raw_row(trans_num=str(i), trans_index=str(i)) for i in range(7)])
    wh = Warehouse.fresh(spark)
    load_raw(wh, df)
    assert load_raw(wh, df).count() == 7
    done = load_raw_counted(wh, df)
    assert tuple(load_counts(done).first()) == (7, 7)
    assert scan_table(spark, f"{wh.database('raw')}.raw_transactions").count() == 7
    write_table(df.limit(3), "default.some_table")
    assert scan_table(spark, "default.some_table").count() == 3


def test_kpis_approx_opt_in(spark):
    stg = stage_transactions(raw_df(spark, [raw_row(trans_num=str(i), cust_first=f"p{i % 4}")
                                            for i in range(40)]))
    s = star_from_staging(spark, stg, as_of="2021-01-01")
    exact = bi.kpis(s.fact_transactions, s.dim_merchant).first()
    approx = bi.kpis(s.fact_transactions, s.dim_merchant, approx_customers=True).first()
    assert exact.customers == 4 and approx.customers == 4 and exact.txns == 40


def test_kpis_null_amount_same_on_both_plans(spark):
    """Lenient staging turns a bad amount into NULL: the average is over the
    non-NULL amounts (AVG), the count over all rows, on both plans."""
    rows = [raw_row(trans_num="a", amt="10.00"), raw_row(trans_num="b", amt="bad"),
            raw_row(trans_num="c", amt="20.00", cust_first="Bo")]
    stg = stage_transactions(raw_df(spark, rows), strict=False)
    s = star_from_staging(spark, stg, as_of="2021-01-01")
    got = [tuple(bi.kpis(s.fact_transactions, s.dim_merchant, dim_rows=r).first())
           for r in (1, None)]
    assert got[0] == got[1] == (Decimal("30.00"), 3, Decimal("15.000000"), 2)


def test_state_average_is_over_amounts_on_both_plans(spark):
    rows = [raw_row(trans_num="a", amt="10.00", state="NY"), raw_row(trans_num="b", amt="bad", state="NY"),
            raw_row(trans_num="c", amt="9.00", state="CA", cust_first="Bo"),
            raw_row(trans_num="d", amt="bad", state="TX", cust_first="Cy")]
    from starmart.plans import questions
    s = star_from_staging(spark, stage_transactions(raw_df(spark, rows), strict=False), as_of="2021-01-01")
    want = [(r.state, r.a) for r in s.fact_transactions.join(s.dim_customer, "customer_key")
            .groupBy("state").agg({"amount": "avg"}).toDF("state", "a").collect()]
    for n in (3, None):
        got = questions.top5_states_avg(s.fact_transactions, s.dim_customer, dim_rows=n).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        parts = {r.state: tuple(r) for r in questions.top5_states_avg(
            s.fact_transactions, s.dim_customer, with_parts=True, dim_rows=n).collect()}
        assert parts["NY"][1:4] == (Decimal("10.00"), 2, 1) and parts["TX"][-1] is None


def test_month_is_zone_free_ntz(spark):
    stg = stage_transactions(raw_df(spark, [raw_row(trans_date_trans_time="2020-03-01 00:30:00")]))
    s = star_from_staging(spark, stg, as_of="2021-01-01")
    r = bi.spend_by_month(s.fact_transactions, s.dim_merchant)
    assert str(r.schema["month"].dataType) == "TimestampNTZType()"
    assert r.first().month == dt.datetime(2020, 3, 1)


def _csv(tmp_path, name, *files):
    d = tmp_path / name
    d.mkdir()
    for i, text in enumerate(files):
        (d / f"f{i}.csv").write_text(text)
    return str(d)


@pytest.mark.parametrize("use", [lambda d: d.collect(), lambda d: d.count(), lambda d: d.select(d.columns[-1]).collect()])
@pytest.mark.parametrize("name,files,why", [
    ("long", ["trans_index,amt\n1,2\n3,4,EXTRA\n"], "3,4,EXTRA"),
    ("short", ["trans_index,amt\n1,2\n3\n"], "not 2 fields"),
    ("break", ['trans_index,amt\n1,"x\ny"\n'], "multi_line=True"),
    ("order", ["a,b,c\n1,2,3\n", "a,c,b\n1,2,3\n"], "f1.csv|f0.csv")])
def test_csv_that_would_lose_or_swap_data_raises(spark, tmp_path, name, files, why, use):
    with pytest.raises(Exception, match=why):
        use(read_csv(spark, _csv(tmp_path, name, *files)))


def test_csv_line_breaks_headers_and_blank_index(spark, tmp_path):
    ok = read_csv(spark, _csv(tmp_path, "ml", 'a,b\n1,"x\ny"\n'), multi_line=True)
    assert [tuple(r) for r in ok.collect()] == [("1", "x\ny")]
    two = normalise_raw(read_csv(spark, _csv(tmp_path, "two", ",amt\n1,2\n", ",AMT\n3,4\n")))
    assert sorted(map(tuple, two.collect())) == [("1", "2"), ("3", "4")] and two.columns == ["trans_index", "amt"]
    assert read_csv(spark, _csv(tmp_path, "none", "a,b\n")).collect() == []
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, _csv(tmp_path, "empty", ""))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_staging_raises_under_any_ansi_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for field in ("amt", "dob", "trans_date_trans_time", "is_fraud"):
            with pytest.raises(Exception, match=f"{field} does not parse: bad"):
                stage_transactions(raw_df(spark, [raw_row(**{field: "bad"})])).collect()
        assert stage_transactions(raw_df(spark, [raw_row(amt=None)])).first().amount is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_layer_contract():
    from starmart.schemas import FACT_TRANSACTIONS, conform

    class Frame:
        schema = STG_TRANSACTIONS

    with pytest.raises(TypeError, match="fact"):
        conform(Frame(), FACT_TRANSACTIONS, "fact")
    assert conform(Frame(), STG_TRANSACTIONS, "stg") is not None
