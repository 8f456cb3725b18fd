"""Hot keys: one card, merchant and person hold a third of all rows.

Every result is checked against a brute-force answer computed in plain
Python from the same rows, on both join plans.
"""
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from starmart.operators import quality
from starmart.operators.staging import stage_transactions
from starmart.plans import bi, questions
from starmart.plans.star import DIMS, star_from_staging
from tests.test_edges import raw_df, raw_row

N_COLD, N_HOT = 400, 200  # hot rows = a third of all rows


def _rows():
    rows = []
    for i in range(N_COLD):
        rows.append(raw_row(
            trans_num=f"c{i:04d}", trans_index=str(i), cc_num=f"{4 + i % 3}{i:015d}",
            merchant=f"fraud_m{i % 7}", category=f"cat{i % 5}", amt=f"{i % 90 + 1}.25",
            cust_first=f"P{i % 11}", state=f"S{i % 11 % 6}",
            trans_date_trans_time=f"2020-{i % 12 + 1:02d}-{i % 28 + 1:02d} 08:00:00"))
    for i in range(N_HOT):
        rows.append(raw_row(
            trans_num=f"h{i:04d}", trans_index=str(10_000 + i), cc_num="6000000000000042",
            merchant="fraud_hot", category="cat_hot", amt=f"{i % 50 + 2}.10",
            cust_first="Hot", state="SH",
            trans_date_trans_time=f"2020-03-{i % 28 + 1:02d} {i % 24:02d}:30:00"))
    return rows


@pytest.fixture(scope="module")
def hot(spark):
    rows = _rows()
    stg = stage_transactions(raw_df(spark, rows).repartition(6))
    star = star_from_staging(spark, stg, as_of="2025-06-30")
    return rows, star, {d: getattr(star, d).count() for d in DIMS}


def _col(rows, name):
    from starmart.schemas import RAW_COLUMNS
    i = RAW_COLUMNS.index(name)
    return [r[i] for r in rows]


def test_dimensions_one_row_per_key(hot):
    rows, s, counts = hot
    assert counts["dim_account"] == len(set(_col(rows, "cc_num")))
    assert counts["dim_merchant"] == len(set(zip(_col(rows, "merchant"), _col(rows, "category"))))
    assert counts["dim_customer"] == len(set(_col(rows, "cust_first")))
    hot_person = s.dim_customer.filter("first_name = 'Hot'").collect()
    assert len(hot_person) == 1 and hot_person[0].state == "SH"


def test_quality_suite_passes_and_unique_counts_hot_card(hot):
    rows, s, counts = hot
    for checked in ({}, counts):
        rep = quality.quality_report(s.tables(), rows=checked).collect()
        assert all(r.passed for r in rep), [r for r in rep if not r.passed]
    dup = {r.card_number: r.n_records
           for r in quality.unique(s.stg_transactions, "card_number").collect()}
    assert dup == {k: v for k, v in Counter(_col(rows, "cc_num")).items() if v > 1}


def _brute_spend(rows, key_cols):
    spend, n = defaultdict(Decimal), Counter()
    for r in rows:
        k = tuple(r[c] for c in key_cols)
        spend[k] += Decimal(r["amt"])
        n[k] += 1
    return spend, n


def _dicts(rows):
    from starmart.schemas import RAW_COLUMNS
    return [dict(zip(RAW_COLUMNS, r)) for r in rows]


@pytest.mark.parametrize("checked", [False, True])
def test_reports_match_brute_force_on_both_plans(hot, checked):
    rows, s, counts = hot
    d = _dicts(rows)
    rm = counts["dim_merchant"] if checked else None
    fa = s.fact_transactions

    spend, _ = _brute_spend(d, ["category"])
    got = {r.category: r.spend for r in bi.spend_by_category(fa, s.dim_merchant, dim_rows=rm).collect()}
    assert got == {k[0]: v for k, v in spend.items()}

    spend, n = _brute_spend(d, ["merchant"])
    top = bi.top_merchants(fa, s.dim_merchant, dim_rows=rm).collect()
    assert top[0].merchant == "hot" and top[0].txns == N_HOT
    assert {r.merchant: (r.spend, r.txns) for r in top} == {
        k[0].replace("fraud_", ""): (spend[k], n[k]) for k in spend}

    k = bi.kpis(fa, s.dim_merchant, dim_rows=rm).collect()[0]
    total = sum(Decimal(r["amt"]) for r in d)
    assert (k.total_spend, k.txns, k.customers) == (total, len(d), len(set(_col(rows, "cust_first"))))
    assert k.avg_txn == (total / len(d)).quantize(Decimal("0.000001"), ROUND_HALF_UP)

    spend, _ = _brute_spend(d, ["state"])
    rc = counts["dim_customer"] if checked else None
    got = {r.state: r.total_spend for r in
           questions.top5_states_spend(fa, s.dim_customer, n=100, dim_rows=rc).collect()}
    assert got == {k[0]: v for k, v in spend.items()}
