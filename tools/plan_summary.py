"""Physical-plan shape of every report over a written warehouse.

usage: python tools/plan_summary.py [SF_DIR]
Builds the warehouse, runs each report once (so AQE settles), and prints
one markdown row per report: shuffles, join strategies, top-k, partial
aggregation before the first shuffle, pushed filters.
"""
from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.operators import quality  # noqa: E402
from starmart.plans import bi, questions  # noqa: E402
from starmart.plans.build import build_all  # noqa: E402
from starmart.session import get_session  # noqa: E402
from starmart.sources.fixtures import raw_transactions  # noqa: E402


def shape(df) -> dict:
    df.collect() if df.isStreaming is False else None
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                                   r"\bExchange SinglePartition|\bExchange RoundRobin", final)),
        "broadcast_joins": final.count("BroadcastHashJoin"),
        "smj": final.count("SortMergeJoin"),
        "topk": "TakeOrderedAndProject" in final,
        "partial_agg": "partial_" in final or "HashAggregate(keys=" in final,
        "pushed": "GreaterThanOrEqual(transaction_ts" in final,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="starmart-plans-")
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                               "spark.sql.warehouse.dir": f"{scratch}/wh"})
    b = build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30")
    s = b.star
    fa, dm = s.fact_transactions, s.dim_merchant
    f = bi.Filters(start="1996-03-01", end="1998-06-30", categories=("Brand#12",))
    rm, ra, rc, rd = (s.dim_rows(d) for d in
                      ("dim_merchant", "dim_account", "dim_customer", "dim_date"))
    plans = {
        "B3 bounds": bi.bounds(fa),
        "B4 category_list": bi.category_list(dm),
        "B5 kpis (filtered)": bi.kpis(fa, dm, f),
        "B5 kpis (filtered, checked size)": bi.kpis(fa, dm, f, dim_rows=rm),
        "B6 spend_by_category (filtered, checked size)": bi.spend_by_category(fa, dm, f,
                                                                              dim_rows=rm),
        "A2 spend_by_brand (checked size)": questions.spend_by_brand(fa, s.dim_account,
                                                                     dim_rows=ra),
        "A4 weekend_vs_weekday (checked size)": questions.weekend_vs_weekday(fa, s.dim_date,
                                                                             dim_rows=rd),
        "A5 top5_states_spend (checked size)": questions.top5_states_spend(
            fa, s.dim_customer, dim_rows=rc),
        "B6 spend_by_category (filtered)": bi.spend_by_category(fa, dm, f),
        "B7 spend_by_month (filtered)": bi.spend_by_month(fa, dm, f),
        "B8 top_merchants": bi.top_merchants(fa, dm),
        "B9 spend_top10_stg": bi.spend_top10_stg(s.stg_transactions),
        "A1 top5_categories_spend": questions.top5_categories_spend(fa, dm),
        "A2 spend_by_brand": questions.spend_by_brand(fa, s.dim_account),
        "A3 top5_states_avg": questions.top5_states_avg(fa, s.dim_customer),
        "A4 weekend_vs_weekday": questions.weekend_vs_weekday(fa, s.dim_date),
        "A5 top5_states_spend": questions.top5_states_spend(fa, s.dim_customer),
        "Q2 unique(fact.transaction_id)": quality.unique(fa, "transaction_id"),
        "Q3 relationships(fact.customer_key)": quality.relationships(
            fa, "customer_key", s.dim_customer, "customer_key"),
        "Q3 relationships(fact.customer_key, checked size)": quality.relationships(
            fa, "customer_key", s.dim_customer, "customer_key", parent_rows=rc),
    }
    print("| plan | shuffles | broadcast joins | sort-merge joins | top-k | "
          "partial agg | ts filter pushed |")
    print("|---|---|---|---|---|---|---|")
    for name, df in plans.items():
        d = shape(df)
        print(f"| {name} | {d['shuffles']} | {d['broadcast_joins']} | {d['smj']} | "
              f"{'yes' if d['topk'] else '-'} | {'yes' if d['partial_agg'] else '-'} | "
              f"{'yes' if d['pushed'] else '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()
