"""Benchmark: full build then every report/question over the written marts.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
``value`` is the wall-clock sum of the build, the quality suite and one run
of every query; ``warm`` holds a second run of each query.
"""
from __future__ import annotations

import json
import os
import re
import tempfile
import time

from starmart.operators import quality
from starmart.plans import adhoc, bi, questions
from starmart.plans.build import build_all
from starmart.session import get_session
from starmart.sources.csv_ingest import sample_n
from starmart.sources.fixtures import raw_transactions

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def queries(spark, b) -> dict:
    """Name -> a run of one report over a build's written marts."""
    s = b.star
    f = bi.Filters(start="1996-03-01", end="1998-06-30",
                   categories=("Brand#12", "Brand#23", "Brand#7"))
    adhoc.register_views(s.tables())

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    fa, dm = s.facts(), s.dim_merchant
    # checked dimension sizes of the written warehouse pick each report's plan
    rm, ra, rc, rd = (s.dim_rows(d) for d in
                      ("dim_merchant", "dim_account", "dim_customer", "dim_date"))
    return {
        "filter_where": lambda: noop(bi.filter_where(fa, dm, f, rm)),
        "fact_merchant_join": lambda: noop(bi.fact_merchant_join(fa, dm, dim_rows=rm)),
        "bounds": lambda: bi.bounds(fa).collect(),
        "category_list": lambda: bi.category_list(dm).collect(),
        "kpis": lambda: bi.kpis(fa, dm, dim_rows=rm).collect(),
        "kpis_filtered": lambda: bi.kpis(fa, dm, f, dim_rows=rm).collect(),
        "spend_by_category": lambda: bi.spend_by_category(fa, dm, dim_rows=rm).collect(),
        "spend_by_month": lambda: bi.spend_by_month(fa, dm, f, dim_rows=rm).collect(),
        "top_merchants": lambda: bi.top_merchants(fa, dm, dim_rows=rm).collect(),
        "spend_top10_stg": lambda: bi.spend_top10_stg(s.stg_transactions).collect(),
        "top5_categories_spend": lambda: questions.top5_categories_spend(
            fa, dm, dim_rows=rm).collect(),
        "spend_by_brand": lambda: questions.spend_by_brand(
            fa, s.dim_account, dim_rows=ra).collect(),
        "top5_states_avg": lambda: questions.top5_states_avg(
            fa, s.dim_customer, dim_rows=rc).collect(),
        "weekend_vs_weekday": lambda: questions.weekend_vs_weekday(
            fa, s.dim_date, dim_rows=rd).collect(),
        "top5_states_spend": lambda: questions.top5_states_spend(
            fa, s.dim_customer, dim_rows=rc).collect(),
        "guarded_select": lambda: adhoc.run_select(
            spark, "select d.year, d.month, count(*) as txns, sum(f.amount) as spend "
                   "from fact_transactions f join dim_date d on f.date_key = d.date_key "
                   "group by d.year, d.month").collect(),
        "sample_n": lambda: noop(sample_n(b.warehouse.read("raw", "raw_transactions"), 50_000)),
        "unique_fact_id": lambda: quality.unique(fa, "transaction_id").collect(),
    }


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="starmart-bench-")
    spark = get_session(
        f"local[{CPUS}]", app_name="starmart-bench", shuffle_partitions=2 * CPUS,
        extra={"spark.driver.memory": "16g", "spark.checkpoint.dir": f"{scratch}/ckpt",
               "spark.sql.warehouse.dir": f"{scratch}/wh"})

    times: dict[str, float] = {}
    t0 = time.time()
    # Writing and testing are timed apart, as in earlier records.
    b = build_all(spark, raw_transactions(spark, SF_DIR), as_of="2025-06-30", gate=False)
    times["build"] = time.time() - t0
    t0 = time.time()
    report = b.report.collect()
    times["quality_report"] = time.time() - t0
    plans = queries(spark, b)
    warm: dict[str, float] = {}
    for name, run in plans.items():
        t0 = time.time()
        run()
        times[name] = time.time() - t0
    for name, run in plans.items():
        t0 = time.time()
        run()
        warm[name] = time.time() - t0

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "build_plus_queries_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "warm": {k: round(v, 3) for k, v in warm.items()},
        "sf": float(sf.group(1)) if sf else SF_DIR,
        "cpus": CPUS,
        "rows": b.star.fact_transactions.count(),
        "quality_passed": all(r.passed for r in report),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
