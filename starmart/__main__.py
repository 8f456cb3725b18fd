"""Command line: load, build, report, sql.

  python -m starmart load   --csv PATH --warehouse ROOT [--sample N]
  python -m starmart build  --csv PATH --warehouse ROOT [--sample N] [--calendar START END]
  python -m starmart report NAME --warehouse ROOT [--start D] [--end D] [--category C ...]
  python -m starmart sql    "SELECT ..." --warehouse ROOT [--max-rows N]

``ROOT`` is a folder on storage every executor reaches.  Results print as
text (bounded: reports are aggregates, SQL is row-capped).
"""
from __future__ import annotations

import argparse
import sys

from starmart.plans import adhoc, bi, questions
from starmart.plans.build import BuildFailed, build_all, open_star
from starmart.session import get_session
from starmart.sources.csv_ingest import ingest_csv
from starmart.sources.tables import Warehouse, load_raw_counted

def _m(s):
    return s.dim_rows("dim_merchant")


REPORTS = {
    "bounds": lambda s, f: bi.bounds(s.facts()),
    "categories": lambda s, f: bi.category_list(s.dim_merchant),
    "kpis": lambda s, f: bi.kpis(s.facts(), s.dim_merchant, f, dim_rows=_m(s)),
    "spend_by_category": lambda s, f: bi.spend_by_category(
        s.facts(), s.dim_merchant, f, dim_rows=_m(s), cube=s.cube),
    "spend_by_month": lambda s, f: bi.spend_by_month(
        s.facts(), s.dim_merchant, f, dim_rows=_m(s), cube=s.cube),
    "top_merchants": lambda s, f: bi.top_merchants(
        s.facts(), s.dim_merchant, f, dim_rows=_m(s), cube=s.cube),
    "spend_top10_stg": lambda s, f: bi.spend_top10_stg(s.stg_transactions),
    "top5_categories_spend": lambda s, f: questions.top5_categories_spend(
        s.fact_transactions, s.dim_merchant, dim_rows=_m(s)),
    "spend_by_brand": lambda s, f: questions.spend_by_brand(
        s.fact_transactions, s.dim_account, dim_rows=s.dim_rows("dim_account")),
    "top5_states_avg": lambda s, f: questions.top5_states_avg(
        s.fact_transactions, s.dim_customer, dim_rows=s.dim_rows("dim_customer"), kept=s.customers),
    "weekend_vs_weekday": lambda s, f: questions.weekend_vs_weekday(
        s.fact_transactions, s.dim_date, dim_rows=s.dim_rows("dim_date")),
    "top5_states_spend": lambda s, f: questions.top5_states_spend(
        s.fact_transactions, s.dim_customer, dim_rows=s.dim_rows("dim_customer"), kept=s.customers),
}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="starmart", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("load", "build"):
        c = sub.add_parser(name)
        c.add_argument("--csv", required=True)
        c.add_argument("--warehouse", required=True)
        c.add_argument("--sample", type=int, default=None)
        c.add_argument("--multi-line", action="store_true",
                       help="line breaks inside quoted fields (files are split among tasks all the same)")
        c.add_argument("--consecutive-index", action="store_true",
                       help="number the rows of files without an index column 0 to n - 1")
        c.add_argument("--na-values", nargs="*", default=None, metavar="TEXT",
                       help="field texts that mean NULL, besides the empty field")
        c.add_argument("--format", default="parquet", help="table format of the warehouse")
        if name == "build":
            c.add_argument("--calendar", nargs=2, metavar=("START", "END"), default=None)
            c.add_argument("--as-of", default=None, help="day that customer ages are counted to")
            c.add_argument("--lenient", action="store_true", help="text that does not parse becomes NULL")
            c.add_argument("--customer-buckets", type=int, default=None, metavar="N",
                           help="keep customers and their totals in N like buckets")
            c.add_argument("--staging-table", action="store_true", help="write staging as a table")
    r = sub.add_parser("report")
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("--warehouse", required=True)
    r.add_argument("--format", default="parquet")
    r.add_argument("--start")
    r.add_argument("--end")
    r.add_argument("--category", action="append", default=[])
    q = sub.add_parser("sql")
    q.add_argument("query")
    q.add_argument("--warehouse", required=True)
    q.add_argument("--format", default="parquet")
    q.add_argument("--max-rows", type=int, default=1000)
    args = p.parse_args(argv)

    spark = get_session()
    if args.cmd in ("load", "build"):
        raw = ingest_csv(spark, args.csv, sample=args.sample, na_values=args.na_values,
                         multi_line="split" if args.multi_line else False, consecutive=args.consecutive_index)
        wh = Warehouse(spark, args.warehouse.rstrip("/"), args.format)
        if args.cmd == "load":
            done = load_raw_counted(wh, raw)
            print(f"{done.rows_loaded:,} rows loaded, {done.rows_held:,} in raw_transactions.")
            return 0
        stopped = None
        try:
            report = build_all(spark, raw, warehouse=wh,
                               calendar=tuple(args.calendar) if args.calendar else None,
                               as_of=args.as_of, strict=not args.lenient, staging_table=args.staging_table,
                               customer_buckets=args.customer_buckets).report
        except BuildFailed as exc:
            stopped, report = exc, exc.report
        for row in report.orderBy("test_id").collect():
            state = {True: "PASS", False: "FAIL", None: "SKIP"}[row.passed]
            print(f"{state} {row.test} {row.model}.{row.column_name}"
                  + ("" if row.passed is None else f" ({row.failures} failing)"))
        if stopped:
            print(stopped, file=sys.stderr)
        return 1 if stopped else 0
    star = open_star(spark, args.warehouse, args.format)
    if args.cmd == "report":
        f = bi.Filters(args.start, args.end, tuple(args.category))
        REPORTS[args.name](star, f).show(truncate=False)
        return 0
    adhoc.register_views(star.tables())
    try:
        rows = adhoc.run_select(spark, args.query, max_rows=args.max_rows)
        rows.show(max(rows.count(), 1), truncate=False)
    except ValueError as exc:
        print(f"Not run: {exc}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
