"""The month cube: equal rows, whole months from it, edges from the fact."""
import datetime as dt
import random

import pytest

from starmart.plans import bi
from starmart.plans.build import build_all, open_star
from starmart.plans.cube import parts_of
from starmart.sources.fixtures import raw_transactions


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30").star


RANGES = [(None, None), ("1996-01-01", "1996-12-31"), ("1996-01-02", "1996-12-30"), ("1996-02-10", "1996-02-20"),
          ("1996-02-10", "1996-03-05"), (None, "1995-06-15"), ("1997-12-31", None), ("1996-02-01", "1996-02-29"),
          ("1996-05-31", "1996-06-30"), ("2030-01-01", "2030-02-01"), ("1997-03-03", "1997-03-01")]


@pytest.mark.parametrize("start,end", RANGES)
@pytest.mark.parametrize("checked", [True, False])
def test_reports_equal_those_from_the_fact(star, start, end, checked):
    n = star.dim_rows("dim_merchant") if checked else None
    for cats in ((), ("Brand#12", "Brand#23")):
        f = bi.Filters(start, end, cats)
        for report in (bi.spend_by_category, bi.spend_by_month, bi.top_merchants):
            want = report(star.facts(), star.dim_merchant, f, dim_rows=n)
            got = report(star.facts(), star.dim_merchant, f, dim_rows=n, cube=star.cube)
            assert got.dtypes == want.dtypes and got.collect() == want.collect(), report.__name__


def test_whole_months_do_not_read_the_fact(star):
    f = bi.Filters("1996-01-01", "1996-12-31")
    plan = bi.spend_by_category(star.facts(), star.dim_merchant, f, cube=star.cube)._jdf.queryExecution().toString()
    assert "transaction_ts" not in plan and "agg_month_merchant" not in star.tables()
    edges = bi.spend_by_category(star.facts(), star.dim_merchant, bi.Filters("1996-01-05", "1996-12-30"), cube=star.cube)
    text = edges._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [isnotnull(_month") == 2


def test_parts_cover_each_day_once():
    rng = random.Random(3)
    day = dt.date(1996, 1, 1)
    for _ in range(300):
        a, b = (day + dt.timedelta(days=rng.randrange(800)) for _ in range(2))
        p = parts_of(a, b)
        got = []
        for s, e in p.edges:
            got += [s + dt.timedelta(days=i) for i in range((e - s).days + 1)]
        if p.whole:
            d = dt.date(p.first // 100, p.first % 100, 1)
            while d.year * 100 + d.month <= p.last:
                got.append(d)
                d += dt.timedelta(days=1)
        assert sorted(got) == [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]


def test_a_written_warehouse_brings_its_cube(spark, sf_dir):
    b = build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30")
    again = open_star(spark, b.warehouse.root)
    assert sorted(again.cube.collect()) == sorted(b.star.cube.collect())
