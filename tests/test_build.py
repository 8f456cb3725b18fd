"""Full build: layers, tables, idempotence."""
from starmart.plans.build import build_all
from starmart.sources.fixtures import raw_transactions
from starmart.sources.tables import Warehouse


def _digest(df):
    from pyspark.sql import functions as F
    cols = sorted(df.columns)
    return df.select(F.sum(F.crc32(F.concat_ws("|", *[F.col(c).cast("string") for c in cols])))
                     .alias("h"), F.count(F.lit(1)).alias("n")).first()


def test_build_twice_same_content(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    wh = Warehouse.fresh(spark)
    b1 = build_all(spark, raw, warehouse=wh, as_of="2025-06-30")
    first = {k: _digest(v) for k, v in b1.star.tables().items()}
    assert all(r.passed for r in b1.report.collect())
    b2 = build_all(spark, raw, warehouse=wh, as_of="2025-06-30")
    second = {k: _digest(v) for k, v in b2.star.tables().items()}
    assert first == second
    assert spark.table(f"{wh.database('raw')}.raw_transactions").count() == 6000
    assert spark.table(f"{wh.database('marts')}.fact_transactions").count() == 6000
    assert spark.table("stg_transactions").count() == 6000  # staging is a view


def test_build_with_staging_table(spark, sf_dir):
    b = build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30",
                  staging_table=True, threads=1)
    assert spark.table(f"{b.warehouse.database('staging')}.stg_transactions").count() == 6000
    assert all(r.passed for r in b.report.collect())


def test_built_marts_equal_lazy_star(spark, sf_dir):
    """The written marts (calendar derived from the written fact) hold what
    the lazy star computes from staging; a fixed calendar stays fixed."""
    from starmart.plans.star import star_from_tables
    b = build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30", threads=2)
    lazy = star_from_tables(spark, sf_dir, as_of="2025-06-30")
    for m in ("dim_date", "dim_customer", "dim_account", "dim_merchant", "fact_transactions"):
        assert _digest(getattr(b.star, m)) == _digest(getattr(lazy, m)), m
    fixed = build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30",
                      calendar=("2019-01-01", "2022-01-01"), threads=1, gate=False)
    assert fixed.star.dim_date.count() == 1096


def test_rebuild_with_the_other_staging_form_reads_its_own_rows(spark, sf_dir):
    from starmart.plans.build import open_star
    raw = raw_transactions(spark, sf_dir)
    wh = Warehouse.fresh(spark)
    build_all(spark, raw, warehouse=wh, as_of="2025-06-30", staging_table=True)
    small = spark.createDataFrame(raw.limit(29).collect(), raw.schema)
    build_all(spark, small, warehouse=wh, as_of="2025-06-30")
    star = open_star(spark, wh.root)
    assert star.stg_transactions.count() == 29 == star.fact_transactions.count()
    build_all(spark, raw, warehouse=wh, as_of="2025-06-30", staging_table=True)
    assert open_star(spark, wh.root).stg_transactions.count() == 6000


def test_two_roots_in_one_session_keep_their_tables_apart(spark, sf_dir):
    from starmart.plans.build import open_star
    raw = raw_transactions(spark, sf_dir)
    small = spark.createDataFrame(raw.limit(11).collect(), raw.schema)
    one, two = Warehouse.fresh(spark), Warehouse.fresh(spark)
    build_all(spark, raw, warehouse=one, as_of="2025-06-30")
    build_all(spark, small, warehouse=two, as_of="2025-06-30")
    for wh, n in ((one, 6000), (two, 11)):
        assert spark.table(f"{wh.database('marts')}.fact_transactions").count() == n
        assert spark.table(f"{wh.database('raw')}.raw_transactions").count() == n
        assert open_star(spark, wh.root).fact_transactions.count() == n
    assert one.database("marts") != two.database("marts")


def test_open_star_without_a_build_raises(spark, tmp_path):
    from pyspark.errors import AnalysisException
    import pytest
    from starmart.plans.build import open_star
    with pytest.raises(AnalysisException):
        open_star(spark, str(tmp_path / "nothing"))


def test_contents_see_every_row(spark, sf_dir):
    from starmart.plans.build import contents
    fact = build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30").star.fact_transactions
    from pyspark.sql import functions as F
    changed = fact.withColumn("amount", F.when(F.col("transaction_id") == fact.first().transaction_id,
                                               F.lit(1).cast("decimal(12,2)")).otherwise(F.col("amount")))
    a, b, c = (contents({"f": x}).first() for x in (fact, fact.repartition(3), changed))
    assert a == b and a.digest != c.digest and a.n_rows == 6000


def test_scratch_needs_a_shared_folder_off_local_masters():
    import pytest
    from starmart.session import scratch_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())


# --- versions and the gate ------------------------------------------------------

def _half_bad(spark, n=100):
    """Rows of which the last raises while it is written."""
    from pyspark.sql import functions as F
    last = F.col("id") == n - 1
    return spark.range(0, n, 1, 4).select(
        F.when(last, F.raise_error(F.lit("broken source"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_failed_write_leaves_the_old_table(spark):
    import os

    import pytest
    wh = Warehouse.fresh(spark)
    wh.ensure_layers()
    wh.write(spark.range(100), "raw", "t")
    with pytest.raises(Exception, match="broken source"):
        wh.write(_half_bad(spark), "raw", "t")
    assert wh.read("raw", "t").count() == 100
    assert spark.table(f"{wh.database('raw')}.t").count() == 100
    assert len(os.listdir(wh.path("raw", "t").removeprefix("file:"))) == 1


def test_readers_see_the_old_rows_until_all_is_published(spark):
    import os
    wh = Warehouse.fresh(spark)
    wh.ensure_layers()
    wh.write(spark.range(5), "raw", "a")
    wh.write(spark.range(5), "raw", "b")
    reader = wh.read("raw", "a")
    new = [wh.stage(spark.range(7).selectExpr("id", "id as more"), "raw", t) for t in ("a", "b")]
    assert [wh.read("raw", t).count() for t in "ab"] == [5, 5]
    wh.publish(new)
    assert [wh.read("raw", t).count() for t in "ab"] == [7, 7]
    assert spark.table(f"{wh.database('raw')}.a").columns == ["id", "more"]
    assert reader.count() == 5  # a reader that began before keeps its files
    for n in (8, 9):
        wh.write(spark.range(n), "raw", "a")
    folder = wh.path("raw", "a").removeprefix("file:")
    assert len(os.listdir(folder)) == 2 and wh.read("raw", "a").count() == 9
    entries = [t.name for t in spark.catalog.listTables(wh.database("raw")) if t.name.startswith("a__")]
    assert len(entries) == 2
    again = Warehouse(spark, wh.root)  # another session's view of the root
    assert again.read("raw", "a").count() == 9 and again.sweep() == []


def test_a_fault_in_staging_stops_the_marts_and_leaves_the_old_ones(spark, sf_dir):
    import pytest
    from starmart.plans.build import BuildFailed, open_star
    raw = raw_transactions(spark, sf_dir)
    wh = Warehouse.fresh(spark)
    build_all(spark, raw, warehouse=wh, as_of="2025-06-30")
    doubled = raw.unionByName(raw.limit(3))
    with pytest.raises(BuildFailed) as stop:
        build_all(spark, doubled, warehouse=wh, as_of="2025-06-30")
    assert stop.value.failed == ["unique stg_transactions.transaction_id"]
    assert set(stop.value.skipped) == {"fact_transactions", "dim_customer", "dim_account", "dim_merchant", "dim_date"}
    for m in stop.value.skipped:
        assert m in str(stop.value)
    report = {r.test_id: r for r in stop.value.report.collect()}
    assert report[2].passed is False and report[2].failures == 3 and report[1].passed and report[5].passed is None
    star = open_star(spark, wh.root)
    assert star.fact_transactions.count() == 6000 == star.stg_transactions.count()
    assert spark.table(f"{wh.database('marts')}.fact_transactions").count() == 6000
    b = build_all(spark, doubled, warehouse=wh, as_of="2025-06-30", gate=False)
    assert open_star(spark, wh.root).fact_transactions.count() == 6003
    assert not all(r.passed for r in b.report.collect())


def test_a_failing_mart_test_publishes_nothing_and_leaves_no_files(spark, sf_dir):
    import os

    import pytest
    from starmart.plans.build import BuildFailed
    wh = Warehouse.fresh(spark)
    with pytest.raises(BuildFailed, match="relationships fact_transactions.date_key") as stop:
        build_all(spark, raw_transactions(spark, sf_dir), warehouse=wh, as_of="2025-06-30",
                  calendar=("2019-01-01", "2022-01-01"))
    assert stop.value.skipped == []
    left = [f for d, _, names in os.walk(wh.root.removeprefix("file:")) for f in names if f.endswith(".parquet")]
    assert left == []


def test_a_fault_in_the_fact_skips_the_calendar_behind_it(spark, sf_dir):
    import pytest
    from pyspark.sql import functions as F
    from starmart.operators import quality
    from starmart.plans import build as B
    raw = raw_transactions(spark, sf_dir)
    suite = (*quality.SUITE, quality.Check("fact_transactions", "is_fraud", "unique"))
    before = B.SUITE, quality.quality_report.__defaults__
    B.SUITE = suite
    quality.quality_report.__defaults__ = (suite, *before[1][1:])
    try:
        with pytest.raises(B.BuildFailed) as stop:
            B.build_all(spark, raw.withColumn("amt", F.col("amt")), as_of="2025-06-30")
        assert stop.value.skipped == ["dim_date"]
    finally:
        B.SUITE, quality.quality_report.__defaults__ = before


def test_waves_refuse_a_cycle():
    import pytest
    from starmart.plans.build import READS, waves
    assert waves(READS)[0] == ["stg_transactions"] and set(waves(READS)[-1]) == {"dim_date", "agg_month_merchant"}
    with pytest.raises(ValueError, match="each other"):
        waves({"a": ("b",), "b": ("a",)})
