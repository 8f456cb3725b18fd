"""Steps that many queries share: what they move, run and write."""
import pytest
from pyspark.sql import functions as F

from starmart.functions.keys import packed, unpacked
from starmart.plans import bi
from starmart.sources import csv_ingest
from starmart.sources.csv_split import HEAD, RECORD, TAIL, _joined
from starmart.sources.fixtures import AMOUNT_OF, MERCHANT_OF, joined_tables, raw_transactions


def test_no_exchange_carries_customers_by_lineitem(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = joined_tables(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # lineitem by part, by supplier, by order; orders by customer, nation, order
    assert p.count("Exchange hashpartitioning(l_") == 3
    assert p.count("Exchange hashpartitioning(o_custkey") == 1 and p.count("Exchange hashpartitioning(l_orderkey") == 1


def test_kept_rows_are_the_same_and_join_nothing(spark, sf_dir):
    kept = raw_transactions(spark, sf_dir, keep=True)
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()
    plain = raw_transactions(spark, sf_dir)
    assert kept.schema == plain.schema and kept.count() == 6000
    assert kept.exceptAll(plain).isEmpty() and plain.exceptAll(kept).isEmpty()


def test_counting_partitions_runs_no_shuffle(spark):
    conf = {"spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "8"}
    assert all(spark.conf.get(k) == v for k, v in conf.items())
    # A row of it can't be made, so the count made none.
    bad = spark.range(10).select(F.raise_error(F.lit("ran")).cast("string").alias("k")).groupBy("k").count()
    assert csv_ingest._partitions(bad) == 8
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_packed_texts_come_back_and_stay_apart(spark):
    digest = "0123456789abcdef" * 2
    texts = ["", "x", digest, digest.upper(), digest + "\n", digest[:31], digest + "0", "\0" * 16, "\0" * 17, "ü", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", packed("t").alias("p")).withColumn("u", unpacked("p")).collect()
    assert [r.u for r in rows] == [r.t for r in rows]
    assert len({r.p and bytes(r.p) for r in rows}) == len(texts)
    assert [len(r.p) for r in rows if r.t == digest] == [16]


def test_records_are_joined_a_batch_at_a_time():
    import pyarrow as pa

    def batch(*rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([
            pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()),
            pa.array(cols[3], pa.bool_()), pa.array(cols[4], pa.string())], names=["file", "split", "open", "crlf", "value"])

    got = [tuple(r.values()) for b in _joined(iter([
        batch(("a", 0, False, False, "h"), ("a", 0, False, False, '1,"x')),
        batch(("a", 0, False, False, 'y"'), ("a", 0, False, False, '2,"z'), ("a", 9, True, False, 'w"'),
              ("a", 9, True, False, "3,")),
        batch(("b", 0, False, True, "4,\r")),
    ])) for r in b.to_pylist()]
    assert got == [("a", 0, RECORD, 0, "h"), ("a", 0, RECORD, 1, '1,"x\ny"'), ("a", 0, TAIL, 2, '2,"z'),
                   ("a", 9, HEAD, 0, 'w"'), ("a", 9, RECORD, 1, "3,"), ("b", 0, RECORD, 0, "4,")]


def test_measured_suppliers_are_joined_last(spark, sf_dir):
    p = joined_tables(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    last = next(line for line in p.splitlines() if "Join Inner" in line)  # the outermost
    assert "l_suppkey" in last and "strategy=broadcast" in last


def test_kept_rows_hold_only_what_is_named(spark, sf_dir):
    kept = raw_transactions(spark, sf_dir, keep=[*MERCHANT_OF, *AMOUNT_OF])
    files = [f for f in kept.select("amt").inputFiles()]
    assert spark.read.parquet(*files).columns == ["s_name", "p_brand", "l_extendedprice"]
    some = ("merchant", "category", "amt")
    plain = raw_transactions(spark, sf_dir).select(*some)
    assert kept.select(*some).exceptAll(plain).isEmpty() and plain.exceptAll(kept.select(*some)).isEmpty()
    with pytest.raises(Exception, match="was not kept"):
        kept.select("job").collect()


def test_merchant_join_exchanges_digests_as_bytes(spark):
    key = "0123456789abcdef" * 2
    schema = "transaction_id string, customer_key string, account_key string, merchant_key string, amount int"
    fact = spark.createDataFrame([(key, "c", None, key, 1), ("t", key, key, "m", 2), ("u", "", "", None, 3),
                                  ("v", key, key, "gone", 4)], schema).repartition(2)
    dim = spark.createDataFrame([(key, "x", "X"), ("m", None, "M"), ("m", "y", "M2"), (None, "z", "Z")],
                                "merchant_key string, merchant_category string, merchant_name_clean string").repartition(2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = bi.fact_merchant_join(fact, dim)
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = sorted(got.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = sorted(fact.join(dim, "merchant_key").collect(), key=str)
    assert rows == want and len(rows) == 3 and got.schema == fact.join(dim, "merchant_key").schema
    below = plan[plan.index("Exchange hashpartitioning(merchant_key"):]
    assert below.index("unhex(transaction_id") < below.index("RoundRobin")
