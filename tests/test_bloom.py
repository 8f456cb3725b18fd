"""The bit filter: no member is turned away, few others pass."""
import pytest
from pyspark.sql import functions as F

from starmart.operators import bloom
from starmart.operators.bloom import bit_filter


@pytest.mark.parametrize("kind", ["long", "string", "binary"])
def test_members_pass_and_most_others_do_not(spark, kind):
    key = {"long": F.col("id"), "string": F.col("id").cast("string"),
           "binary": F.unhex(F.md5(F.col("id").cast("string").cast("binary")))}[kind]
    rows = spark.range(60_000).select("id", key.alias("k"))
    got = bit_filter(rows.filter("id % 20 = 0"), "k").passed(rows, F.col("k"), "may")
    assert got.columns == ["id", "k", "may"] and got.count() == 60_000
    assert got.filter("id % 20 = 0 and not may").count() == 0
    assert got.filter("id % 20 <> 0 and may").count() < 0.15 * 60_000


def test_null_keys_empty_sets_and_a_full_filter(spark, monkeypatch):
    rows = spark.range(500).select(F.when(F.col("id") > 9, F.col("id")).alias("k"))
    none = bit_filter(rows.filter("k < 0"), "k")
    assert none.passed(rows, F.col("k")).filter("__may").count() == 0
    some = bit_filter(rows, "k")
    assert some.passed(rows, F.col("k")).filter("__may").count() == 490
    monkeypatch.setattr(bloom, "MAX_BITS", bloom.BITMAP_BITS)
    many = spark.range(200_000).select(F.col("id").alias("k"))
    full = bit_filter(many, "k")
    assert full.bits == bloom.BITMAP_BITS and full.passed(rows, F.col("k")).filter("__may").count() == 490
