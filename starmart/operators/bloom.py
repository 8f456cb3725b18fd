"""A bit filter of a set of keys, made and tested by Spark's own functions.

The bits of a set are 4 KB bitmaps by bucket (``bitmap_construct_agg``), at
most ``MAX_BITS`` in all, so the filter can be broadcast whatever the size of
the set: a larger set only lets more rows pass that don't belong.  A row the
filter turns away has a key outside the set for sure, so a join needs to move
only the rows that pass.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap, and of the largest filter (16 MB).
BITMAP_BITS = 1 << 15
MAX_BITS = 1 << 27
#: Bits for each key of a small set.
BITS_PER_KEY = 16


@dataclass(frozen=True)
class BitFilter:
    bitmaps: DataFrame
    bits: int

    def _spot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.bits))

    def passed(self, df: DataFrame, key: Column, name: str = "__may") -> DataFrame:
        """``df`` with a boolean: false only if ``key`` isn't in the set (a
        NULL key isn't)."""
        spot = self._spot(key)
        at = F.pmod(spot, F.lit(BITMAP_BITS))
        met = df.withColumn("__bf_bucket", F.floor(spot / BITMAP_BITS).cast("int")).join(
            F.broadcast(self.bitmaps), "__bf_bucket", "left")
        byte = F.conv(F.hex(F.substring(F.col("__bf_bitmap"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
        bit = F.pow(F.lit(2), F.pmod(at, F.lit(8))).cast("int")
        held = byte.cast("int").bitwiseAND(bit) != 0
        return (met.withColumn(name, F.coalesce(held & key.isNotNull(), F.lit(False)))
                .drop("__bf_bucket", "__bf_bitmap"))


def bit_filter(keys: DataFrame, column: str, rows: int | None = None) -> BitFilter:
    """The filter of the distinct non-NULL values of ``column``; ``rows``, if
    known, saves counting them."""
    if rows is None:
        rows = keys.count()
    bits = BITMAP_BITS
    while bits < min(MAX_BITS, rows * BITS_PER_KEY):
        bits *= 2
    spot = F.pmod(F.xxhash64(column), F.lit(bits))
    bitmaps = (keys.filter(F.col(column).isNotNull())
               .select(F.floor(spot / BITMAP_BITS).cast("int").alias("__bf_bucket"),
                       F.pmod(spot, F.lit(BITMAP_BITS)).alias("__bf_at"))
               .groupBy("__bf_bucket").agg(F.bitmap_construct_agg("__bf_at").alias("__bf_bitmap")))
    return BitFilter(bitmaps, bits)
