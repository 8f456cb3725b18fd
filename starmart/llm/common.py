"""Small helpers shared by the operators of this subpackage."""
from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder, read again.

    Cuts the lineage: a lost executor costs the reread of a file, never the
    work before it, and every reader sees the same rows.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """Lets Spark delete the shuffles of finished steps, which it does only
    when the driver's collector finds their plans gone."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partition_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` partitions an integer that ``repartition(n, key)``
    sends there, so that ``n`` equal shares go to ``n`` tasks (keys 0 to n - 1
    would leave a third of them empty)."""
    key = F.col("id").cast("int")
    found = (spark.range(32 * n).select(key.alias("key"), F.pmod(F.hash(key), F.lit(n)).alias("at"))
             .groupBy("at").agg(F.min("key").alias("key")).collect())
    keys = {r["at"]: r["key"] for r in found}
    return [keys.get(i, i) for i in range(n)]


def content_key(text: F.Column) -> F.Column:
    """128-bit content address of a text (null counts as empty), as binary."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what the last one left in Arrow's pool goes back to the
    system before the next, as workers share an executor's memory."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | dict],
                schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch that returns its output
    columns (a dict of arrays) or a whole batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            out = fn(batch)
            yield (out if isinstance(out, pa.RecordBatch)
                   else pa.RecordBatch.from_pydict(out))

    return df.mapInArrow(run, schema)
