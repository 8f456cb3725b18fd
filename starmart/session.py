"""SparkSession settings the library relies on, and the shared scratch folder.

The library never assumes a particular session: every operator takes the
DataFrames it needs.  ``get_session`` is for scripts, tests and the bench.
"""
from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings applied by ``get_session``.  Broadcasts are decided by Spark's own
#: size checks: the plan-time threshold (written tables report their file
#: size) and the AQE threshold (measured shuffle output at run time).  No
#: operator hints a broadcast of a side whose size grows with the data.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "starmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with ``DEFAULT_CONF`` plus ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The folder named by ``spark.checkpoint.dir`` (shared storage every
    executor can reach), or the context's checkpoint folder.  A session that
    names neither gets a temporary folder only on a local master, where the
    driver is the executor; elsewhere that is an error, as each executor
    would write to a disk of its own.  The session is not changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception as error:  # Spark Connect: no SparkContext on the client
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from error
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir is not set (master {sc.master}): "
                           "it has to name a folder that all executors share")
    return _local_root()


@functools.cache
def _local_root() -> str:
    """One temporary folder a process, for local sessions."""
    return tempfile.mkdtemp(prefix="starmart-scratch-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of ``scratch_root`` (never reused)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["DEFAULT_CONF", "get_session", "scratch_root", "scratch_dir"]
