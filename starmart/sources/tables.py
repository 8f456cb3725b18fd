"""Layers, table sinks and scans.

A warehouse is a root folder on shared storage (by default a fresh folder
under the session's ``spark.checkpoint.dir``) with one sub-folder per layer:
``raw``, ``staging``, ``marts``.

Tables are replaced by version.  A write goes to a folder of its own,
``{layer}/{table}/{version}``; nothing reads it until it is whole.  Publishing
appends one file to the log ``{root}/versions`` through Spark's commit
protocol, which names the new versions of one or more tables: readers see all
of them or none.  A write that fails leaves the old version current, a reader
that started before keeps its files (the version before the current one stays),
and older versions are deleted.  One writer at a time: the log has no lock.

Each table is also in the session catalog as the view ``layer.table`` over the
entry of its current version; a second warehouse of the session, with another
root, gets databases of its own (``layer_`` and a hash of the root), so
neither sees the other's tables.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_dir

LAYERS = ("raw", "staging", "marts")
#: The log of published versions.
LOG = "versions"
LOG_SCHEMA = "seq long, layer string, table string, version string, bucket_column string, buckets int"
#: Versions of a table that stay: the current one, and the one before it for
#: readers that are still at work.
KEPT_VERSIONS = 2


def write_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                options: Mapping[str, str] | None = None, as_path: bool | None = None,
                partition_by: Sequence[str] | None = None, bucket_by: tuple[str, int] | None = None) -> None:
    """Write ``df`` whole to a path or a catalog table.

    ``target`` containing ``/`` (or ``as_path=True``) is a path, else a table
    name for ``saveAsTable``.  ``fmt`` is any Spark source on the classpath;
    Delta or a warehouse connector work when installed (Spark raises
    DATA_SOURCE_NOT_FOUND otherwise).  Overwriting a plain folder deletes its
    files first; :meth:`Warehouse.write` replaces without that gap.  Parquet is
    written with zstd unless ``options`` name another codec: keys are hex
    digests, which codecs that only look for repeats leave as they are.
    """
    w = df.write.format(fmt).mode(mode)
    if fmt == "parquet":
        w = w.option("compression", "zstd")
    if options:
        w = w.options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:  # (column, buckets); Spark keeps buckets of catalog tables only
        w = w.bucketBy(bucket_by[1], bucket_by[0])
    if as_path if as_path is not None else "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def scan_table(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """Read a catalog table (``layer.table``) or a path."""
    return spark.read.format(fmt).load(target) if "/" in target else spark.table(target)


@dataclass(frozen=True)
class Candidate:
    """A written version of a table that isn't published yet."""

    layer: str
    table: str
    version: str
    path: str
    df: DataFrame
    partition_by: tuple[str, ...] = ()
    #: Stored columns that the catalog's view doesn't show.
    hidden: tuple[str, ...] = ()
    #: The column its files are dealt by, and the number of buckets.
    bucket_by: tuple[str, int] | None = None


@dataclass(frozen=True)
class Warehouse:
    """Root folder + format; ``layer.table`` <-> ``{root}/{layer}/{table}``."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    _dropped: set = field(default_factory=set, compare=False, repr=False)

    @classmethod
    def fresh(cls, spark: SparkSession, fmt: str = "parquet") -> "Warehouse":
        return cls(spark, scratch_dir(spark, "warehouse"), fmt)

    def path(self, layer: str, table: str, version: str = "") -> str:
        return f"{self.root}/{layer}/{table}" + (f"/{version}" if version else "")

    def database(self, layer: str) -> str:
        """The layer's database: the plain name unless it lies elsewhere."""
        catalog = self.spark.catalog
        if catalog.databaseExists(layer):
            place = catalog.getDatabase(layer).locationUri
            if _plain(place) != _plain(f"{self.root}/{layer}"):
                return f"{layer}_{hashlib.sha256(_plain(self.root).encode()).hexdigest()[:10]}"
        return layer

    def ensure_layers(self) -> None:
        """Create the layer databases if absent (idempotent)."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} "
                           f"LOCATION '{self.root}/{layer}'")

    # --- versions ------------------------------------------------------------

    def history(self) -> dict[tuple[str, str], list[str]]:
        """Published versions of each table, the current one first; a root
        without a log raises (PATH_NOT_FOUND)."""
        out: dict[tuple[str, str], list[str]] = {}
        for r in self._entries():
            out.setdefault((r["layer"], r["table"]), []).append(r["version"])
        return out

    def published_with(self, layer: str, table: str, other: str) -> bool:
        """True if ``table`` and ``other`` are of one publication, so that
        one may stand for the other."""
        last: dict[str, int] = {}
        for r in self._entries():
            if r["layer"] == layer:
                last.setdefault(r["table"], r["seq"])
        return table in last and last[table] == last.get(other)

    def _entries(self) -> list:
        return sorted(self._log().collect(), key=lambda r: -r["seq"])

    def _log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/{LOG}")

    def stage(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] | None = None,
              hidden: Sequence[str] = (), bucket_by: tuple[str, int] | None = None) -> Candidate:
        """Write ``df`` as a version of ``layer.table`` that no reader sees
        yet; what a failed write leaves is deleted."""
        version = f"v-{uuid.uuid4().hex[:16]}"
        path = self.path(layer, table, version)
        new = Candidate(layer, table, version, path, df, tuple(partition_by or ()), tuple(hidden), bucket_by)
        try:
            if bucket_by:
                self.ensure_layers()
                write_table(df, self._entry(layer, table, version), fmt=self.fmt, as_path=False,
                            options={"path": path}, partition_by=partition_by, bucket_by=bucket_by)
                return replace(new, df=self.spark.table(self._entry(layer, table, version)))
            write_table(df, path, fmt=self.fmt, as_path=True, partition_by=partition_by)
        except BaseException:
            self.discard([new])
            raise
        return replace(new, df=self.spark.read.format(self.fmt).load(path))

    def publish(self, candidates: Sequence[Candidate]) -> None:
        """Make the candidates current, all at once, then show them in the
        catalog and delete versions that nobody reads any more."""
        seq = _exists(self.spark, f"{self.root}/{LOG}") and self._log().agg(F.max("seq")).first()[0] or 0
        entry = [(seq + 1, c.layer, c.table, c.version, *(c.bucket_by or (None, None))) for c in candidates]
        self.spark.createDataFrame(entry, LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{self.root}/{LOG}")
        self.ensure_layers()
        for c in candidates:
            self._show(c)
        self.sweep()

    def discard(self, candidates: Sequence[Candidate]) -> None:
        """Delete candidates that won't be published."""
        for c in candidates:
            if c.bucket_by:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._entry(c.layer, c.table, c.version)}")
            delete_folder(self.spark, c.path)

    def sweep(self, keep: int = KEPT_VERSIONS) -> list[str]:
        """Delete all but the ``keep`` newest versions of each table; the
        paths that went."""
        gone = []
        for (layer, table), versions in self.history().items():
            for version in versions[keep:]:
                path = self.path(layer, table, version)
                if path not in self._dropped:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._entry(layer, table, version)}")
                    if delete_folder(self.spark, path):
                        gone.append(path)
                    self._dropped.add(path)
        return gone

    def _entry(self, layer: str, table: str, version: str) -> str:
        return f"{self.database(layer)}.{table}__{version.removeprefix('v-')}"

    def _show(self, c: Candidate) -> None:
        entry, name, catalog = self._entry(c.layer, c.table, c.version), f"{self.database(c.layer)}.{c.table}", \
            self.spark.catalog
        if not c.bucket_by:  # its write made the entry
            catalog.createTable(entry, path=c.path, source=self.fmt)
        if c.partition_by:
            catalog.recoverPartitions(entry)
        if catalog.tableExists(name) and catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {name}")
        columns = ", ".join(f"`{x}`" for x in c.df.columns if x not in c.hidden)
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {entry}")

    # --- tables ------------------------------------------------------------------

    def write(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] | None = None,
              hidden: Sequence[str] = (), bucket_by: tuple[str, int] | None = None) -> DataFrame:
        """Replace ``layer.table`` with ``df``; return the table read back.
        Until the write is whole, and if it fails, readers see the old rows."""
        new = self.stage(df, layer, table, partition_by, hidden, bucket_by)
        self.publish([new])
        return new.df

    def read(self, layer: str, table: str) -> DataFrame:
        """The current version of ``layer.table``."""
        now = next((r for r in self._entries() if (r["layer"], r["table"]) == (layer, table)), None)
        # A table never published: Spark's error names its folder.
        path = self.path(layer, table, now["version"] if now else "none")
        stored = self.spark.read.format(self.fmt).load(path)
        if now is None or not now["buckets"]:
            return stored
        # Only a catalog entry tells Spark of the buckets; a session that has
        # none for this version makes it.
        self.ensure_layers()
        entry = self._entry(layer, table, now["version"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {entry} ({columns}) USING {self.fmt} CLUSTERED BY "
                       f"(`{now['bucket_column']}`) INTO {now['buckets']} BUCKETS LOCATION '{path}'")
        return self.spark.table(entry)


def _file_system(spark: SparkSession, path: str):
    """The file system Spark itself uses for a path, and the path on it:
    DataFrames can't delete a folder or ask whether it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def delete_folder(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.delete(place, True)


def _plain(path: str) -> str:
    """A local path in its one spelling."""
    return ("/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path).rstrip("/")


@dataclass(frozen=True)
class Load:
    """A loaded RAW table with the rows sent and the rows it holds."""

    table: DataFrame
    rows_loaded: int
    rows_held: int


def stage_raw(wh: Warehouse, raw: DataFrame, table: str = "raw_transactions") -> tuple[Candidate, Load]:
    """``raw`` as a version of the RAW table, not yet published, counted on
    both sides: the rows the write was given (observed while it ran, no second
    pass) and those the version holds.  A difference is an error."""
    sent = Observation()
    new = wh.stage(raw.observe(sent, F.count(F.lit(1)).alias("n")), "raw", table)
    done = Load(new.df, sent.get["n"], new.df.count())
    if done.rows_loaded != done.rows_held:
        wh.discard([new])
        raise RuntimeError(f"{done.rows_loaded} rows were loaded into {table}, but it holds {done.rows_held}")
    return new, done


def load_raw_counted(wh: Warehouse, raw: DataFrame, table: str = "raw_transactions") -> Load:
    """Replace the RAW table with ``raw`` and count both sides."""
    new, done = stage_raw(wh, raw, table)
    wh.publish([new])
    return done


def load_raw(wh: Warehouse, raw: DataFrame, table: str = "raw_transactions") -> DataFrame:
    """Replace the RAW table with ``raw``; return the table read back.

    Re-running with the same input leaves the same rows.
    """
    return load_raw_counted(wh, raw, table).table


def load_counts(load: Load) -> DataFrame:
    """One row: rows loaded and rows held, as the loader reports them."""
    return load.table.sparkSession.range(1).select(
        F.lit(load.rows_loaded).cast("long").alias("rows_loaded"),
        F.lit(load.rows_held).cast("long").alias("rows_held"))
