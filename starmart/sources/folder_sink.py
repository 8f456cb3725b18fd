"""An external sink in two phases (S8), on PySpark's Python data source API.

``df.write.format("starmart_folder").mode(...).save(folder)``
stands for sinks beside the catalog: tasks write Parquet files of their own
and answer with a commit message each (file, rows); the driver's commit names
them in a manifest that replaces the old one in one step.  Readers follow the
manifest, so they see all files of a write or none.  A task that is run again
writes another file; an abort deletes what its tasks wrote, and what a task
leaves that ends behind the abort goes with the next commit, which deletes
the files that its manifest doesn't name.  One writer at a time.

``folder`` is a path that the driver and all executors reach: a mounted one,
or a store that pyarrow's file systems know (``scheme://...``).
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "starmart_folder"
MANIFEST = "manifest.json"


def _place(path: str):
    """(file system, path on it)."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _manifest(path: str) -> dict:
    files, root = _place(path)
    if files.get_file_info(f"{root}/{MANIFEST}").is_file:
        with files.open_input_stream(f"{root}/{MANIFEST}") as f:
            return json.loads(f.read())
    return {"files": [], "rows": 0}


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class FolderWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        files, root = _place(self.path)
        files.create_dir(root, recursive=True)
        name, rows, out = f"part-{self.job}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if out is None:
                    out = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=files)
                out.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if out is not None:
                out.close()
                files.delete_file(f"{root}/{name}")
            raise
        if out is not None:
            out.close()
        return Written(name if out is not None else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        old = {"files": [], "rows": 0} if self.overwrite else _manifest(self.path)
        new = {"files": old["files"] + [m.file for m in messages if m and m.file],
               "rows": old["rows"] + sum(m.rows for m in messages if m)}
        files, root = _place(self.path)
        files.create_dir(root, recursive=True)
        step = f"{root}/.{MANIFEST}-{self.job}"
        with files.open_output_stream(step) as f:
            f.write(json.dumps(new).encode())
        files.move(step, f"{root}/{MANIFEST}")
        self._sweep(set(new["files"]))

    def abort(self, messages: list[Written | None]) -> None:
        self._sweep(set(_manifest(self.path)["files"]), f"part-{self.job}-")

    def _sweep(self, kept: set[str], prefix: str = "part-") -> None:
        from pyarrow import fs

        files, root = _place(self.path)
        for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.base_name.startswith(prefix) and info.base_name not in kept:
                files.delete_file(info.path)


class FolderSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> FolderWriter:
        path = self.options.get("path")
        if not path:
            raise ValueError("the sink needs the option path")
        return FolderWriter(path, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FolderSink)


def read_folder(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows the manifest names; an empty or missing sink has none."""
    names = _manifest(path)["files"]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path.rstrip('/')}/{n}" for n in names))


__all__ = ["FORMAT", "FolderSink", "read_folder", "register"]
