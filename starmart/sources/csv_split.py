"""Quoted CSV records that span lines, read in many tasks.

Spark's ``multiLine`` reads a whole file in one task, because a task that
starts inside a file can't tell whether it starts inside quotes.  A count can:
a place is inside quotes if the quotes before it are odd in number (a doubled
quote counts twice).  So the file is read by lines, as splittable text, twice:

1. The quotes of every split are counted; a running parity over the splits of
   a file (a few rows each) says which of them begin inside quotes.
2. Every task joins its lines to records.  What belongs to a record that
   began in an earlier split, or ends in a later one, goes out as a fragment,
   at most two for each split; fragments are put together by file and order.

The records are then parsed by Spark's own CSV parser.  A quote inside a field
that isn't quoted breaks the count, as it breaks RFC 4180; such a file gives
records of a wrong number of fields, which is an error.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a row of the joined lines is.
RECORD, HEAD, TAIL, INNER = 0, 1, 2, 3


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, value): physical lines with the file and the byte at
    which their split begins."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("split"), "value"))


def open_splits(text: DataFrame) -> DataFrame:
    """(file, split, open, crlf): whether a split begins inside quotes, and
    whether the file's first line ends with a carriage return (as Spark's
    reader does, such files get plain line breaks inside quotes too)."""
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # A first value of fixed width: one of text would sort all lines.
    head = F.when(F.col("split") == 0, F.first(F.endswith("value", F.lit("\r"))))
    return (text.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"), head.alias("head"))
            .withColumn("open", F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)) == 1)
            .withColumn("crlf", F.coalesce(F.max("head").over(Window.partitionBy("file")), F.lit(False)))
            .select("file", "split", "open", "crlf"))


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut where the file or the split changes."""
    file, split = batch.column(0), batch.column(1)
    changed = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(split[1:], split[:-1]))
    cuts = [0, *(np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, kind, place, value): whole records, and the fragments of
    those that cross a border; ``place`` is the record's number in its split."""
    # Held: the lines of a record that isn't closed yet.
    now, held, inside, number, begun = None, [], False, 0, False

    def sent(value: pa.Array, last: bool = False) -> pa.RecordBatch:
        # The split's next records, or the part it has of one that goes on.
        nonlocal number
        kind = np.full(len(value), TAIL if last else RECORD, dtype=np.int32)
        if number == 0 and begun:
            kind[0] = INNER if last else HEAD
        place = np.arange(number, number + len(value), dtype=np.int64)
        number += len(value)
        return pa.RecordBatch.from_pydict({
            "file": pa.repeat(pa.scalar(now[0], pa.string()), len(value)),
            "split": pa.repeat(pa.scalar(now[1], pa.int64()), len(value)),
            "kind": pa.array(kind), "place": pa.array(place), "value": value})

    def rest() -> Iterator[pa.RecordBatch]:
        if held:
            yield sent(pa.array(["\n".join(held)], pa.string()), last=True)
            held.clear()

    for batch in batches:
        for run in _runs(batch) if batch.num_rows else ():
            file, split, start_open, crlf = (run.column(i)[0].as_py() for i in range(4))
            if (file, split) != now:
                yield from rest()
                now, number, inside, begun = (file, split), 0, start_open, start_open
            value = run.column(4)
            if crlf:
                value = pc.replace_substring_regex(value, r"\r$", "", max_replacements=1)
            odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False) & 1
            after = (np.cumsum(odd) + inside) & 1  # inside quotes at the line's end
            inside = bool(after[-1])
            ends = np.flatnonzero(after == 0) + 1
            if len(ends):
                offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                whole = pc.binary_join(pa.ListArray.from_arrays(offsets, value[:int(ends[-1])]), "\n")
                if held:
                    first = pa.array(["\n".join([*held, whole[0].as_py()])], pa.string())
                    held.clear()
                    whole = pa.concat_arrays([first, whole[1:]])
                yield sent(whole)
                value = value[int(ends[-1]):]
            held.extend(value.to_pylist())
    yield from rest()


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, place, value): the logical records of the files; a
    record's split is the one it begins in."""
    text = lines(spark, path)
    # A row for each split: its size is that of the file listing.
    opened = F.broadcast(open_splits(text))
    met = text.join(opened, ["file", "split"]).select("file", "split", "open", "crlf", "value")
    parts = met.mapInArrow(_joined, "file string, split long, kind int, place long, value string")
    whole = parts.filter(F.col("kind") == RECORD).drop("kind")
    order = Window.partitionBy("file").orderBy("split", "place")
    # A tail opens a record; heads and inner parts go on with the last one.
    pieces = (parts.filter(F.col("kind") != RECORD)
              .withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order)))
    crossing = (pieces.groupBy("file", "record")
                .agg(F.min(F.struct("split", "place")).alias("at"),
                     F.array_sort(F.collect_list(F.struct("split", "place", "value"))).alias("parts"))
                .select("file", F.col("at.split").alias("split"), F.col("at.place").alias("place"),
                        F.concat_ws("\n", F.col("parts.value")).alias("value")))
    return whole.unionByName(crossing)


def read_split_csv(spark: SparkSession, path: str, header: list[str], bad: str) -> DataFrame:
    """The files' records as text columns ``header`` and ``bad`` (the record,
    if it hasn't as many fields).  Every file has to begin with the header."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, bad]])
    names = [f"c{i}" for i in range(len(header))]
    inner = ", ".join(f"{n} STRING" for n in [*names, "bad"])
    found = records(spark, path).filter(F.length("value") > 0)
    first = (F.col("split") == 0) & (F.col("place") == 0)
    options = {"escape": '"', "columnNameOfCorruptRecord": "bad", "mode": "PERMISSIVE"}
    parsed = found.select("file", first.alias("first"), F.from_csv("value", inner, options).alias("r"))
    same = F.lit(True)
    for n, c in zip(names, header, strict=True):
        same = same & (F.lower(F.coalesce(F.col(f"r.{n}"), F.lit(""))) == F.lit((c or "").lower()))
    differs = F.raise_error(F.concat(F.lit("the header of this file differs from the first file's: "), F.col("file")))
    rows = parsed.filter(F.when(~F.col("first"), F.lit(True))
                         .otherwise(F.when(same, F.lit(False)).otherwise(differs.cast("boolean"))))
    return rows.select(*(F.col(f"r.{n}") for n in [*names, "bad"])).toDF(*schema.names)


__all__ = ["lines", "open_splits", "read_split_csv", "records"]
