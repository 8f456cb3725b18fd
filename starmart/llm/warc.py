"""WARC: archives of gzip members and a splittable reader.

Writer: every task writes one archive of its rows, one gzip member a record,
under a name of its own in the shared folder; the returned manifest names only
files of successful tasks, so a lost or doubled attempt leaves nothing that is
read.  Of records with equal payloads the one with the smallest id is the
response, the others are revisits without payload.

Reader: archives are cut into byte ranges.  A task scans its range for the
gzip magic, validates each candidate by decoding it (a WARC version line at
its start, gzip's own checksum at its end), and owns the records that start
inside its range; it reads past the range only to finish the last one.  Memory
is one range and one record.

Plan: equal payloads are found from digests alone (pre-aggregated, no html in
the shuffle); only digests that occur twice are joined back, by broadcast if
Spark sees from the written table's size that it fits, else by digest.

Defined results: null html is an empty payload; a null url has no target
header; null ids order last and read back as null; rows that repeat the
smallest id are all responses; an empty table writes no file and reads as no
rows; other columns are ignored.
"""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import written
from starmart.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
SPLIT_BYTES = 4 << 20
STEP = 1 << 16


def open_shared(path: str, mode: str):
    """A binary file of the shared folder: a mounted path, or a store that
    pyarrow's file systems reach."""
    if path.startswith("file:") or path.startswith("/"):
        return open("/" + path.removeprefix("file:").lstrip("/"), mode)
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    return store.open_output_stream(at) if "w" in mode else store.open_input_file(at)


# --- one record ---------------------------------------------------------------

def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, response_id) -> bytes:
    """A gzip member; a revisit of ``response_id`` unless that is None."""
    revisit = response_id is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=-._~"))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{response_id}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def parsed(data: bytes) -> dict | None:
    """Fields of a decoded member, None if it isn't a whole WARC record."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not blank or not lines[0].startswith("WARC/1."):
        return None
    field = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = field.get("content-length", "")
    if not size.isdigit() or len(rest) < int(size):
        return None
    http, _, payload = rest[:int(size)].partition(b"\r\n\r\n")
    full = {k.strip().lower(): v.strip() for k, _, v in
            (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}

    def number(urn: str) -> int | None:
        tail = urn.strip("<>").rpartition(":")[2]
        return int(tail) if tail else None

    revisit = field.get("warc-type") == "revisit"
    return {"page_id": number(field.get("warc-record-id", "")),
            "record_type": field.get("warc-type"), "url": field.get("warc-target-uri"),
            "payload_bytes": int(full.get("content-length", 0)) if revisit else len(payload),
            "payload_digest": (field.get("warc-payload-digest", "").removeprefix("sha1:")
                               if revisit else payload_digest(payload)),
            "refers_to": number(field["warc-refers-to"]) if "warc-refers-to" in field else None,
            "payload": None if revisit else payload}


# --- writer -------------------------------------------------------------------

def write_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the rows (page_id, url, html) and returns the manifest
    (path, bytes, records).  Payloads under ``min_bytes`` are never revisits."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    digest = F.unhex(F.sha1("payload"))
    shared = written(
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy(digest.alias("digest")).agg(F.min("page_id").alias("response"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "response"), "payloads")
    known = rows.withColumn("digest", digest).join(shared, "digest", "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias("response"))
    folder = scratch_dir(pages.sparkSession, "warc")
    if folder.startswith(("file:", "/")):
        import os

        os.makedirs("/" + folder.removeprefix("file:").lstrip("/"), exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, size, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            out = out or (open_shared(path, "wb") if len(batch) else None)
            for row in zip(*(batch.column(i) for i in range(4)), strict=True):
                member = record(*(x.as_py() for x in row))
                out.write(member)
                size, n = size + len(member), n + 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [n]})

    return written(known.mapInArrow(write, "path string, bytes long, records long"), "manifest")


# --- reader -------------------------------------------------------------------

def owned(f, size: int, start: int, end: int) -> Iterator[bytes]:
    """Decoded members that start in ``[start, end)`` of a file."""
    f.seek(start)
    data, pos = bytearray(f.read(end - start + len(MAGIC) - 1)), 0
    while 0 <= (pos := data.find(MAGIC, pos)) < end - start:
        unpack, out, at, good = zlib.decompressobj(31), bytearray(), pos, True
        try:
            while not unpack.eof:
                if at >= len(data):
                    more = f.read(STEP)
                    if not more:
                        break
                    data += more
                out += unpack.decompress(bytes(data[at:at + STEP]))
                at = min(at + STEP, len(data))
                if len(out) >= 7 and not out.startswith(b"WARC/1."):
                    good = False
                    break
        except zlib.error:
            good = False
        if good and unpack.eof:
            yield bytes(out)
            pos = at - len(unpack.unused_data)
        else:
            pos += 1


RECORD = ("page_id long, record_type string, url string, payload_bytes long, "
          "payload_digest string, refers_to long")


def read_archives(manifest: DataFrame, with_payload: bool = True,
                  split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the archives of a manifest (path, bytes)."""
    ranges = (manifest.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
        .withColumn("end", F.least(F.col("start") + split_bytes, "bytes")))
    n = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    schema = RECORD + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[x.split()[1]] for x in schema.split(", ")]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in zip(names, kinds, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, held = [], 0
                with open_shared(row["path"], "rb") as f:
                    for data in owned(f, row["bytes"], row["start"], row["end"]):
                        got = parsed(data)
                        if got is None:
                            continue
                        rows.append(got)
                        held += len(data) if with_payload else 0
                        if held > SPLIT_BYTES or len(rows) >= 2000:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    # A fixed number of partitions, so tiny rows that stand for large ranges
    # aren't merged into few tasks.
    spread = ranges.repartition(int(min(n, 100_000)), "path", "start")
    return spread.mapInArrow(read, schema)
