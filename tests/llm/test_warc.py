"""WARC: exact round trip at every split size, revisits, foreign bytes."""
import base64
import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import types as t

from starmart.llm import warc as W
from starmart.llm.common import read_table

PAGES = t.StructType([t.StructField("page_id", t.LongType()), t.StructField("url", t.StringType()),
                      t.StructField("html", t.StringType()), t.StructField("digest", t.StringType()),
                      t.StructField("response", t.LongType())])


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], PAGES)


def brute(rows, least=0):
    """Multiset of (page_id, bytes, digest, type, refers_to, url given)."""
    first = {}
    for i, _, html in rows:
        payload = (html or "").encode()
        if i is not None:
            first[payload] = min(first.get(payload, i), i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        ref = first.get(payload) if len(payload) >= least else None
        revisit = ref is not None and ref != i
        out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", ref if revisit else None))
    return sorted(out, key=str)


def read(manifest, **more):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in W.read_archives(manifest, **more).collect()), key=str)


ROWS = [(3, "http://a/é?x=1\r\nX: y", "<p>é😀</p>\r\n\r\nWARC/1.1"), (1, None, ""), (2, "u", None), (9, "u", "<p>é😀</p>\r\n\r\nWARC/1.1"),
        (9, "u", "dup"), (4, "u", "dup"), (4, "u", "dup"), (None, "u", "dup"), (None, "u", "only null id"), (7, "", "x" * 200_000)]


@pytest.mark.parametrize("split", [64, 1000, 4 << 20])
def test_round_trip(spark, split):
    manifest = W.write_archives(pages(spark, ROWS).repartition(3))
    assert read(manifest, split_bytes=split) == brute(ROWS)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in W.read_archives(manifest, split_bytes=split).collect()
                if r["record_type"] == "response" and r["page_id"] in (3, 7)}
    assert payloads == {3: ROWS[0][2].encode(), 7: ROWS[9][2].encode()}


def test_small_payloads_may_stay_responses(spark):
    assert read(W.write_archives(pages(spark, ROWS), min_bytes=4)) == brute(ROWS, 4)


def test_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "pages")
    rows = [(r["page_id"], r["url"], r["html"]) for r in docs.collect()]
    assert read(W.write_archives(docs), split_bytes=20_000) == brute(rows)


def test_members_of_any_bytes_are_owned_once():
    """Stored (uncompressed) members full of gzip magics, even whole embedded
    archives' starts, and junk between members."""
    rng = random.Random(4)
    records, data = [], b""
    for i in range(60):
        body = W.MAGIC * rng.randrange(0, 50) + bytes(rng.randrange(256) for _ in range(rng.randrange(300)))
        text = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
        records.append(text)
        data += gzip.compress(text, rng.choice([0, 6])) + (W.MAGIC + b"junk" if i % 7 == 0 else b"")
    for size in (1, 7, 100, 1000, len(data)):
        got = [x for a in range(0, len(data), size)
               for x in W.owned(io.BytesIO(data), len(data), a, min(a + size, len(data)))]
        assert got == records


def test_revisits_carry_no_payload(spark):
    text = "z" * 5000
    manifest = W.write_archives(pages(spark, [(1, "u", text), (2, "u", text)]).coalesce(1))
    with W.open_shared(manifest.first()["path"], "rb") as f:
        raw = gzip.decompress(f.read())
    assert raw.count(text.encode()) == 1 and raw.count(b"WARC-Type: revisit") == 1


def test_empty_table(spark):
    manifest = W.write_archives(pages(spark, []))
    assert manifest.collect() == [] and W.read_archives(manifest).collect() == []
