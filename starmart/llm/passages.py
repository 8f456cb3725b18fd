"""Repeated passages: every run of ``LEAST`` words that stands earlier too.

Words are runs of bytes that aren't white space; each character of a script
written without spaces (Thai to Khmer, ideographs, kana) is a word.  A window
of ``LEAST`` words that occurs at an earlier place, by document id and then
position, is cut, wherever sentences begin or end; of windows that overlap
their own first occurrence only the words behind it are cut.

1. *Fingerprints.*  Of every ``LEAST - GRAM + 1`` consecutive hashes of
   ``GRAM`` words the smallest is kept (winnowing), so equal windows always
   hold an equal one.  They are dealt by hash, packed as arrays; repeated ones
   come back as places of their texts.  Copies of a text count once.
2. *Windows.*  Only windows around those places are hashed (80 bits) and
   dealt; all but the first occurrence are cut.  A text's own repeats are
   settled where it is read.
3. *Ranges.*  The cut windows of a text meet and are merged.

Texts meet their places in one join at every size, behind a bit filter of
bounded size that keeps the others where they are.  A fingerprint that is frequent in a pack of texts is sent once a pack, and so
is a window, for the least of the pack's texts; the others' are cut there.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import textnp as T
from starmart.llm.common import content_key, freed, map_batches, trimmed, written
from starmart.operators.bloom import bit_filter

LEAST = 50  # words of a passage
GRAM = 16  # words of a fingerprint
PACK_BYTES = 4 << 20
TASK_BYTES = 16 << 20
#: Stands for all words of a text that has a passage.
WHOLE = np.array([0, 2**31 - 1], dtype=np.int32).tobytes()


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block of texts."""
    starts, ends = T.runs(T.NOT_SPACE[data], offsets)
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead):
        return starts, ends
    a, b, c = data[lead].astype(int), data[lead + 1].astype(int), data[lead + 2].astype(int)
    own = ((a == 0xE0) & (b >= 0xB8)  # Thai, Lao
           | (a == 0xE1) & ((b <= 0x81) | (b == 0x82) & (c <= 0x9F) | (b == 0x9E) | (b == 0x9F))  # Myanmar, Khmer
           | (a == 0xE2) & (b >= 0xBA) | (a >= 0xE3) & (a <= 0xE9) | (a == 0xEA) & (b <= 0x93)
           | (a == 0xEF) & ((b >= 0xA4) & (b <= 0xAB) | (b >= 0xBC) & (b <= 0xBE))
           | (a == 0xF0) & (b >= 0xA0) & (b <= 0xB3))
    lead = lead[own]
    after = lead + np.where(a[own] == 0xF0, 4, 3)
    first = np.union1d(starts, np.r_[lead, after[~np.isin(after, ends)]])
    run = np.searchsorted(starts, first, "right") - 1
    return first, np.minimum(np.r_[first[1:], len(data)], ends[run])


def _slide(x: np.ndarray, n: int, op: np.ufunc) -> np.ndarray:
    """``op`` over each ``x[i:i + n]``."""
    k = 1
    while 2 * k <= n:
        x, k = op(x[:-k], x[k:]), 2 * k
    return op(x[:len(x) - (n - k)], x[n - k:])


def minima(grams: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Mask of the grams that are the smallest of some window of their text."""
    w = LEAST - GRAM + 1
    if len(grams) < w:
        return np.zeros(len(grams), dtype=bool)
    least = _slide(grams, w, np.minimum)
    least[text[:len(least)] != text[w - 1:]] = 0
    pad = np.zeros(w - 1, dtype=np.uint64)
    most = _slide(np.r_[pad, least, pad], w, np.maximum)
    return (most == grams) & (most > 0)


def _packs(columns: dict[str, np.ndarray], keys: np.ndarray, buckets: int) -> Iterator[tuple]:
    """(bucket, bytes of each column) of rows dealt by key, their order kept."""
    place = (T.mix64(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    edges = np.searchsorted(place[order], np.arange(buckets + 1))
    dealt = [c[order] for c in columns.values()]
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), *(c[edges[b]:edges[b + 1]].tobytes() for c in dealt)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    kinds = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)


def _read(batches: Iterator[pa.RecordBatch], kinds: list) -> list[np.ndarray]:
    """The columns of packed rows behind the bucket, each in one array."""
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for batch in trimmed(batches):
        for k, kind in enumerate(kinds):
            parts[k] += [np.frombuffer(x, dtype=kind) for x in batch.column(k + 1).to_pylist()]
    return [np.concatenate([np.zeros(0, dtype=kind), *p]) for p, kind in zip(parts, kinds, strict=True)]


def _groups(keys: np.ndarray) -> np.ndarray:
    """Edges of the runs of equal keys."""
    return np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)] if len(keys) else np.zeros(1, int)


def _by_text(kh: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((at, kh))
    kh, at = kh[order], at[order]
    edges = _groups(kh)
    for i in range(0, len(edges) - 1, 1 << 14):
        own = edges[i:i + (1 << 14) + 1]
        yield pa.RecordBatch.from_pydict({
            "kh": pa.array(kh[own[:-1]], pa.int64()),
            "at": pa.array([at[a:b].tobytes() for a, b in zip(own[:-1], own[1:], strict=True)], pa.binary())})


# --- 1: fingerprints ----------------------------------------------------------

def places(docs: DataFrame, text_col: str, total: int) -> DataFrame:
    """(kh, at): positions in words of repeated fingerprints, some rows a text."""
    tasks = _tasks(docs, total * 0.3)
    names = ["bucket", "f", "kh", "at", "marks", "hit", "hit_at"]

    def pack(data: np.ndarray, offsets: np.ndarray, kh: np.ndarray) -> pa.RecordBatch:
        starts, ends = tokens(data, offsets)
        words = np.searchsorted(starts, offsets)
        at, grams = T.windows(T.byte_spans(data, starts, ends), words, GRAM)
        text = np.searchsorted(words, at, "right") - 1
        once = np.zeros(len(kh), dtype=bool)
        once[np.unique(kh, return_index=True)[1]] = True
        kept = np.flatnonzero(minima(grams, text) & once[text])
        f, text, at = grams[kept], text[kept], (at - words[text])[kept].astype(np.int32)
        twice = T.repeated(f)
        own, marks = ~twice, np.unique(f[twice])
        rows = [(b, *x, b"", b"", b"") for b, *x in _packs({"f": f[own], "kh": kh[text[own]], "at": at[own]},
                                                           f[own], 4 * tasks)]
        rows += [(b, b"", b"", b"", x, b"", b"") for b, x in _packs({"marks": marks}, marks, 4 * tasks)]
        hit = kh[text[twice]]
        rows += [(b, b"", b"", b"", b"", *x) for b, *x in
                 _packs({"hit": hit, "hit_at": at[twice]}, hit.view(np.uint64), 4 * tasks)]
        return _batch(rows, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            data, offsets = T.utf8(batch.column(0))
            kh = batch.column(1).to_numpy()
            for i, j in T.blocks(offsets, PACK_BYTES):
                yield pack(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], kh[i:j])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, kh, at, marks, hit, hit_at = _read(batches, [np.uint64, np.int64, np.int32, np.uint64, np.int64, np.int32])
        order = np.lexsort((at, kh, f))
        f, kh, at = f[order], kh[order], at[order]
        same = (f[1:] == f[:-1]) & (kh[1:] == kh[:-1]) & (at[1:] == at[:-1])
        once = np.r_[True, ~same][:len(f)]
        f, kh, at = f[once], kh[once], at[once]
        again = T.repeated(f) | np.isin(f, marks) if len(f) else np.zeros(0, bool)
        yield from _by_text(np.r_[kh[again], hit], np.r_[at[again], hit_at])

    packed = docs.select(text_col, F.xxhash64(text_col).alias("kh")).mapInArrow(
        run, "bucket int, " + ", ".join(f"{n} binary" for n in names[1:]))
    return packed.repartition(tasks, "bucket").mapInArrow(meet, "kh long, at binary")


# --- 2, 3: windows and their ranges -------------------------------------------

def ranges(texts: DataFrame, hits: int) -> DataFrame:
    """(rank, words): merged ranges, as pairs of word positions, to cut of the
    rows (text, rank, at) of texts that stand in the order of ``rank``."""
    tasks = _tasks(texts, hits * 22 * (LEAST - GRAM + 2) / 2)
    names = ["bucket", "h", "check", "rank", "at", "cut", "cut_at", "size"]

    def deal(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray, found: list) -> pa.RecordBatch:
        starts, ends = tokens(data, offsets)
        words = np.searchsorted(starts, offsets)
        hashes = T.byte_spans(data, starts, ends)
        at, h = T.windows(hashes, words, LEAST)
        text = np.searchsorted(words, at, "right") - 1
        step = np.zeros(len(starts) + 1, dtype=np.int32)
        for r, own in enumerate(found):
            q = np.frombuffer(own, dtype=np.int32).astype(np.int64) + words[r]
            np.add.at(step, np.maximum(q + GRAM - LEAST, words[r]), 1)
            np.subtract.at(step, q + 1, 1)
        near = np.flatnonzero((np.cumsum(step[:-1]) > 0)[at])
        text, h, first = text[near], h[near], at[near]
        check = (T.mix64(T.span_hashes(T.mix64(~hashes), first, first + LEAST)) >> np.uint64(48)).astype(np.uint16)
        at = (first - words[text]).astype(np.int32)
        order = np.lexsort((at, h, text))
        text, h, at, check = text[order], h[order], at[order], check[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (text[1:] != text[:-1])][:len(h)]
        begin = at[new][np.cumsum(new) - 1]
        start = np.maximum(at, begin + LEAST)[~new]
        size, of = (at[~new] + LEAST - start).astype(np.uint8), rank[text[~new]]
        # Of the texts of this pack that hold a window only the least goes on:
        # the others are cut, wherever the first of all stands.
        h, check, owner, at = h[new], check[new], rank[text[new]], at[new]
        order = np.lexsort((owner, check, h))
        h, check, owner, at = h[order], check[order], owner[order], at[order]
        lead = np.r_[True, (h[1:] != h[:-1]) | (check[1:] != check[:-1])][:len(h)]
        start, of = np.r_[start, at[~lead]], np.r_[of, owner[~lead]]
        size = np.r_[size, np.full(int((~lead).sum()), LEAST, dtype=np.uint8)]
        rows = [(b, *x, b"", b"", b"") for b, *x in _packs(
            {"h": h[lead], "check": check[lead], "rank": owner[lead], "at": at[lead]}, h[lead], 4 * tasks)]
        rows += [(b, b"", b"", b"", b"", *x) for b, *x in _packs(
            {"cut": of, "cut_at": start.astype(np.int32), "size": size}, of.view(np.uint64), 4 * tasks)]
        return _batch(rows, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            data, offsets = T.utf8(batch.column(0))
            rank, found = batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for i, j in T.blocks(offsets, PACK_BYTES):
                yield deal(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], rank[i:j], found[i:j])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, check, rank, at, cut, cut_at, size = _read(
            batches, [np.uint64, np.uint16, np.int64, np.int32, np.int64, np.int32, np.uint8])
        order = np.lexsort((rank, check, h))
        h, check, rank, at = h[order], check[order], rank[order], at[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (check[1:] != check[:-1])][:len(h)]
        lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(h) else np.zeros(0, int)
        gone = rank != rank[lead]
        cut, cut_at = np.r_[cut, rank[gone]], np.r_[cut_at, at[gone]]
        size = np.r_[size, np.full(int(gone.sum()), LEAST, dtype=np.uint8)]
        order = np.lexsort((cut_at, cut))
        cut, cut_at, size = cut[order], cut_at[order], size[order]
        yield _batch(list(_packs({"cut": cut, "at": cut_at, "size": size}, cut.view(np.uint64), 4 * tasks)),
                     ["bucket", "cut", "at", "size"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, at, size = _read(batches, [np.int64, np.int32, np.uint8])
        order = np.lexsort((at, rank))
        rank, at = rank[order], at[order]
        end = at + size[order].astype(np.int32)
        edges = _groups(rank)
        out = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            reach = np.maximum.accumulate(end[a:b])
            first = np.flatnonzero(np.r_[True, at[a + 1:b] > reach[:-1]])
            out.append(np.stack([at[a:b][first], reach[np.r_[first[1:] - 1, b - a - 1]]], axis=1).tobytes())
        for i in range(0, len(out), 1 << 14):
            yield pa.RecordBatch.from_pydict({"rank": pa.array(rank[edges[:-1]][i:i + (1 << 14)], pa.int64()),
                                              "words": pa.array(out[i:i + (1 << 14)], pa.binary())})

    dealt = texts.mapInArrow(run, "bucket int, " + ", ".join(f"{n} binary" for n in names[1:]))
    cuts = dealt.repartition(tasks, "bucket").mapInArrow(later, "bucket int, cut binary, at binary, size binary")
    return cuts.repartition(tasks, "bucket").mapInArrow(merge, "rank long, words binary")


def _tasks(df: DataFrame, size: float) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / TASK_BYTES))


def _once(batch: pa.RecordBatch) -> dict:
    """Each text's places, sorted, in one array."""
    at = [np.unique(np.frombuffer(b"".join(x), dtype=np.int32)).tobytes() for x in batch.column(1).to_pylist()]
    return {"kh": batch.column(0), "at": pa.array(at, pa.binary())}


def passages(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, kh, words): what to cut of each document, ``kh`` the hash of its
    text; ``WHOLE`` for the later documents of equal texts."""
    kh = F.xxhash64(text_col).alias("kh")
    # Copies are told by 128 bits, as all their text goes.
    keys = written(docs.select(F.col(id_col).alias("id"), kh, content_key(F.col(text_col)).alias("key"),
                               F.octet_length(text_col).alias("size")), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    place = F.struct(F.col("id").isNull().alias("last"), "id")
    firsts = written(keys.groupBy("kh", "key").agg(F.min(place).alias("first"), F.max(place).alias("other")), "firsts")
    found = written(places(docs, text_col, total).groupBy("kh").agg(F.collect_list("at").alias("at")), "places")
    freed(docs.sparkSession)
    found = map_batches(found, _once, "kh long, at binary").join(firsts, "kh").select(
        F.col("first.last").alias("last"), F.col("first.id").alias("id"), "kh", "at")
    hits = written(found.orderBy("last", "id", "kh").withColumn("rank", F.monotonically_increasing_id()), "hits")
    count, size = hits.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("at")), F.lit(0))).first()
    own = hits.select(F.col("id").alias("__llm_id"), F.col("kh").alias("__llm_kh"), "rank", "at")
    same = (F.xxhash64(text_col) == F.col("__llm_kh")) & F.col(id_col).eqNullSafe(F.col("__llm_id"))
    # Only texts that may have places move to meet them.
    texts = bit_filter(own, "__llm_kh", count).passed(docs.select(id_col, text_col), F.xxhash64(text_col), "__llm_may")
    texts = texts.filter("__llm_may").join(own, same)
    cut = ranges(texts.select(text_col, "rank", "at"), size // 4)
    copies = (keys.filter(F.col("size") >= LEAST).join(firsts.filter("first <> other"), ["kh", "key"])
              .filter(place != F.col("first"))
              .select("id", "kh", F.lit(WHOLE).alias("words")))
    cut = cut.join(hits.select("rank", "id", "kh"), "rank").select("id", "kh", "words")
    out = written(cut.unionByName(copies), "passages")
    freed(docs.sparkSession)
    return out


def byte_ranges(text: str, words: list[bytes]) -> list[dict]:
    """The byte ranges of ranges of words; each reaches to the next word."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    starts, _ = tokens(data, np.array([0, len(data)]))
    if len(starts) < LEAST:
        return []
    edge = np.r_[starts, len(data)]
    pairs = np.minimum(np.frombuffer(b"".join(words), dtype=np.int32).reshape(-1, 2), len(starts))
    return [{"start": int(edge[a]), "end": int(edge[b])} for a, b in pairs]
