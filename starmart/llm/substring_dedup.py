"""Substring dedup over sliding sentence spans.

A text is cut into sentences: after ``.``, ``!`` or ``?`` at the end of a word
and at line breaks; a sentence of more than ``LONG`` words counts as several
of that many words.  From every sentence the shortest run of two or more
consecutive sentences with at least ``LEAST`` words is hashed (and, so that
the end of a passage is covered too, the shortest such run up to every
sentence), whatever white space stands between them.  Runs are joined
globally by 128 bits; the first occurrence, by document id and then place,
keeps its sentences, and sentences inside any later one are removed.

Such runs miss a passage that starts or ends inside a sentence, or stands
elsewhere in a long or unpunctuated one.  With ``whole`` every run of 50 words
that stands earlier is removed as well, wherever sentences end
(:mod:`starmart.llm.passages`); the registered query asks for that.

Plan: runs are cut in numpy; a partial aggregation finds each run's first
occurrence before the shuffle, so a passage that a third of the documents
share arrives as one row a task; only runs that repeat are joined back (AQE
splits a skewed one).  Texts meet the sentences to remove on (id, hash of the
text); a bit filter of bounded size keeps texts without any where they are.

Defined results: null text stays null with no sentences; documents without a
run (short ones) stay as they are; rows that repeat id and text are the same
document and get the same result, one row each; null ids come last; empty
tables give empty results; other columns are ignored (``span_dedup``) or kept
(``without_repeats``).  Whole texts are used.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import textnp as T
from starmart.llm.common import freed, map_batches, written
from starmart.llm.passages import byte_ranges, passages
from starmart.operators.bloom import bit_filter

LEAST = 25  # words of a run
LONG = 40  # words of a sentence
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """Of a block of texts: sentences' byte starts and ends, their words, the
    offsets of each text's sentences."""
    starts, ends = T.runs(T.NOT_SPACE[data], offsets)
    words = np.searchsorted(starts, offsets)
    lines = np.cumsum(data == 10)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, words
    stop = _STOP[data[ends - 1]]
    stop[:-1] |= lines[starts[1:]] != lines[starts[:-1]]
    stop[words[1:][words[1:] > 0] - 1] = True
    first = np.flatnonzero(np.r_[True, stop[:-1]])
    length = np.diff(np.r_[first, len(starts)])
    pieces = -(-length // LONG)  # long sentences are several
    at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + at * LONG
    last = np.r_[first[1:], len(starts)] - 1
    return starts[first], ends[last], last - first + 1, np.searchsorted(first, words)


def text_runs(size: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentence of every run, distinct."""
    n = len(size)
    total = np.r_[0, np.cumsum(size)]
    i = np.arange(n)
    text = np.repeat(np.arange(len(texts) - 1), np.diff(texts))
    last = np.maximum(np.searchsorted(total, total[:-1] + LEAST, "left") - 1, i + 1)
    ahead = last < texts[text + 1]
    first = np.minimum(np.searchsorted(total, total[1:] - LEAST, "right") - 1, i - 1)
    back = first >= texts[text]
    pairs = np.unique(np.r_[i[ahead] * (n + 1) + last[ahead], first[back] * (n + 1) + i[back]])
    return pairs // (n + 1), pairs % (n + 1)


def runs_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2, id, kh, at, start, end): every run with its bytes; a run's
    range reaches to the next sentence, so removal leaves no gap."""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batch: pa.RecordBatch) -> dict:
        data, offsets = T.utf8(batch.column(1))
        parts: list[list[np.ndarray]] = []
        for i, j in T.blocks(offsets):
            d, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            s, e, size, texts = sentences(d, off)
            a, b = text_runs(size, texts)
            h = T.byte_spans(d, s, e)
            text = np.searchsorted(texts, a, "right") - 1
            after = np.where(b + 1 < texts[text + 1], s[np.minimum(b + 1, max(len(s) - 1, 0))], off[text + 1])
            parts.append([T.mix64(T.span_hashes(h, a, b + 1)), T.mix64(T.span_hashes(T.mix64(~h), a, b + 1)),
                          text + i, s[a] - off[text], after - off[text]])
        h1, h2, row, start, end = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (
            np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
        rows = pa.array(row.astype(np.int32))
        return {"h1": pa.array(h1.view(np.int64)), "h2": pa.array(h2.view(np.int64)),
                "id": batch.column(0).take(rows), "kh": batch.column(2).take(rows),
                "start": pa.array(start.astype(np.int32)), "end": pa.array(end.astype(np.int32))}

    return map_batches(docs.select(id_col, text_col, F.xxhash64(text_col).alias("kh")), cut,
                       f"h1 long, h2 long, id {kind}, kh long, start int, end int")


def repeats(docs: DataFrame, id_col: str, text_col: str, whole: bool = False) -> DataFrame:
    """(id, kh, cut, words): what to remove from each document, byte ranges of
    sentences and, with ``whole``, ranges of words."""
    found = passages(docs, id_col, text_col) if whole else None
    runs = runs_of(docs, id_col, text_col)
    place = F.struct(F.col("id").isNull().alias("last"), "id", "kh", "start")
    firsts = written(runs.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("other"))
                     .filter("first <> other").select("h1", "h2", "first"), "firsts")
    if whole:
        freed(docs.sparkSession)
    again = runs.join(firsts, ["h1", "h2"]).filter(place != F.col("first"))
    cuts = again.select("id", "kh", F.struct("start", "end").alias("span"), F.lit(None).cast("binary").alias("words"))
    if whole:
        cuts = cuts.unionByName(found, allowMissingColumns=True)
    cuts = written(cuts.groupBy("id", "kh").agg(F.array_sort(F.collect_set("span")).alias("cut"),
                                                F.collect_set("words").alias("words")), "cuts")
    if whole:
        freed(docs.sparkSession)
    return cuts


def merged(ranges: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for r in ranges:
        if out and r["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["end"])
        else:
            out.append([r["start"], r["end"]])
    return [(a, b) for a, b in out]


def _joined(docs: DataFrame, id_col: str, text_col: str, whole: bool) -> DataFrame:
    """``docs`` with two last columns, the ranges to remove (null: none); only
    rows that may have some (by a bit filter of bounded size) are moved."""
    cuts = repeats(docs, id_col, text_col, whole).select(
        F.col("id").alias("__llm_id"), F.col("kh").alias("__llm_kh"), F.col("cut").alias("__llm_cut"),
        F.col("words").alias("__llm_words"))
    same: Column = F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.xxhash64(text_col) == F.col("__llm_kh"))
    parted = bit_filter(cuts, "__llm_kh").passed(docs, F.xxhash64(text_col), "__llm_may")
    hit = parted.filter("__llm_may").join(cuts, same, "left").drop("__llm_id", "__llm_kh", "__llm_may")
    kinds = dict(cuts.dtypes)
    rest = parted.filter("not __llm_may").drop("__llm_may").select("*", *(
        F.lit(None).cast(kinds[c]).alias(c) for c in ("__llm_cut", "__llm_words")))
    return rest.unionByName(hit.select(*rest.columns))


def _ranges(text: str, cut: list[dict], words: list[bytes]) -> list[tuple[int, int]]:
    """Merged byte ranges to remove from a text."""
    if not words:
        return merged(cut)
    return merged(sorted(cut + byte_ranges(text, words), key=lambda r: (r["start"], r["end"])))


def _cut_text(text: str, ranges: list[tuple[int, int]]) -> tuple[str, int]:
    raw, out, at, gone = text.encode(), [], 0, 0
    for a, b in ranges:
        out.append(raw[at:a])
        at, gone = b, gone + b - a
    return b"".join([*out, raw[at:]]).decode(), gone


def span_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(id, n_sentences, n_removed, removed_bytes, text) of every row: the
    text without what repeats earlier documents; ``n_removed`` counts the
    sentences that lost words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def apply(batch: pa.RecordBatch) -> dict:
        data, offsets = T.utf8(batch.column(1))
        n, removed, size, texts = [], [], [], []
        for i, j in T.blocks(offsets):
            s, e, _, of = sentences(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            for r in range(i, j):
                text, cut = batch.column(1)[r].as_py(), batch.column(2)[r].as_py()
                own, own_end = (x[of[r - i]:of[r - i + 1]] - (offsets[r] - offsets[i]) for x in (s, e))
                n.append(len(own))
                if cut is None:
                    removed.append(0)
                    size.append(0)
                else:
                    ranges, lost = _ranges(text, cut, batch.column(3)[r].as_py()), np.zeros(len(own), dtype=bool)
                    for a, b in ranges:
                        lost[np.searchsorted(own_end, a, "right"):np.searchsorted(own, b)] = True
                    removed.append(int(lost.sum()))
                    text, gone = _cut_text(text, ranges)
                    size.append(gone)
                texts.append(text)
        return {id_col: batch.column(0), "n_sentences": pa.array(n, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "removed_bytes": pa.array(size, pa.int64()),
                "text": pa.array(texts, pa.string())}

    joined = _joined(docs.select(id_col, text_col), id_col, text_col, whole)
    return map_batches(joined, apply, f"`{id_col}` {kind}, n_sentences long, n_removed long, "
                       "removed_bytes long, text string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    whole: bool = False) -> DataFrame:
    """``docs`` with the cut texts, all other columns unchanged."""
    at, width = docs.columns.index(text_col), len(docs.columns)

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.as_py() if c.as_py() is None else
                 _cut_text(t.as_py(), _ranges(t.as_py(), c.as_py(), w.as_py()))[0]
                 for t, c, w in zip(batch.column(at), batch.column(width), batch.column(width + 1), strict=True)]
        out = batch.select(list(range(width)))
        return out.set_column(at, out.schema.field(at), pa.array(texts, out.schema.field(at).type))

    return map_batches(_joined(docs, id_col, text_col, whole), apply, docs.schema)
