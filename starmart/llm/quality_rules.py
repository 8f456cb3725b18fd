"""Quality rules: repetition coverage.

Every whole text is cut into words ``[^\\x20\\x09-\\x0D]+``; rolling hashes of
several window lengths mark the windows that occur twice or more in the text,
and the characters of the words inside them are counted once (first
occurrences included), as are those of lines equal to an earlier line.  All
of it is one pass over Arrow batches in numpy: no shuffle, memory bounded by
a block of texts.

Defined results: a null or empty text has no words and fails; repeated rows
are judged alike, each by itself; an empty table gives an empty one; other
columns of the input are ignored (``repetition_scores``) or passed through
unchanged under their own names (``keep_unrepetitive``).  Very long texts are
processed whole.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starmart.llm import textnp as T
from starmart.llm.common import map_batches


@dataclass(frozen=True)
class Limits:
    """Shares above which the method rejects a text."""

    min_words: int = 20
    base_window: int = 8
    base_share: float = 0.30
    #: Window length in words -> largest share of the word characters inside
    #: windows that repeat.
    ngram_shares: dict[int, float] = field(
        default_factory=lambda: {5: 0.35, 10: 0.30})
    #: Largest share of the word characters in lines that repeat earlier ones.
    line_share: float = 0.30


DEFAULT = Limits()
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _block(data: np.ndarray, offsets: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    rows, n = len(offsets) - 1, len(data)
    is_word = T.NOT_SPACE[data]
    starts, ends = T.runs(is_word, offsets)
    words = np.searchsorted(starts, offsets)
    per = np.diff(words)
    point = np.zeros(n + 1, dtype=np.int64)  # code points before each byte
    np.cumsum((data & 0xC0) != 0x80, out=point[1:])
    chars = point[ends] - point[starts]
    salt = T.mix64(np.arange(1, rows + 1, dtype=np.uint64))
    hashes = T.byte_spans(data, starts, ends)
    out = {"n_words": per, "word_chars": T.sums(chars, words),
           "n_symbols": T.sums(_SYMBOL[data], offsets)}

    # Lines: texts and line breaks end them; those without a word don't count.
    l_starts, l_ends = T.runs(data != 10, offsets)
    first = np.searchsorted(starts, l_starts)
    l_chars = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(chars, out=l_chars[1:])
    l_chars = l_chars[np.searchsorted(starts, l_ends)] - l_chars[first]
    held = l_chars > 0
    l_starts, l_ends, l_chars = l_starts[held], l_ends[held], l_chars[held]
    lines = np.searchsorted(l_starts, offsets)
    keys = T.byte_spans(data, l_starts, l_ends) ^ np.repeat(salt, np.diff(lines))
    again = np.ones(len(keys), dtype=bool)
    again[np.unique(keys, return_index=True)[1]] = False
    out["n_dup_lines"] = T.sums(again, lines)
    out["dup_line_chars"] = T.sums(np.where(again, l_chars, 0), lines)

    text_of_word = np.repeat(salt, per)
    for length in {limits.base_window, *limits.ngram_shares}:
        at, keys = T.windows(hashes, words, length)
        found = T.covered(at[T.repeated(keys ^ text_of_word[at])], length, len(starts))
        if length == limits.base_window:
            out["n_repeat_words"] = T.sums(found, words)
        if length in limits.ngram_shares:
            out[f"dup_chars_{length}"] = T.sums(np.where(found, chars, 0), words)
    return out


def score_texts(column: pa.Array, limits: Limits = DEFAULT) -> dict[str, np.ndarray]:
    """The counts and verdicts of each text of a string column."""
    data, offsets = T.utf8(column)
    parts = [_block(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], limits)
             for i, j in T.blocks(offsets)] or [_block(data, offsets, limits)]
    out = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    words, chars = out["n_words"], out["word_chars"]
    share = round(100 * limits.base_share)
    out["base_failed"] = (words < limits.min_words) | (100 * out["n_repeat_words"] > share * words)
    bad = out["base_failed"] | (out["dup_line_chars"] > limits.line_share * chars)
    for length, most in limits.ngram_shares.items():
        bad = bad | (out[f"dup_chars_{length}"] > most * chars)
    out["kept"] = ~bad
    return out


def repetition_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      limits: Limits = DEFAULT) -> DataFrame:
    """One row for each input row: the id, the counts and the verdicts."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["dup_line_chars", *(f"dup_chars_{n}" for n in limits.ngram_shares)]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *(f"{c} long" for c in counts),
                        "base_failed boolean", "kept boolean", *(f"{c} long" for c in more)])

    def score(batch: pa.RecordBatch) -> dict:
        got = score_texts(batch.column(1), limits)
        return {id_col: batch.column(0)} | {
            c: pa.array(got[c]) for c in [*counts, "base_failed", "kept", *more]}

    return map_batches(docs.select(id_col, text_col), score, schema)


def keep_unrepetitive(docs: DataFrame, text_col: str = "text",
                      limits: Limits = DEFAULT) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged."""
    at = docs.columns.index(text_col)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(score_texts(batch.column(at), limits)["kept"]))

    return map_batches(docs, keep, docs.schema)
