"""Spelling variants: words one edit apart, found in FM-indexes.

Search scheme for one error: cut a word in two halves; the error lies in one
of them, so the other half stands unchanged at the same end of the near word.
One search matches the right half exactly and then extends to the left across
the other half, allowing one error; the other does the same from the left.
Each works on an FM-index of the delimited vocabulary, read right to left or
left to right: a state is an interval of suffix ranks, extended by one
character through the occurrence table of the Burrows-Wheeler transform, for
all words of a batch at once.

Only a substitution or an insertion is searched: of two near words of
different length the shorter finds the longer, and the pair counts for both.
A substitution has one place; of the places that insert equally the leftmost
counts.  So each pair is found exactly once over both searches.

Plan: words are counted in the tasks and added up in one shuffle.  For each
direction the vocabulary is cut into blocks of about ``block`` words, in the
order (length, word read from its exact end), at bounds from a hash sample of
the words; the words that can hold a half are one range of that order, and a
query goes to the blocks that its two ranges (same length, one longer) meet.
A task streams a block's words, builds their index, then streams the queries;
only counts and the best partner of each word leave it.  Halves that very many
words share are spread over as many blocks.  A chain of forms grows at least
tenfold in count a step, so pointer doubling ends after a few rounds.

Defined results: a null text has no words; a null id counts as the empty text
in the hash that deletes; repeated rows count each; an empty table gives an
empty result; other columns are ignored; very long texts and words are
treated whole.  Ties of count: the smaller word in code-point order.
"""
from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import trimmed, written

LEFT, RIGHT = 0, 1  # the half that is matched exactly


@dataclass(frozen=True)
class Spelling:
    """Words of ``letters`` code points and ``least`` occurrences or more; a
    form has at least ``ratio`` times the word's count.  One run in ``every``
    (by the hash of its id and run) loses a letter.  ``block``: words an
    index holds, about."""

    letters: int = 7
    least: int = 2
    ratio: int = 10
    every: int = 31
    block: int = 16_384
    held: int = 300_000


DEFAULT = Spelling()


def words_of(doc_id: object, text: bytes, runs: re.Pattern, spec: Spelling) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text."""
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs.findall(text.lower().decode())).items():
        h = crc32(run.encode(), start)
        if h % spec.every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < spec.letters:
                continue
        yield run, n


def vocabulary(docs: DataFrame, id_col: str, text_col: str, spec: Spelling) -> DataFrame:
    """(word, n) of every word with ``least`` occurrences or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shorter runs can't become words, so they aren't matched.
        runs = re.compile(f"[a-zÀ-ÿ]{{{spec.letters},}}")
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()),
                                              "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return out

        for batch in trimmed(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(),
                                    strict=True):
                for word, n in words_of(doc_id, text, runs, spec):
                    held[word] += n
                if len(held) >= spec.held:
                    yield sent()
        yield sent()

    texts = docs.select(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    return (texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= spec.least))


class FmIndex:
    """Suffix ranks of ``$w1$w2...`` (cyclic), for words read backwards.

    ``words`` are distinct.  ``occ[i]`` holds, for each character, how many
    of the first ``i`` entries of the transform are that character.
    """

    def __init__(self, words: list[str]):
        text = np.frombuffer(("$" + "$".join(words)).encode("utf-32-le"), dtype=np.uint32)
        self.letters, code = np.unique(text, return_inverse=True)  # '$' is code 0
        n, sigma = len(text), len(self.letters)
        bits = max(1, int(sigma - 1).bit_length())
        width = 62 // bits
        key = np.zeros(n, dtype=np.int64)
        for i in range(width):
            key = (key << bits) | np.roll(code, -i)
        while True:  # ranks of the first ``width`` characters, doubled until all differ
            order = np.argsort(key, kind="stable")
            new = np.ones(n, dtype=np.int64)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(new) - 1
            if rank[order[-1]] == n - 1:
                break
            key = rank * n + np.roll(rank, -width)
            width *= 2
        last = code[order - 1]
        self.occ = np.zeros((n + 1, sigma), dtype=np.int32)
        self.occ[np.arange(1, n + 1), last] = 1
        np.cumsum(self.occ, axis=0, out=self.occ)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=sigma))[:-1]]).astype(np.int32)
        self.count = np.int32(len(words))
        # Suffixes that start with '$' come first; each belongs to the word behind it.
        starts = np.flatnonzero(code == 0)
        self.word = np.searchsorted(starts, order[:len(words)])

    def codes(self, words: list[str]) -> np.ndarray:
        """Characters of words of one length as codes; -1: not in the index."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)
        at = np.minimum(np.searchsorted(self.letters, chars), len(self.letters) - 1)
        return np.where(self.letters[at] == chars, at, -1)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The intervals with ``c`` in front, and which of them are left."""
        safe = np.maximum(c, 0)
        first = self.first[safe]
        lo, hi = first + self.occ[lo, safe], first + self.occ[hi, safe]
        left = np.flatnonzero((c >= 0) & (lo < hi))
        return left, lo[left], hi[left]

    def near(self, words: list[str], exact: int, edge: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query, index word, inserted) for queries of one length.

        The last ``exact`` characters match; one error lies before them.
        ``edge``: an insertion right before the exact part counts too, and of
        equal insertions the one farthest to the right (else to the left).
        """
        codes = self.codes(words)
        length = codes.shape[1]
        q = np.arange(len(words))
        lo = np.zeros(len(words), dtype=np.int32)
        hi = np.full(len(words), self.count, dtype=np.int32)
        for j in range(length - 1, length - exact - 1, -1):
            left, lo, hi = self.extend(codes[q, j], lo, hi)
            q = q[left]
        none = np.zeros(0, dtype=np.int64)
        q1, lo1, hi1, ins1 = none, none.astype(np.int32), none.astype(np.int32), none.astype(bool)
        for p in range(length - exact, -1, -1):
            # Every character in front of the states without an error.
            lows, highs = self.first + self.occ[lo], self.first + self.occ[hi]
            state, c = np.nonzero(lows[:, 1:] < highs[:, 1:])
            c += 1
            low, high = lows[state, c], highs[state, c]
            if edge or p < length - exact:
                if edge:
                    fresh = codes[q[state], p] != c
                else:
                    fresh = codes[q[state], p - 1] != c if p else np.ones(len(c), dtype=bool)
                q1 = np.concatenate([q1, q[state[fresh]]])
                lo1, hi1 = np.concatenate([lo1, low[fresh]]), np.concatenate([hi1, high[fresh]])
                ins1 = np.concatenate([ins1, np.ones(int(fresh.sum()), dtype=bool)])
            if p == 0:
                break
            left, lo1, hi1 = self.extend(codes[q1, p - 1], lo1, hi1)
            q1, ins1 = q1[left], ins1[left]
            other = codes[q[state], p - 1] != c
            q1 = np.concatenate([q1, q[state[other]]])
            lo1, hi1 = np.concatenate([lo1, low[other]]), np.concatenate([hi1, high[other]])
            ins1 = np.concatenate([ins1, np.zeros(int(other.sum()), dtype=bool)])
            left, lo, hi = self.extend(codes[q, p - 1], lo, hi)
            q = q[left]
        left, lo1, _ = self.extend(np.zeros(len(q1), dtype=np.int64), lo1, hi1)
        return q1[left], self.word[lo1], ins1[left]


def _exact(length: int, side: int) -> int:
    return length // 2 if side == LEFT else length - length // 2


def _key(word: str, side: int) -> str:
    """The word read from its exact end."""
    return word if side == LEFT else word[::-1]


def block_bounds(words: DataFrame, spec: Spelling) -> dict[int, list[tuple[int, str]]]:
    """First keys of the blocks of each direction: every 32nd of a hash
    sample of one word in ``block / 32`` (so the driver holds one word in
    that many)."""
    rate = max(1, spec.block // 32)
    some = [r[0] for r in words.filter(F.crc32("word") % rate == 0).select("word").collect()]
    step = max(1, spec.block // rate)
    return {side: sorted((len(w), _key(w, side)) for w in some)[step::step] for side in (LEFT, RIGHT)}


def visits(word: str, side: int, bounds: list[tuple[int, str]]) -> set[int]:
    """The blocks that may hold near words of ``word``, of its length or one
    more, whose exact half is the word's."""
    key = _key(word, side)
    half = key[:_exact(len(key), side)]
    found = set()
    for length in (len(key), len(key) + 1):
        first = bisect_right(bounds, (length, half))
        last = bisect_left(bounds, (length, half + "\U0010ffff"))
        found.update(range(first, last + 1))
    return found


def _best(pairs: list[tuple[str, str, int]]) -> dict:
    """One row for each word: near words counted, the best of them."""
    count: Counter = Counter()
    best: dict[str, tuple[int, str]] = {}
    for word, other, n in pairs:
        count[word] += 1
        have = best.get(word)
        if have is None or (-n, other) < have:
            best[word] = (-n, other)
    return {"word": pa.array(list(best), pa.string()), "near": pa.array([count[w] for w in best], pa.int64()),
            "n": pa.array([-b[0] for b in best.values()], pa.int64()),
            "other": pa.array([b[1] for b in best.values()], pa.string())}


def found_near(index: FmIndex, known: list[tuple[str, int]], asked: list[tuple[str, int]], side: int) -> dict:
    """Near words between a block and a batch of queries, by word."""
    pairs: list[tuple[str, str, int]] = []
    lengths: dict[int, list[int]] = {}
    for i, (word, _) in enumerate(asked):
        lengths.setdefault(len(word), []).append(i)
    for length, rows in lengths.items():
        exact = _exact(length, side)
        step = max(1, min(4096, (1 << 22) // length))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            # Searches read backwards, so keys from the left are turned.
            texts = [_key(asked[i][0], side)[::-1] for i in some]
            for q, w, inserted in zip(*(x.tolist() for x in index.near(texts, exact, side == LEFT)), strict=True):
                word, n = asked[some[q]]
                other, m = known[w]
                pairs.append((word, other, m))
                if inserted:
                    pairs.append((other, word, n))
    return _best(pairs)


def near_words(words: DataFrame, spec: Spelling = DEFAULT) -> DataFrame:
    """(word, n_near, best_n, best): of words with near words, how many and
    the one of largest count."""
    bounds = block_bounds(words, spec)
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            block, query, text, count = [], [], [], []
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for side in (LEFT, RIGHT):
                    home = bisect_right(bounds[side], (len(word), _key(word, side)))
                    meets = visits(word, side, bounds[side])
                    block += [2 * b + side for b in (home, *meets)]
                    query += [False] + [True] * len(meets)
                    text += [word] * (1 + len(meets))
                    count += [n] * (1 + len(meets))
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(block, pa.int32()), "query": pa.array(query, pa.bool_()),
                "word": pa.array(text, pa.string()), "n": pa.array(count, pa.int64())})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, asked, index = -1, [], [], None

        def answer() -> Iterator[pa.RecordBatch]:
            nonlocal index
            if asked and known:
                index = index or FmIndex([_key(w, now % 2)[::-1] for w, _ in known])
                out = found_near(index, known, asked, now % 2)
                if len(out["word"]):
                    yield pa.RecordBatch.from_pydict(out)
            asked.clear()

        for batch in trimmed(batches):
            for block, query, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != now:
                    yield from answer()
                    now, known, index = block, [], None
                if query:
                    asked.append((word, n))
                    if len(asked) >= 16_384:
                        yield from answer()
                else:
                    known.append((word, n))
        yield from answer()

    dealt = words.select("word", "n").mapInArrow(deal, "block int, query boolean, word string, n long")
    met = dealt.repartition(tasks, "block").sortWithinPartitions("block", "query")
    found = met.mapInArrow(search, "word string, near long, n long, other string")
    return (found.groupBy("word")
            .agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "other")).alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.other").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each chain of forms.

    Round by round a word's link jumps to its link's link, so chains (which
    are short: counts grow along them) halve.  Ends when no link moves.
    """
    links = written(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = written(links.join(ahead, "root", "left")
                        .select("word", F.coalesce("_next", "root").alias("root"),
                                F.col("_next").isNotNull().alias("moved")), "links")
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return links


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    spec: Spelling = DEFAULT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = written(vocabulary(docs, id_col, text_col, spec), "vocabulary")
    form = F.when(F.col("best_n") >= spec.ratio * F.col("n"), F.col("best"))
    each = written(words.join(near_words(words, spec), "word", "left").select(
        "word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(form.isNotNull(), F.col("best_n")).alias("form_n")), "forms")
    ends = roots(each.filter("form is not null"))
    return (each.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


__all__ = ["DEFAULT", "FmIndex", "Spelling", "near_words", "spelling_groups"]
