"""Packing: vector bin packing by the dot-product heuristic.

Examples are tokenized and placed into sequences under three limits at once:
tokens, segments and loss-bearing tokens.  The next piece of a sequence is the
one whose demand vector has the largest dot product with the sequence's
remaining capacity (both in shares of the limits) among those that fit whole;
when none fits, one piece is cut to fill what is left.  Examples longer than a
sequence are cut into full ones first.  Pieces of equal demand are one class
with one score, so a placement costs by the lengths that occur, at most the
limit's, and not by the pieces that wait.

Plan: one pass, no shuffle.  A task streams its partition in blocks of a fixed
number of tokens, so memory doesn't grow with the partition, and carries the
pieces of the last open sequence into the next block: a partition ends in one
sequence that isn't full, the others have no padding unless the segment or
loss limit closes them.  Sequence ids are the partition's number and a
counter, so a retried task gives the same rows.

Defined results: null or empty text is the end id alone; a null id stays null;
repeated rows are packed each by itself; an empty table has no pieces; an
example of any length is cut; other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from starmart.llm.common import trimmed
from starmart.llm.textnp import LOWER, blocks, byte_spans, sums, utf8


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss: int = 4096
    #: Tokens packed at a time, and the least tokens worth a cut.
    block: int = 4 << 20
    cut: int = 16


DEFAULT = Limits()
END_ID = 2


SPACE, LETTER, SIGN, DIGIT = range(4)
#: Class of a byte: ASCII white space; letters (with U+00C0 to U+00FF, which
#: are two bytes that start with C3); digits, each a word; other signs.
KIND = np.full(256, SIGN, dtype=np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[48:58] = DIGIT
KIND[65:91] = KIND[97:123] = KIND[128:192] = KIND[0xC3] = LETTER
#: Bytes that don't occur in plain text: controls and other lead bytes.
OTHER = np.zeros(256, dtype=bool)
OTHER[0:9] = OTHER[14:32] = OTHER[127] = OTHER[192:256] = True
OTHER[0xC3] = False
#: Second letters of the tokenizer's contractions.
AFTER_QUOTE = np.zeros(256, dtype=bool)
AFTER_QUOTE[list(b"strvmldSTRVMLD")] = True


class WordEncoder:
    """Ids of a word-level BPE tokenizer file.

    The tokenizer works word by word, so each distinct word is encoded once
    (by the library) and kept under its hash, with its bytes: a word of equal
    hash and other bytes sends its text to the library.  Words are cut here by
    the tokenizer's own rule for plain texts: ASCII and Latin-1 letters,
    without contractions or special tokens.  Any other text is encoded whole
    by the library.
    """

    KEEP = 1 << 19  # words

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.hash = np.zeros(0, dtype=np.uint64)  # sorted, with place and size
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.raw = np.zeros(0, dtype=np.uint8)  # the words' bytes
        self.raw_at = np.zeros(0, dtype=np.int64)
        self.raw_size = np.zeros(0, dtype=np.int64)

    def _learn(self, hashes: np.ndarray, raw: list[bytes]) -> None:
        words = [x.decode() for x in raw]
        # One text of all new words: a word's last token carries the word end.
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype=np.uint32)
        end = np.flatnonzero(self.ends[ids]) + 1
        if len(end) != len(words):
            got = [x.ids for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            ids = np.array([i for x in got for i in x], dtype=np.uint32)
            end = np.cumsum([len(x) for x in got])
        size = np.diff(end, prepend=0)
        spot = np.searchsorted(self.hash, hashes)
        self.at = np.insert(self.at, spot, len(self.ids) + end - size)
        self.size = np.insert(self.size, spot, size)
        self.hash = np.insert(self.hash, spot, hashes)
        self.ids = np.concatenate([self.ids, ids])
        letters = np.array([len(x) for x in raw], dtype=np.int64)
        self.raw_at = np.insert(self.raw_at, spot, len(self.raw) + np.cumsum(letters) - letters)
        self.raw_size = np.insert(self.raw_size, spot, letters)
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(raw), dtype=np.uint8)])

    def _others(self, at: np.ndarray, letters: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Mask of the words (``data``: their bytes in a row) that aren't the
        kept word ``at``."""
        other = self.raw_size[at] != letters
        begin = np.cumsum(letters) - letters
        spot = np.repeat(self.raw_at[at] - begin, letters) + np.arange(len(data))
        wrong = np.flatnonzero(self.raw[np.minimum(spot, max(len(self.raw) - 1, 0))] != data) if len(data) else []
        other[np.searchsorted(begin, wrong, "right") - 1] = True
        return other

    @staticmethod
    def odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mask of the texts that the library has to encode whole."""
        odd = OTHER[data]
        if len(data):
            one, two = data[:-1], data[1:]
            odd[:-1] |= (one == 0xC3) & ((two == 0x97) | (two == 0xB7))
            odd[:-1] |= (one == ord("<")) & (two == ord("|"))
            odd[:-1] |= (one == ord("'")) & AFTER_QUOTE[two]
        return sums(odd, offsets) > 0

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """For each text (null: empty) its ids and then ``END_ID``, as uint32."""
        if len(self.hash) > self.KEEP:
            self._forget()
        data, offsets = utf8(column)
        odd = self.odd_texts(data, offsets)
        low = LOWER[data]
        upper = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.zeros(0, int)
        upper = upper[data[upper] < 0x9F]
        low[upper] += 0x20
        while True:
            kind = KIND[data]
            kind[np.repeat(odd, np.diff(offsets))] = SPACE
            before, after = np.zeros_like(kind), np.zeros_like(kind)
            before[1:], after[:-1] = kind[:-1], kind[1:]
            first, last = offsets[:-1], offsets[1:] - 1
            before[first[first < len(data)]] = SPACE
            after[last[last >= 0]] = SPACE
            starts = np.flatnonzero((kind != SPACE) & ((kind != before) | (kind == DIGIT)))
            ends = np.flatnonzero((kind != SPACE) & ((kind != after) | (kind == DIGIT))) + 1
            word, example, place = np.unique(byte_spans(low, starts, ends), return_index=True, return_inverse=True)
            at = np.searchsorted(self.hash, word)
            new = np.ones(len(word), dtype=bool)
            if len(self.hash):
                new = self.hash[np.minimum(at, len(self.hash) - 1)] != word
            if new.any():
                raw, some = low.tobytes(), example[new]
                self._learn(word[new], [raw[a:b] for a, b in zip(
                    starts[some].tolist(), ends[some].tolist(), strict=True)])
                at = np.searchsorted(self.hash, word)
            text = np.searchsorted(offsets, starts, "right") - 1
            other = self._others(at[place], ends - starts, low[kind != SPACE])
            if not other.any():
                break
            odd[text[other]] = True
        size = self.size[at][place]
        total = int(size.sum())
        source = np.repeat(self.at[at][place] - (np.cumsum(size) - size), size) + np.arange(total)
        out = np.full(total + len(column), END_ID, dtype=np.uint32)
        out[np.arange(total) + np.repeat(text, size)] = self.ids[source]
        bound = np.cumsum(np.bincount(text, weights=size, minlength=len(column)).astype(np.int64) + 1)
        got = np.split(out, bound[:-1]) if len(column) else []
        strange = np.flatnonzero(odd).tolist()
        for i, x in zip(strange, self.tokenizer.encode_batch([column[i].as_py() for i in strange],
                                                             add_special_tokens=False), strict=True):
            got[i] = np.array([*x.ids, END_ID], dtype=np.uint32)
        return got


_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """This process's encoder, so that tasks go on with the words it knows."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


@dataclass
class Pieces:
    """Pieces waiting for a place: example, first token, tokens, loss tokens
    (a piece's leading ``skip`` tokens bear no loss)."""

    example: np.ndarray
    start: np.ndarray
    tokens: np.ndarray
    skip: np.ndarray


def pack(pieces: Pieces, limits: Limits = DEFAULT) -> list[list[tuple[int, int, int]]]:
    """Sequences of (example, start, tokens); all are closed but the last."""
    most = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
    example, start = pieces.example.copy(), pieces.start.copy()
    tokens, skip = pieces.tokens.astype(np.int64), pieces.skip.astype(np.int64)
    sequences: list[list[tuple[int, int, int]]] = []

    # A piece over a limit fills sequences of its own until the rest fits.
    for i in np.flatnonzero((tokens > limits.tokens) | (tokens - skip > limits.loss)):
        while tokens[i] > limits.tokens or tokens[i] - skip[i] > limits.loss:
            n = min(limits.tokens, limits.loss + min(skip[i], limits.tokens))
            n = int(min(n, tokens[i]))
            sequences.append([(int(example[i]), int(start[i]), n)])
            start[i], tokens[i], skip[i] = start[i] + n, tokens[i] - n, max(0, skip[i] - n)
    waiting = _Waiting(limits)
    for i in np.flatnonzero(tokens > 0).tolist():
        waiting.add(int(example[i]), int(start[i]), int(tokens[i]), int(skip[i]))
    while waiting.left:
        room, now = most.copy(), []
        while waiting.left and room[0] > 0 and room[1] > 0:
            kind = waiting.best(room, most)
            if kind is not None:
                e, at = waiting.take(kind)
                n, bears = int(waiting.tokens[kind]), int(waiting.loss[kind])
            else:
                kind = waiting.longest()
                size, bare = int(waiting.tokens[kind]), int(waiting.skip[kind])
                n = int(min(size, room[0], room[2] + min(bare, room[0])))
                if n < limits.cut:
                    break
                e, at = waiting.take(kind)
                bears = max(0, n - bare)
                if n < size:
                    waiting.add(e, at + n, size - n, max(0, bare - n))
            now.append((e, at, n))
            room -= (n, 1, bears)
        sequences.append(now)
    return sequences


class _Waiting:
    """Pieces that wait for a place, by class: tokens and leading tokens
    without loss."""

    def __init__(self, limits: Limits):
        self.most = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
        self.place: dict[tuple[int, int], int] = {}
        self.pieces: list[list[tuple[int, int]]] = []
        self.used = self.left = 0
        self._room(256)

    def _room(self, n: int) -> None:
        old = self.__dict__.copy()
        self.tokens, self.skip, self.loss, self.count = (np.zeros(n, dtype=np.int64) for _ in range(4))
        self.demand = np.zeros((n, 3))
        if self.used:
            for k in ("tokens", "skip", "loss", "count", "demand"):
                getattr(self, k)[:self.used] = old[k][:self.used]

    def add(self, example: int, start: int, tokens: int, skip: int) -> None:
        kind = self.place.setdefault((tokens, skip), self.used)
        if kind == self.used:
            if kind == len(self.tokens):
                self._room(2 * kind)
            loss = max(tokens - skip, 0)
            self.tokens[kind], self.skip[kind], self.loss[kind] = tokens, skip, loss
            self.demand[kind] = np.array([tokens, 1, loss]) / self.most
            self.pieces.append([])
            self.used += 1
        self.pieces[kind].append((example, start))
        self.count[kind] += 1
        self.left += 1

    def take(self, kind: int) -> tuple[int, int]:
        self.count[kind] -= 1
        self.left -= 1
        return self.pieces[kind].pop()

    def best(self, room: np.ndarray, most: np.ndarray) -> int | None:
        """The class of largest dot product with the room among those that fit."""
        n = self.used
        fits = (self.count[:n] > 0) & (self.tokens[:n] <= room[0]) & (self.loss[:n] <= room[2])
        score = np.where(fits, self.demand[:n] @ (room / most), -1)
        kind = int(score.argmax())
        return kind if fits[kind] else None

    def longest(self) -> int:
        return int(np.where(self.count[:self.used] > 0, self.tokens[:self.used], -1).argmax())


SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           limits: Limits = DEFAULT, with_ids: bool = False) -> DataFrame:
    """One row for each piece; ``with_ids`` adds the piece's token ids.

    Every id but a document's first bears loss (nothing precedes the first).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {SCHEMA}" + (", ids array<int>" if with_ids else "")

    def emit(keys: list, ids: list[np.ndarray], sequences: list, first: int, like: pa.DataType):
        rows = [(e, s, n, first + q, o) for q, seq in enumerate(sequences)
                for (e, s, n), o in zip(seq, np.cumsum([0, *(p[2] for p in seq)]).tolist(), strict=False)]
        cut = [ids[e][s:s + n] for e, s, n, _, _ in rows]
        columns = {id_col: pa.array([keys[r[0]] for r in rows], like),
                   "start": [r[1] for r in rows], "length": [r[2] for r in rows],
                   "ids_crc32": [zlib.crc32(c.astype("<u4").tobytes()) for c in cut],
                   "doc_tokens": [len(ids[r[0]]) for r in rows],
                   "sequence_id": [r[3] for r in rows], "offset": [r[4] for r in rows]}
        columns = {k: v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for k, v in columns.items()}
        if with_ids:
            columns["ids"] = pa.array(cut, pa.list_(pa.int32()))
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        number = TaskContext.get().partitionId() << 40
        keys: list = []
        ids: list[np.ndarray] = []
        waiting: list[tuple[int, int, int]] = []  # example, start, tokens
        held, like = 0, None

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal keys, ids, waiting, held, number
            if not waiting:
                return
            e, s, n = (np.array(x, dtype=np.int64) for x in zip(*waiting, strict=True))
            sequences = pack(Pieces(e, s, n, (s == 0).astype(np.int64)), limits)
            rest = [] if last else sequences.pop()
            for i in range(0, len(sequences), 2000):
                yield emit(keys, ids, sequences[i:i + 2000], number + i, like)
            number += len(sequences)
            # The open sequence's pieces wait on with the next block.
            keep = sorted({p[0] for p in rest})
            place = {k: i for i, k in enumerate(keep)}
            keys, ids = [keys[k] for k in keep], [ids[k] for k in keep]
            waiting = [(place[a], b, c) for a, b, c in rest]
            held = sum(p[2] for p in rest)

        for batch in trimmed(batches):
            like = batch.schema.field(0).type
            _, offsets = utf8(batch.column(1))
            for i, j in blocks(offsets):
                for key, got in zip(batch.column(0).slice(i, j - i).to_pylist(),
                                    encoder.encode(batch.column(1).slice(i, j - i)), strict=True):
                    waiting.append((len(keys), 0, len(got)))
                    keys.append(key)
                    ids.append(got)
                    held += len(got)
                if held >= limits.block:
                    yield from flush(False)
        yield from flush(True)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
