"""Words and rolling hashes of UTF-8 text columns, whole batches at a time.

A batch of texts is one byte array with offsets.  Words are runs of bytes of
a 256-entry class table (every separator is ASCII, so runs of bytes are runs
of characters).  The hash of a span ``[s, e)`` of values ``v`` is the
polynomial ``sum v[i] * B**(i - s)`` modulo the prime 2**31 - 1, taken from
one prefix sum: ``(C[e] - C[s]) * B**-s``, so a rolling hash of any length
costs the same.  Two of them, with other bases and other parts of the values,
make 62 bits.  Modulo a prime, two spans of n values collide in one of them
for at most n of its bases, whatever their content (modulo a power of two,
some pairs collide for every base).  Bytes enter through a table of mixed
constants, and hashes are mixed again to 64 bits.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_PRIME = np.uint64((1 << 31) - 1)
_SHIFT = np.uint64(31)
_BASES = (0x2545F491, 0x5851F42D)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEP = 1 << 15
_powers = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo the prime for i < n (the table grows by doubling,
    once a process; 31 bits a number)."""
    have = _powers.get(base, np.ones(1, dtype=np.uint32))
    while len(have) < n:
        more = have.astype(np.uint64) * np.uint64(pow(base, len(have), int(_PRIME))) % _PRIME
        have = np.concatenate([have, more.astype(np.uint32)])
    _powers[base] = have
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes (one row at least), so temporary
    arrays stay small whatever the batch holds."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, broken at text boundaries."""
    n = len(mask)
    before = np.zeros(n, dtype=bool)
    before[1:] = mask[:-1]
    first = offsets[:-1]
    before[first[first < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = mask[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def _polynomial(part, n: int, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of n values; ``part(i, j)`` gives some of them, so that
    only the prefix sums are held whole."""
    total, power = np.zeros(n + 1, dtype=np.uint64), _power(base, n)
    for i in range(0, n, _STEP):
        j = min(n, i + _STEP)
        term = part(i, j) * power[i:j]
        total[i + 1:j + 1] = (term & _PRIME) + (term >> _SHIFT)  # the term modulo the prime, below 2**33
    np.cumsum(total, out=total)
    inverse = _power(pow(base, -1, int(_PRIME)), n + 1)
    return (total[ends] - total[starts]) % _PRIME * inverse[starts] % _PRIME


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """62-bit hashes of spans of 64-bit values (their low 62 bits count)."""
    n = len(values)
    one = _polynomial(lambda i, j: values[i:j] & _PRIME, n, _BASES[0], starts, ends)
    two = _polynomial(lambda i, j: (values[i:j] >> _SHIFT) & _PRIME, n, _BASES[1], starts, ends)
    return (one << _SHIFT) | two


_BYTE_PARTS = (_BYTE & _PRIME, (_BYTE >> _SHIFT) & _PRIME)


def byte_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of each byte span."""
    one, two = (_polynomial(lambda i, j, t=table: t[data[i:j]], len(data), base, starts, ends)
                for table, base in zip(_BYTE_PARTS, _BASES, strict=True))
    return mix64(((one << _SHIFT) | two) + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and hashes of all n-word windows inside each text;
    ``words``: offsets of the texts' words."""
    per = np.diff(words)
    count = np.maximum(per - n + 1, 0)
    total = int(count.sum())
    base = np.repeat(words[:-1] - (np.cumsum(count) - count), count)
    at = base + np.arange(total)
    return at, mix64(span_hashes(hashes, at, at + n))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the values that occur twice or more."""
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask over n positions of those inside ``[s, s + length)`` of a start."""
    step = np.zeros(n + 1, dtype=np.int32)
    step[starts] += 1
    np.subtract.at(step, starts + length, 1)
    return np.cumsum(step[:-1]) > 0


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each range ``[offsets[i], offsets[i + 1])``."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
