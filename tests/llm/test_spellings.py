"""Spelling variants against comparing all pairs."""
import random
import re
from collections import Counter
from dataclasses import replace
from zlib import crc32

import pytest

from starmart.llm.spellings import DEFAULT, LEFT, RIGHT, FmIndex, _exact, _key, roots, spelling_groups

from .data import DOCS, ODD, frame


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, spec):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % spec.every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= spec.letters:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= spec.least}
    form, seen = {}, {}
    for w, n in count.items():
        others = [(-count[v], v) for v in count if near(w, v)]
        seen[w] = len(others)
        best = min(others, default=(0, None))
        form[w] = best[1] if -best[0] >= spec.ratio * n else None
    out = []
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, seen[w], count[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed=5):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abÀÿé") for _ in range(rng.randrange(6, 12))) for _ in range(60)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababa", "bababab", "Aaaaaaa"]
    texts = []
    for _ in range(250):
        some = [rng.choice(base) for _ in range(30)]
        for i in range(0, 30, 5):
            w = some[i]
            at = rng.randrange(len(w))
            some[i] = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abc") + w[at:],
                                  w[:at] + rng.choice("abc") + w[at + 1:]])
        texts.append(rng.choice([" ", ", ", "1", "_"]).join(some))
    return texts + ["commonword rarely"] * 300 + ["commonwrd commonword"] * 5 + ["commnwrd"] * 2 + ODD


@pytest.mark.parametrize("block", [64, 16_384])
def test_equals_all_pairs(spark, block):
    spec = replace(DEFAULT, block=block, held=100)
    df = frame(spark, corpus())
    want = plain([(r.doc_id, r.text) for r in df.collect()], spec)
    got = sorted((tuple(r) for r in spelling_groups(df, spec=spec).collect()))
    assert len(want) > 300 and sum(r[1] is not None for r in want) > 5
    assert got == want


@pytest.mark.parametrize("side", [LEFT, RIGHT])
def test_each_search_finds_errors_of_its_half_once(side):
    rng = random.Random(side)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(3, 9))) for _ in range(300)})
    index = FmIndex([_key(w, side)[::-1] for w in words])
    got = Counter()
    for length in {len(w) for w in words}:
        some = [w for w in words if len(w) == length]
        q, w, inserted = index.near([_key(x, side)[::-1] for x in some], _exact(length, side), side == LEFT)
        for i, j, ins in zip(q.tolist(), w.tolist(), inserted.tolist()):
            assert near(some[i], words[j]) and ins == (len(words[j]) > length)
            got[some[i], words[j]] += 1
    assert max(got.values()) == 1
    other = Counter()
    turned = 1 - side
    index = FmIndex([_key(w, turned)[::-1] for w in words])
    for length in {len(w) for w in words}:
        some = [w for w in words if len(w) == length]
        q, w, _ = index.near([_key(x, turned)[::-1] for x in some], _exact(length, turned), turned == LEFT)
        other.update((some[i], words[j]) for i, j in zip(q.tolist(), w.tolist()))
    both = got + other
    assert max(both.values()) == 1
    assert set(both) == {(a, b) for a in words for b in words if len(b) >= len(a) and near(a, b)}


def test_long_chains_and_long_words(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(19)]
    got = {r.word: r.root for r in roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {f"w{i}": "w19" for i in range(19)}
    long = "ab" * 3000
    rows = frame(spark, [f"{long} {long}x"] * 40 + [f"{long}y"] * 3)
    found = {r.word: r for r in spelling_groups(rows, spec=replace(DEFAULT, every=10**9)).collect()}
    assert found[long].n_near == 2 and found[long + "y"].form == long


def test_empty_table_and_null_ids(spark):
    assert spelling_groups(spark.createDataFrame([], DOCS)).collect() == []
    df = frame(spark, ["wordwordword wordwordwort"] * 30, [None] * 30)
    got = sorted(tuple(r) for r in spelling_groups(df).collect())
    assert got == plain([(None, "wordwordword wordwordwort")] * 30, DEFAULT)
