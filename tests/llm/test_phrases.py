"""Phrase mining against plain counting; the parse itself."""
import random
import re
from collections import Counter, defaultdict
from dataclasses import replace

import pytest

from starmart.llm import phrases
from starmart.llm.phrases import DEFAULT, chunks, collocations

from .data import DOCS, ODD, frame

SMALL = replace(DEFAULT, least=3, top=40, held=50)


def plain(rows, spec):
    """The contract by plain counting: rows of (text, lang)."""
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang or "und"] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    count[lang or "und"][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= spec.least}
        found = []
        for p, a in candidates.items():
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = (b for q, b in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:]))
            if not any(100 * b >= spec.cover * a for b in longer):
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:spec.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def mined(df, spec):
    return sorted(tuple(r) for r in collocations(df, spec=spec).collect())


def corpus(n=120, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "Ab", "aB", "z\x85q", "a　b"]
    texts = []
    for _ in range(n):
        words = [vocabulary[min(int(rng.expovariate(0.12)), 44)] for _ in range(rng.randrange(0, 60))]
        text = ""
        for w in words:
            text += w + rng.choice([" "] * 9 + ["\t", ". ", ",", "\n", "  "])
        texts.append(text)
    return texts + ["same line here and there. " * 5] * 7 + ODD


@pytest.mark.parametrize("hot", [False, True])
def test_equals_plain_counting(spark, hot, monkeypatch):
    texts = corpus()
    df = frame(spark, texts)
    rows = [(r.text, r.lang) for r in df.collect()]
    want = plain(rows, SMALL)
    if hot:  # every word is hot: all pairs go through the split way
        real = phrases.phrase_counts
        every = {g: frozenset(w.encode() for t, _ in rows for w in re.split("[.,;:!?\x0a-\x0d \t]+", (t or "").lower()))
                 for g in ("en", "und")}
        monkeypatch.setattr(phrases, "phrase_counts", lambda p, _, tasks, spec: real(p, every, tasks, spec))
    got = mined(df, SMALL)
    assert len(want) > 20 and got == want


def test_chunks_give_every_gram_once_and_cut_equal_passages_alike():
    text = b" ".join(b"w%d" % (i * i % 97) + b"." * (i % 7 == 0) for i in range(300))
    stream = text.replace(b".", b" .").split() + [b"."]
    owned, words = [], 0
    for chunk, own in chunks(text, 8):
        body = chunk.split()
        owned += [tuple(body[i:i + 3]) for i in range(len(body) - 2)]
        words += own
    assert words == 300
    padded = stream + [b".", b"."]
    assert owned == [tuple(padded[i:i + 3]) for i in range(len(stream))]
    inside = {c for c, _ in chunks(text, 8)}
    shifted = {c for c, _ in chunks(b"other words first " + text, 8)}
    assert len(inside - shifted) <= 1


def test_counts_beyond_64_bits_and_overlapping_copies(spark):
    texts = ["a a a a a a"] * 4 + ["x y. x y, x y z"] * 3
    df = frame(spark, texts)
    assert mined(df, SMALL) == plain([(r.text, r.lang) for r in df.collect()], SMALL)
    big = spark.createDataFrame([("en", "p q", 2, 5 * 10**12)], "grp string, phrase string, words int, f long")
    words = spark.createDataFrame([("en", "p", 6 * 10**12), ("en", "q", 7 * 10**12)], "grp string, phrase string, f long")
    total = spark.createDataFrame([("en", 10**14)], "grp string, n long")
    (row,) = phrases.ranked(big, words, total, DEFAULT).collect()
    assert row.score == 1000000 * 25 * 10**24 // (42 * 10**24)


def test_empty_table_and_texts_without_phrases(spark):
    assert mined(spark.createDataFrame([], DOCS), SMALL) == []
    assert mined(frame(spark, [None, "", "one", "a. b. c."]), SMALL) == []
