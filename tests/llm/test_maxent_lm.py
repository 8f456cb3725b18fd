"""The language model: exact counts, a proper distribution, gradients."""
import math
import re
from collections import Counter
from dataclasses import replace
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import maxent_lm as lm

from .data import DOCS, ODD, frame, prose

SMALL = replace(lm.DEFAULT, classes=4, size=8, rows=64, head=200, batch=64, held=50)


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", lower) + [None]


def plain(rows):
    """Base scores by plain counting: (held_out, n_tokens, n_known, N, base)."""
    held = [i is not None and crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(t for (_, text), h in zip(rows, held) if not h for t in tokens(text))
    total, types = sum(count.values()), len(count)
    out = []
    for (_, text), h in zip(rows, held):
        ts = tokens(text)
        out.append((h, len(ts), sum(t in count for t in ts), total,
                    sum(math.log10((count[t] + 1) / (total + types + 1)) for t in ts)))
    return out


def scored(df, spec=SMALL):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return lm.text_scores(df, held, spec=spec)


@pytest.mark.parametrize("spec", [SMALL, replace(SMALL, head=0), lm.DEFAULT])
def test_base_equals_plain_counting(spark, spec):
    texts = [prose(40 + i, seed=i, vocabulary=150) for i in range(60)] + ODD * 2 + ["Rare" + str(i) for i in range(20)]
    ids = [None if i == 5 else i for i in range(len(texts))]
    df = frame(spark, texts, ids)
    want = plain(list(zip(ids, texts)))
    got = scored(df, spec).collect()
    assert len(got) == len(texts)
    by = {i: w for i, w in zip(ids, want)}
    for r in got:
        h, n, known, total, base = by[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score <= 0 and math.isfinite(r.score)


def test_probabilities_of_all_words_add_up_to_one():
    counts = np.array([9, 8, 7, 7, 6, 5, 4, 3, 2, 2, 1, 1], dtype=np.int64)
    spec = replace(SMALL, classes=2, size=4)
    words = [f"w{i}" for i in range(12)]
    model = lm.Model(spec, words, counts, n_texts=3, tokens=int(counts.sum()) + 3, types=13)
    model.W[:] = np.random.default_rng(1).normal(0, 1, model.W.shape)
    before, skip = np.full(10, 3), np.full(10, spec.words)
    token = np.arange(10)  # 8 words, the tail, the end
    p = np.exp(lm.Layers(model, model.W).log_probability(token, before, skip))
    assert p.sum() == pytest.approx(1, abs=1e-5)
    # Four tail words and one share for all that are unseen.
    assert sum(c + 1 for c in counts[8:]) + 1 == model.tail_total


def test_gradients_are_those_of_the_log_probability():
    spec = replace(SMALL, rows=16)
    rng = np.random.default_rng(2)
    model = lm.Model(spec, [f"w{i}" for i in range(32)], np.arange(40, 8, -1), 4, 900, 60)
    model.W[:] = rng.normal(0, 0.3, model.W.shape)
    token, before, skip, _ = lm.histories([rng.integers(0, 33, 12).astype(np.uint16)], spec)
    layers = lm.Layers(model, model.W)
    grad = np.zeros(model.W.shape)
    for rows, g in layers.gradients(token, before, skip):
        np.add.at(grad, (rows[:, None], np.arange(g.shape[1])[None]), g)
    for r, c in [tuple(x) for x in np.argwhere(np.abs(grad) > 0.2)[:12]]:
        old, step = model.W[r, c], 1e-2
        model.W[r, c] = old + step
        up = layers.log_probability(token, before, skip).sum()
        model.W[r, c] = old - step
        down = layers.log_probability(token, before, skip).sum()
        model.W[r, c] = old
        assert -(up - down) / (2 * step) == pytest.approx(grad[r, c], rel=0.05, abs=0.02)


def test_learns_order_and_prefers_it_on_held_out_texts(spark):
    cycle = ["the", "cat", "sat", "on", "a", "mat", "and", "then", "slept"]
    texts = [" ".join(cycle[(i + k) % 9] for k in range(30)) for i in range(400)]
    df = frame(spark, texts)
    spec = replace(SMALL, rate=0.3)
    got = [r for r in scored(df, spec).collect() if r.held_out]
    assert got and sum(r.score for r in got) > 0.5 * sum(r.base_score for r in got)
    turned = [" ".join(reversed(t.split())) for t in texts[:9]]
    both = frame(spark, texts + turned, [*range(400), *range(10**6, 10**6 + 9)])
    ids = [i for i in range(10**6, 10**6 + 9) if crc32(str(i).encode()) % 7 == 2]
    if ids:
        by = {r.doc_id: r for r in scored(both, spec).collect()}
        straight = max(r.score for r in by.values() if r.held_out and r.doc_id < 400)
        assert all(by[i].score < straight for i in ids)


def test_empty_tables_repeated_rows_and_nothing_to_learn_from(spark):
    assert scored(spark.createDataFrame([], DOCS)).collect() == []
    held = [i for i in range(200) if crc32(str(i).encode()) % 7 == 2][:3]
    rows = scored(frame(spark, ["a b", None, "c"], held)).collect()
    assert [(r.n_known, r.train_tokens) for r in rows] == [(0, 0)] * 3
    assert all(r.base_score == 0 and math.isfinite(r.score) for r in rows)
    twice = scored(frame(spark, ["a b c"] * 4 + ["d"] * 3, [1, 1, 1, 1, 3, 3, 3])).collect()
    assert len(twice) == 7 and len({(r.doc_id, r.n_known, r.train_tokens) for r in twice}) == 2


@pytest.mark.parametrize("width", [7, 64])
def test_rows_are_added_by_group_in_less_time_than_reduceat(width):
    import time
    rng = np.random.default_rng(3)
    keys = np.concatenate([rng.integers(0, 3000, 3000), np.full(900, 5), rng.integers(7, 60, 196)])
    g = rng.normal(size=(4096, width)).astype(np.float32)
    order = np.argsort(keys, kind="stable")
    row, first, count = np.unique(keys[order], return_index=True, return_counts=True)
    want = np.zeros((3000, width))
    np.add.at(want, keys, g)
    assert np.allclose(lm._row_sums(g, order, first, count), want[row], atol=1e-3)

    def took(f):
        runs = []
        for _ in range(7):
            begin = time.process_time()
            f()
            runs.append(time.process_time() - begin)
        return min(runs)

    if width == 64:
        assert (took(lambda: lm._row_sums(g, order, first, count))
                < 0.8 * took(lambda: np.add.reduceat(g.take(order, axis=0), first, axis=0)))
