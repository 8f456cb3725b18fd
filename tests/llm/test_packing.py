"""Packing: exact ids, every id once, limits, little padding."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from starmart.llm import packing as P
from starmart.llm.common import read_table
from starmart.llm.queries import tokenizer_path
from tests.llm.data import ODD, frame, prose

TEXTS = [*ODD, "It's a <|endoftext|> don't 'x ''s", "É È ß × ÷ œ Œ ② 1234 5.6 _a_b", "don’t", "\x00 a\x1fb\x85c\xa0d",
         "ÀÖØÞàöøþÿ", "A1B2--c3", "²³ ªº µ", "I'll we've I'd I'm they're it'S", "Σ ς İ", "é é", prose(30_000, 5)]


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, P.END_ID]


def check(rows, docs, reference, limits=P.DEFAULT):
    """Every id of every row in one piece, offsets gapless, limits kept."""
    ids = defaultdict(list)
    for i, text in docs:
        ids[i].append(np.array(reference(text), dtype="<u4"))
    seen = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        seen[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["start"]))
    assert set(seen) == set(ids)
    for i, texts in ids.items():
        if len(texts) == 1:
            at = 0
            for start, n, crc, total in sorted(seen[i]):
                assert (start, total) == (at, len(texts[0])) and n > 0
                assert zlib.crc32(texts[0][start:start + n].tobytes()) == crc
                at += n
            assert at == len(texts[0])
        else:
            assert sum(s[1] for s in seen[i]) == sum(map(len, texts))
    for pieces in sequences.values():
        at = 0
        for offset, n, _ in sorted(pieces):
            assert offset == at
            at += n
        assert at <= limits.tokens and len(pieces) <= limits.segments
        assert sum(n - (s == 0) for _, n, s in pieces) <= limits.loss
    return sequences


def test_encoder_equals_the_library(reference):
    got = P.WordEncoder(tokenizer_path()).encode(pa.array(TEXTS, pa.string()))
    assert [g.tolist() for g in got] == [reference(x) for x in TEXTS]


def test_encoder_forgets_and_goes_on(reference, monkeypatch):
    monkeypatch.setattr(P.WordEncoder, "KEEP", 50)
    encoder = P.WordEncoder(tokenizer_path())
    for k in range(5):
        text = prose(200, k) + " " + prose(50, 1)
        assert encoder.encode(pa.array([text]))[0].tolist() == reference(text)


def test_awkward_rows(spark, reference):
    docs = frame(spark, [*TEXTS, "a b", "a b"], ids=[*range(len(TEXTS)), None, None])
    check(P.packed(docs, tokenizer_path()).collect(),
          [*enumerate(TEXTS), (None, "a b"), (None, "a b")], reference)


@pytest.mark.parametrize("limits", [P.Limits(64, 5, 64, 1000, 4), P.Limits(64, 9, 40, 300, 1), P.Limits(512, 3, 100, 2000, 8)])
def test_all_limits_hold_at_once(spark, sf_dir, reference, limits):
    docs = read_table(spark, sf_dir, "documents")
    local = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(P.packed(docs, tokenizer_path(), limits=limits).collect(), local, reference, limits)


def test_table_has_little_padding(spark, reference):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = P.packed(docs, tokenizer_path()).collect()
    sequences = check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], reference)
    used = sum(r["length"] for r in rows)
    assert 1 - used / (4096 * len(sequences)) < 0.02


def test_dot_product_fills_under_several_limits():
    rng = random.Random(1)
    n = [rng.randrange(1, 900) for _ in range(800)]
    skip = [rng.randrange(0, k) for k in n]  # prompt tokens bear no loss
    limits = P.Limits(2048, 16, 1024, cut=10**6)  # no cuts: pure bin packing
    pieces = P.Pieces(np.arange(800), np.zeros(800, int), np.array(n), np.array(skip))
    got = P.pack(pieces, limits)
    assert Counter(p[0] for s in got for p in s) == Counter(range(800))
    for s in got:
        assert sum(p[2] for p in s) <= 2048 and len(s) <= 16 and sum(n[p[0]] - skip[p[0]] for p in s) <= 1024
    least = max(sum(n) / 2048, sum(a - b for a, b in zip(n, skip, strict=True)) / 1024, 800 / 16)
    assert len(got) <= 1.1 * least + 1


def test_ids_column(spark, reference):
    row = P.packed(frame(spark, ["Hello there"]), tokenizer_path(), with_ids=True).first()
    assert row["ids"] == reference("Hello there")


def test_empty_table(spark):
    assert P.packed(frame(spark, []), tokenizer_path()).collect() == []


def test_time_grows_in_proportion_to_short_pieces():
    import time

    from starmart.llm.packing import Limits, Pieces, pack
    rng = np.random.default_rng(7)
    took = []
    for n in (10_000, 80_000):
        tokens = rng.integers(20, 80, n)
        start = time.time()
        got = pack(Pieces(np.arange(n), np.zeros(n, dtype=np.int64), tokens, np.ones(n, dtype=np.int64)), Limits())
        took.append(time.time() - start)
        filled = sum(p[2] for s in got for p in s)
        assert filled == tokens.sum() and filled / (4096 * len(got)) > 0.98
    assert took[1] < 16 * took[0], took
