"""Repeated passages wherever they stand, against every window of words."""
import random
import re

import numpy as np

from starmart.llm import passages as P
from starmart.llm import substring_dedup as S
from starmart.llm.queries import QUERIES
from starmart.operators import bloom
from tests.llm.data import ODD, frame, prose

#: A word, or a character of a script without spaces.
OWN = "฀-໿က-႟ក-៿⺀-꓿豈-﫿＀-﾿\U00020000-\U00033fff"
WORD = re.compile(f"[{OWN}]|[^\x20\x09-\x0d{OWN}]+")


def cut_words(rows):
    """doc_id -> set of word positions that some earlier window repeats."""
    first, gone = {}, {}
    for i, text in sorted(rows):
        words = WORD.findall(text or "")
        for p in range(len(words) - P.LEAST + 1):
            key = tuple(words[p:p + P.LEAST])
            d, q = first.setdefault(key, (i, p))
            if (d, q) != (i, p):
                gone.setdefault(i, set()).update(range(max(p, q + P.LEAST) if d == i else p, p + P.LEAST))
    return gone



def plain(n, seed):
    return prose(n, seed).replace(".", "")


def planted():
    rng = random.Random(8)
    passage, han = plain(53, 1), "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(80))
    texts = [f"{plain(rng.randrange(1, 90), 10 + k)} {passage} {plain(rng.randrange(1, 90), 50 + k)}" for k in range(12)]
    texts += [f"{prose(33, 100 + k)} {passage}{k % 2 and ' ' or chr(10)}{prose(20, 200 + k)}" for k in range(6)]
    texts += [f"你{k}。{han}。好{k}" for k in range(3)]
    texts += ["a b c " * 60, "x " + "a b c " * 40, plain(50, 3), "k " + plain(50, 3), plain(49, 4), plain(49, 4) + " z"]
    return passage, han, texts


def test_passage_inside_long_and_unpunctuated_sentences_goes(spark):
    passage, han, texts = planted()
    got = {r["doc_id"]: r for r in S.span_dedup(frame(spark, texts), whole=True).collect()}
    assert passage in got[0]["text"] and han in got[18]["text"]
    assert not any(passage in got[k]["text"] for k in range(1, 18))
    assert not any(han[10:70] in got[k]["text"] for k in (19, 20))
    assert all(got[k]["n_removed"] > 0 for k in [*range(1, 18), 19, 20])
    assert all(got[k]["removed_bytes"] == len(texts[k].encode()) - len(got[k]["text"].encode()) for k in got)


def ranges_match_every_window(spark, texts):
    docs = frame(spark, texts)
    got = {i: set() for i in range(len(texts))}
    for r in P.passages(docs, "doc_id", "text").collect():
        n = len(WORD.findall(texts[r["id"]]))
        for a, b in np.frombuffer(r["words"], dtype=np.int32).reshape(-1, 2):
            got[r["id"]].update(range(a, min(b, n)) if n >= P.LEAST else ())
    want = cut_words(list(enumerate(texts)))
    assert {i: x for i, x in got.items() if x} == {i: x for i, x in want.items() if x} and len(want) > 15


def test_ranges_match_every_window(spark):
    ranges_match_every_window(spark, list(ODD) + planted()[2] + [prose(120, 9), prose(120, 9), plain(30, 9)] * 2)


def test_ranges_match_with_small_packs_and_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(P, "PACK_BYTES", 500)
    monkeypatch.setattr(bloom, "MAX_BITS", 1 << 15)
    monkeypatch.setattr(bloom, "BITS_PER_KEY", 1 / 64)
    ranges_match_every_window(spark, planted()[2] + [prose(120, 9), prose(120, 9)])


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = plain(80, 4)
    docs = frame(spark, [text, text, f"q {text}", None, None], ids=[1, 1, None, 2, 3])
    rows = S.without_repeats(docs, whole=True)
    assert rows.schema == docs.schema
    assert sorted(((r["doc_id"], r["text"]) for r in rows.collect()), key=str) == sorted(
        [(1, text), (1, text), (None, "q "), (2, None), (3, None)], key=str)
    assert S.span_dedup(frame(spark, []), whole=True).collect() == []


def test_registered_query_cuts_passages_inside_sentences(spark, tmp_path):
    passage, _, texts = planted()
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in QUERIES["op1_substring_dedup"](spark, str(tmp_path)).collect()}
    assert passage in got[0] and not any(passage in got[k] for k in range(1, 18))
