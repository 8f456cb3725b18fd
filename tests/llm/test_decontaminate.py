"""Benchmark decontamination against brute force."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as t

from starmart.llm.common import read_table
from starmart.llm.decontaminate import bin_of, contamination, decontaminated, in_bins
from tests.llm.data import ODD, frame, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for text in texts:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def items_frame(spark, items):
    schema = t.StructType([t.StructField("item_id", t.LongType()), t.StructField("text", t.StringType()),
                           t.StructField("window", t.StringType())])
    return spark.createDataFrame([(i, x, "w") for i, x in items], schema)


def rows(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def hard_case():
    rng = random.Random(2)
    items = [(10 + i, prose(n, 50 + i)) for i, n in enumerate([13, 14, 20, 40, 100, 12, 7, 6, 3, 1])]
    shared = prose(30, 99)
    items += [(30, prose(5, 60) + " " + shared), (4, shared + " " + prose(9, 61)), (None, shared), (4, shared),
              (31, None), (32, "!?"), (33, "A B a b " * 9)]
    texts = list(ODD)
    for _, item in items:
        w = (item or "").split()
        for cut in (len(w), 13, 12):
            i = rng.randrange(max(1, len(w) - cut + 1))
            piece = " ".join(w[i:i + cut])
            texts += [f"{prose(20, rng.random())} {piece.upper()}, {prose(15, rng.random())}", piece.replace(" ", "--")]
    texts += [shared + " x " + shared, " ".join(x for _, x in items if x), prose(5000, 8) + " " + shared, "a b A b a b a",
              prose(40, 70), prose(40, 70)]
    return texts, items


@pytest.mark.parametrize("keys", [0, 1_000_000])
def test_matches_brute_force(spark, monkeypatch, keys):
    monkeypatch.setattr("starmart.llm.decontaminate.BROADCAST_KEYS", keys)
    texts, items = hard_case()
    got = rows(contamination(frame(spark, texts), items_frame(spark, items)))
    want = brute(texts, items)
    assert got == dict(enumerate(want))


def test_table_matches_brute_force(spark, sf_dir):
    docs, bench = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    local = docs.select("doc_id", "text").collect()
    want = brute([r["text"] for r in local], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert rows(contamination(docs, bench)) == dict(zip([r["doc_id"] for r in local], want, strict=True))
    assert any(w[4] for w in want)


def test_contaminated_rows_go_whole_and_the_rest_stay(spark):
    texts, items = hard_case()
    docs = frame(spark, [*texts, texts[14], None], ids=[*range(len(texts)), 14, None])
    kept = decontaminated(docs, items_frame(spark, items))
    bad = {i for i, w in enumerate(brute(texts, items)) if w[4]}
    assert kept.schema == docs.schema
    want = [r for r in docs.collect() if r["doc_id"] is None or r["doc_id"] not in bad]
    assert sorted(kept.collect(), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("texts,items", [([], []), (["a b c"], []), ([], [(1, "a b c")])])
def test_empty_tables(spark, texts, items):
    docs, bench = frame(spark, texts), items_frame(spark, items)
    assert [r["contaminated"] for r in contamination(docs, bench).collect()] == [False] * len(texts)
    assert decontaminated(docs, bench).count() == len(texts)


def test_bins_hold_every_print_once_where_it_is_looked_up(spark):
    rng = random.Random(3)
    sets = [[rng.randrange(-2**63, 2**63) for _ in range(n)] for n in (1, 2, 5, 1000, 10_000)]
    got = spark.createDataFrame([(x,) for x in sets], "p array<long>").select("p", in_bins(F.col("p")).alias("b"))
    found = got.select("p", "b", F.transform("p", lambda x: F.array_contains(
        F.element_at("b", bin_of(x, F.size("b")) + 1), x)).alias("in"))
    for row in found.collect():
        n = len(row["p"])
        assert all(row["in"]) and sorted(x for b in row["b"] for x in b) == sorted(row["p"])
        assert len(row["b"]) <= n**0.5 + 1 and max(map(len, row["b"])) <= 3 * n**0.5 + 3


def test_a_long_text_with_very_many_hits(spark):
    items = [(i, prose(60, 200 + i)) for i in range(40)]
    texts = [" x ".join(x for _, x in items) + " " + prose(500, 3), prose(300, 4)]
    got = rows(contamination(frame(spark, texts), items_frame(spark, items)))
    assert got == dict(enumerate(brute(texts, items))) and got[0][1] == 2400 and got[0][2] == 40
