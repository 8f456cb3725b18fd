"""k-d sharding: the law, slots, copies and awkward rows."""
import zlib
from collections import Counter, defaultdict

import pytest

from starmart.llm import kd_sharding as K
from starmart.llm.common import read_table
from tests.llm.data import ODD, frame, prose


def shards_of(df, n):
    return K.kd_shards(df, n).collect()


def check(rows, docs, n, slack):
    """Sizes, checksums, gapless slots, bytes equal up to ``slack`` and a text."""
    want = Counter((i, 8 + len((x or "").encode()), zlib.crc32((x or "").encode())) for i, x in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots, total = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
        total[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(total.values()) / n
    largest = max((r["size"] for r in rows), default=0)
    assert all(abs(total[k] - mean) <= slack * mean + largest for k in range(n)), sorted(total.items())


def test_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    local = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = shards_of(docs, 24)
    check(rows, local, 24, 0.02)
    place = {r["doc_id"]: r["shard"] for r in rows}
    of_text = defaultdict(set)
    for i, x in local:
        of_text[x].add(place[i])
    assert sum(len(s) > 1 for s in of_text.values()) <= 4  # only where a median falls into a group


def test_hot_group_and_hot_source_are_split(spark):
    texts = [prose(30, 1)] * 700 + [prose(20 + i % 40, i) for i in range(1400)]
    docs = frame(spark, texts)
    check(shards_of(docs, 8), list(enumerate(texts)), 8, 0.03)


def test_copies_stay_together_while_light(spark):
    texts = [prose(30 + k % 17, k % 300) for k in range(1500)]
    rows = shards_of(frame(spark, texts), 4)
    place = defaultdict(set)
    for r in rows:
        place[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in place.values()) <= 3


@pytest.mark.parametrize("slot_rows", [3, 50_000])
def test_awkward_rows(spark, monkeypatch, slot_rows):
    monkeypatch.setattr(K, "SLOT_ROWS", slot_rows)
    texts, ids = [*ODD, *ODD, "é" * 40_000], [*range(len(ODD)), *[None] * 3, *[7] * (len(ODD) - 3), 99]
    rows = shards_of(frame(spark, texts, ids=ids), 5)
    check(rows, list(zip(ids, texts, strict=True)), 5, 99)


def test_one_shard_and_empty_table(spark):
    check(shards_of(frame(spark, ["a", "b"]), 1), [(0, "a"), (1, "b")], 1, 0)
    assert shards_of(frame(spark, []), 24) == []


def test_more_shards_than_rows(spark):
    check(shards_of(frame(spark, ["a", "bb", "ccc"]), 24), [(0, "a"), (1, "bb"), (2, "ccc")], 24, 99)


def test_leaves_reach_target_bytes(spark):
    texts = [prose(20 + i % 40, i) for i in range(900)]
    docs = frame(spark, texts)
    total = sum(8 + len(x.encode()) for x in texts)
    rows = K.kd_shards(docs, target_bytes=total // 6 + 1).collect()
    check(rows, list(enumerate(texts)), 6, 0.03)
    assert {r["shard"] for r in K.kd_shards(docs, target_bytes=10 * total).collect()} == {0}
    assert K.kd_shards(frame(spark, []), target_bytes=100).collect() == []
    for both in ({}, {"shards": 3, "target_bytes": 3}):
        with pytest.raises(ValueError, match="target bytes"):
            K.kd_shards(docs, **both)


def test_cuts_are_weighted_medians_of_the_widest_dimension(spark):
    """The tree's first cut, against plain sorting."""
    docs = frame(spark, [prose(10 + 7 * (i % 50), i) for i in range(600)])
    pts = K.points(docs, "doc_id", "text", ["source", "lang"]).cache()
    tree = K.grow(pts, 3, 4)
    local = [r.asDict() for r in pts.collect()]
    total = sum(r["size"] for r in local)

    def walk(node, rows, scale):
        if node.left is None or not rows:
            return
        spread = [(max(r[f"d{d}"] for r in rows) - min(r[f"d{d}"] for r in rows)) / scale[d] for d in range(3)]
        assert node.dim == max(range(3), key=lambda d: (spread[d], -d))
        key = lambda r: (r[f"d{node.dim}"], r["tie"])
        left = [r for r in rows if key(r) < (node.value, node.tie)]
        right = [r for r in rows if key(r) >= (node.value, node.tie)]
        weight, want = sum(r["size"] for r in left), sum(r["size"] for r in rows) * node.left.shards / node.shards
        heaviest = Counter()
        for r in rows:
            heaviest[r["tie"] >> K.ROW_BITS] += r["size"]
        assert abs(weight - want) <= max(heaviest.values()) + total / 4 * K.TOLERANCE
        walk(node.left, left, scale)
        walk(node.right, right, scale)

    scale = [max(1, max(r[f"d{d}"] for r in local) - min(r[f"d{d}"] for r in local)) for d in range(3)]
    assert tree.left is not None
    walk(tree, local, scale)
    pts.unpersist()
