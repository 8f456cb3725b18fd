"""N-gram Jaccard join against brute force over all pairs."""
import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import jaccard_join as J
from starmart.llm.common import read_table
from tests.llm.data import ODD, frame, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return ({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else
            {tuple(words)} if words else set())


def brute(rows):
    """doc_id -> (set size, smallest id reachable)."""
    sets = {i: shingles(x) for i, x in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {p for ids in where.values() for p in combinations(sorted(ids), 2)}
    for a, b in pairs:
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) * 100 >= 75 * max(len(x), len(y)):
            common = len(x & y)
            if 100 * common >= 75 * (len(x) + len(y) - common):
                a, b = sorted((root(a), root(b)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(text, n, rng):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def hard_rows():
    rng = random.Random(5)
    rows = list(ODD)
    passage = prose(60, 77)
    for f in range(6):  # families around the threshold, chains included
        base = prose(rng.choice([8, 20, 60, 150, 400]), 100 + f)
        for _ in range(14):
            rows.append(edited(base, rng.randrange(0, 1 + len(base.split()) // 18), rng))
            base = edited(base, 1, rng) if rng.random() < 0.3 else base
    rows += [f"{prose(rng.choice([3, 6, 9, 12, 15, 18, 21, 40, 90]), 900 + i)} {passage}" for i in range(90)]
    rows += ["ABC def ghi jkl mno pqr"] * 3 + ["abc DEF ghi jkl mno pqr", "one two", "ONE two", "one  two\n"]
    return rows


def check(spark, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in J.jaccard_components(frame(spark, rows)).collect()}
    assert got == brute(list(enumerate(rows)))


def test_matches_brute_force(spark):
    check(spark, hard_rows())


def test_matches_brute_force_with_hot_shingles_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BATCH_HOT", 3)
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "BROADCAST_KEYS", 0)
    monkeypatch.setattr("starmart.llm.components.FEW_LINKS", 0)
    check(spark, hard_rows())


@pytest.mark.parametrize("seed", range(3))
def test_random_sets_of_a_small_vocabulary(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(120):
        rows.append(" ".join(rng.choice("ab") for _ in range(rng.randrange(0, 14))))
    check(spark, rows)


def test_table_matches_brute_force(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(docs).collect()}
    assert got == want


@pytest.mark.parametrize("bits", [1, 5])
def test_classes_with_clashing_ids_stay_apart(spark, bits):
    rows = hard_rows()
    docs = frame(spark, rows)
    _, classes, ids = J.classed(docs, "doc_id", "text", bits)
    sets = {frozenset(shingles(x)) for x in rows if shingles(x)}
    assert classes.count() == len(sets) and ids.clash
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in J.jaccard_components(docs, bits=bits).collect()}
    assert got == brute(list(enumerate(rows)))


def test_ids_that_clash_come_from_the_other_half():
    sets = [np.array([k], dtype=np.uint64) for k in range(40)]
    wide, narrow = J.ClassIds(), J.ClassIds(bits=2)
    assert len({wide(s) for s in sets}) == 40 and len({narrow(s) for s in sets}) == 4
    apart = J.ClassIds(frozenset(narrow(s) for s in sets), 2)
    assert [apart.pair(s) for s in sets] == [narrow.pair(s)[::-1] for s in sets]


def test_a_shingle_of_many_classes_is_passed_on(monkeypatch):
    """Whatever is held at a time: the same entries, one mark for all classes
    of a shingle, and held entries that don't grow with the hot one."""
    rng = np.random.default_rng(2)
    packs = []
    for _ in range(60):
        t = np.sort(np.r_[np.full(30, 7), rng.integers(100, 160, 20), rng.integers(1000, 10**9, 20)]).astype(np.uint64)
        packs.append((t, rng.integers(0, 10**6, len(t))))
    packs.append(packs[0])  # copies in another pack
    names = ["bucket", "hot", "shingles", "cids", "marks"]
    mark = np.array([101], dtype=np.uint64).tobytes()

    def run():
        batches = [pa.RecordBatch.from_pydict({n: [v] for n, v in zip(
            names, (0, False, t.tobytes(), c.tobytes(), mark if k == 30 else b""), strict=True)})
            for k, (t, c) in enumerate(packs)]
        got = pa.Table.from_batches(list(J.shared_shingles(iter(batches)))).to_pylist()
        dfs = {}
        for r in got:
            dfs.setdefault(r["shingle"], set()).add(r["df"])
        assert all(len(v) == 1 for v in dfs.values()) and dfs[101] == {J.HOT}
        return {(r["cid"], r["shingle"]) for r in got}, dfs

    whole, counts = run()
    assert counts[7] != {J.HOT}
    monkeypatch.setattr(J, "HELD", 300)
    monkeypatch.setattr(J, "MET_HOT", 100)
    parts, marked = run()
    assert parts == whole and marked[7] == {J.HOT} and marked[1 + 101] != {J.HOT}


def test_bitmap_bound_never_cuts_a_link():
    rng = np.random.default_rng(1)
    for n in (1, 4, 40, 400, 4000):
        for _ in range(20):
            x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            y = np.unique(np.r_[x[rng.random(len(x)) < 0.87], rng.integers(0, 2**63, n // 9).astype(np.uint64)])
            a, b = (np.frombuffer(J.signature(s), dtype=np.uint64) for s in (x, y))
            most = min(len(x) - int(np.bitwise_count(a & ~b).sum()), len(y) - int(np.bitwise_count(b & ~a).sum()))
            assert most >= len(np.intersect1d(x, y))


def test_one_row_of_each_group_stays(spark):
    text = prose(80, 3)
    near = edited(text, 1, random.Random(1))
    docs = frame(spark, [text, text, near, near, None, None, prose(50, 4), text], ids=[3, 3, 2, 2, 9, 9, None, None])
    kept = J.first_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(2, near), (9, None), (9, None), (None, prose(50, 4))], key=str)


def test_rows_that_stay_are_not_shuffled(spark):
    """Beyond any broadcast only rows that may go move with their texts."""
    rng = random.Random(8)
    texts = [prose(40, 1000 + i) for i in range(300)]
    texts += [edited(x, 1, rng) for x in texts[:20]]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        kept = J.first_of_each(frame(spark, texts))
        got = {r["doc_id"] for r in kept.collect()}
        nodes = [kept._jdf.queryExecution().executedPlan()]
        moved = 0
        while nodes:
            node = nodes.pop()
            if node.nodeName() == "AdaptiveSparkPlan":
                nodes.append(node.executedPlan())
            elif node.nodeName().endswith("QueryStage"):
                nodes.append(node.plan())
            if node.nodeName() == "Exchange" and "text#" in node.output().mkString(","):
                moved += node.metrics().apply("shuffleRecordsWritten").value()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i for i, (_, c) in brute(list(enumerate(texts))).items() if i == c}
    assert len(got) <= 300 and 20 <= moved <= 40


def test_empty_table(spark):
    docs = frame(spark, [])
    assert J.jaccard_components(docs).collect() == [] and J.first_of_each(docs).collect() == []
