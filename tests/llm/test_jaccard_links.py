"""Every link of the n-gram Jaccard join, against all pairs."""
import random
from itertools import combinations

import pytest

from starmart.llm import jaccard_join as J
from tests.llm.data import frame, prose
from tests.llm.test_jaccard_join import edited, hard_rows, shingles


def links(texts):
    """Pairs of rows that link, and each row's number of links."""
    sets, pairs, n = [shingles(x) for x in texts], set(), [0] * len(texts)
    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            pairs.add((a, b))
            n[a], n[b] = n[a] + 1, n[b] + 1
    return pairs, n


def check(spark, texts):
    pairs, n = links(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["n_links"]) for r in J.jaccard_links(frame(spark, texts)).collect()}
    assert got == {i: (len(shingles(x)), n[i]) for i, x in enumerate(texts)}
    return pairs


def test_every_link_is_counted(spark):
    assert len(check(spark, hard_rows())) > 100


@pytest.mark.parametrize("block", [8, 1024])
def test_group_of_near_copies_gives_all_its_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rng, base = random.Random(2), prose(300, 5)
    texts = [edited(base, 1, rng) for _ in range(40)]
    assert len(check(spark, texts)) == 780
    rows, _, found = J.class_links(frame(spark, texts))
    of = {r["cid"]: r["id"] for r in rows.collect()}
    assert {tuple(sorted((of[r["u"]], of[r["v"]]))) for r in found.collect()} == links(texts)[0]


def test_empty_table(spark):
    assert J.jaccard_links(frame(spark, [])).collect() == []
