"""Connected components: both ways against a plain union-find."""
import random

import pytest

from starmart.llm import components as C


def brute(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in list(parent) if root(x) != x}


def graphs():
    rng = random.Random(6)
    yield []
    yield [(1, 2), (2, 2), (2, 1), (1, 2)]
    yield [(i, i + 1) for i in range(-200, 200)]  # a long path
    yield [(0, i) for i in range(1, 300)] + [(299, -5)]  # a hub
    yield [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(330)]
    big = [rng.randrange(-2**63, 2**63) for _ in range(60)]
    yield [(rng.choice(big), rng.choice(big)) for _ in range(50)]


@pytest.mark.parametrize("few", [0, 1_000_000])
@pytest.mark.parametrize("k", range(6))
def test_components(spark, monkeypatch, k, few):
    monkeypatch.setattr(C, "FEW_LINKS", few)
    pairs = list(graphs())[k]
    rng = random.Random(k)
    pairs = [p if rng.random() < 0.5 else p[::-1] for p in pairs]
    got = C.components(spark.createDataFrame(pairs, "u long, v long").repartition(3))
    assert {r["u"]: r["m"] for r in got.collect()} == brute(pairs)
