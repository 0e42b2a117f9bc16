from __future__ import annotations

import random

import pytest

from rollbook.llm.components import components, joined
from rollbook.llm.store import Tables


def _plain(edges):
    least = {}
    for a, b in edges:
        for n in (a, b):
            least.setdefault(n, n)
        low, high = sorted((least[a], least[b]))
        if low != high:
            least = {n: low if label == high else label for n, label in least.items()}
    return least


@pytest.mark.parametrize("seed", range(3))
def test_components_and_further_edges(spark, seed):
    chance = random.Random(seed)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(150)]
    edges += [(7, n) for n in range(400, 500)] + [(n, n + 1) for n in range(600, 660)]
    more = [(chance.randrange(1000), chance.randrange(1000)) for _ in range(60)]
    frames = [spark.createDataFrame([p for p in part if p[0] != p[1]], "a long, b long") for part in (edges, more)]
    with Tables() as tables:
        first = components(frames[0], tables)
        assert {r.node: r.label for r in first.collect()} == _plain([p for p in edges if p[0] != p[1]])
        second = joined(first, frames[1], tables)
        assert {r.node: r.label for r in second.collect()} == _plain([p for p in edges + more if p[0] != p[1]])
        none = components(frames[0].limit(0), tables)
        assert none.isEmpty()
