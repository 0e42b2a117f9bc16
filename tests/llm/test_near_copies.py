from __future__ import annotations

import numpy as np
import pytest
from helpers import lower, spaced
from test_jaccard_join import _near_copies

import corpus_pipeline
from rollbook.llm import jaccard_join
from rollbook.llm.jaccard_join import jaccard_components, keep_one, levels, linked, region_keys


def _shingles(text, size):
    words = spaced(lower(text))
    return frozenset(tuple(words[n : n + size]) for n in range(max(1, len(words) - size + 1)))


def _components(rows, size, percent):
    """Component of each row, by its smallest id; all ids and texts are there."""
    sets = [_shingles(text, size) for _, text in rows]
    least = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if least[a] != least[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                least = [least[b] if n == least[a] else n for n in least]
    smallest = {}
    for n, (doc, _) in zip(least, rows):
        smallest[n] = min(smallest.get(n, doc), doc)
    return [(doc, smallest[n]) for n, (doc, _) in zip(least, rows)]


def _spread_edits():
    """100 distinct words, and two of them replaced: 0.848 of 4-word, 0.811 of 5-word shingles."""
    words = [f"p{n}" for n in range(100)]
    return [(5000, " ".join(words)), (5001, " ".join({30: "x", 70: "y"}.get(n, w) for n, w in enumerate(words)))]


@pytest.mark.parametrize("tile", [2048, 8])
def test_stage_against_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    rows = _near_copies(3, 150) + _spread_edits() + [(5002, "a b c d e f g h"), (5003, "a b c d e f g h i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = _components(rows, 5, 80)
    assert dict(expected)[5001] == 5000 and dict(expected)[5003] == 5002
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({component for _, component in expected})


def test_threshold_is_the_callers(spark):
    docs = spark.createDataFrame(_spread_edits(), "doc_id long, text string")
    assert keep_one(docs).count() == 2 and keep_one(docs, shingle=5, percent=80).count() == 1
    found = jaccard_components(docs, percent=84)
    assert {r.component_id for r in found.collect()} == {5000}


@pytest.mark.parametrize("percent", [30, 50, 80, 95])
def test_linked_sets_meet_at_any_threshold(percent):
    chance = np.random.default_rng(percent)
    met = 0
    counts = chance.integers(0, 9, jaccard_join.BUCKETS)
    for size in [*range(2, 60), 100, 333, 1000]:
        x = np.unique(chance.integers(0, 2**63, size).astype(np.uint64))
        for _ in range(12):
            drop, add = chance.integers(0, size * (100 - percent) // 100 + 2, 2)
            fresh = chance.integers(0, 2**63, add).astype(np.uint64)
            y = np.unique(np.r_[chance.permutation(x)[drop:], fresh])
            if len(y) and linked(x, y, percent) and set(x) != set(y):
                met += 1
                assert set(levels(len(x), percent)) & set(levels(len(y), percent))
                assert set(region_keys(x, counts, percent)) & set(region_keys(y, counts, percent))
    assert met > 30
