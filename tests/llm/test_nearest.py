from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import CLASHING
from pyspark.sql import functions as F

from rollbook.llm import nearest as operator
from rollbook.llm import queries
from rollbook.llm.nearest import Index, Tree, chi_square, nearest, quantile

SCHEMA = "vec_id long, embedding array<double>"


def _usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def _plain(rows, chosen, k=5):
    """For each query row all others by cosine: (query_id, [(score, vec_id), ...])."""
    rows = [(i, v) for i, v in rows if _usable(v)]
    found = []
    for at, (query, vector) in enumerate(rows):
        if query is not None and chosen(query):
            a = np.array(vector, float)
            near = []
            for other, (vec_id, values) in enumerate(rows):
                if other != at:
                    b = np.array(values, float)
                    near.append((float(a @ b / math.sqrt((a @ a) * (b @ b))), vec_id))
            near.sort(key=lambda x: (-round(x[0], 12), x[1] is None, x[1] or 0))
            found.append((query, near[:k]))
    return found


def _found(df):
    groups = {}
    for row in df.orderBy("query_id", "rank").collect():
        groups.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    return groups


def test_chi_square_law():
    chance = np.random.default_rng(1)
    draws = (chance.standard_normal((200_000, 12)) ** 2).sum(axis=1)
    for x in (4.0, 11.3, 23.0):
        assert abs(chi_square(x, 12) - (draws < x).mean()) < 0.005
    assert abs(chi_square(quantile(0.97, 12), 12) - 0.97) < 1e-9
    vectors = chance.standard_normal((400, 64)) * chance.random(64)
    weights = Tree(64, np.empty(0, int), np.empty(0), 0.97, 12).weights()
    gap = vectors[:200] - vectors[200:]
    ratio = ((gap @ weights) ** 2).sum(axis=1) / (gap**2).sum(axis=1)
    assert 0.9 < (ratio < quantile(0.97, 12)).mean() <= 1


def test_recall_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in
            spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    plain = dict(_plain(rows, lambda n: n % 50 == 0))
    got = _found(queries.op13_nearest_neighbours(spark, sf_dir))
    assert set(got) == set(plain)
    hits = 0
    for query, near in plain.items():
        assert [rank for rank, _, _ in got[query]] == [1, 2, 3, 4, 5]
        true = dict((v, s) for s, v in near)
        hits += sum(v in true for _, v, _ in got[query])
        scores = [s for _, _, s in got[query]]
        assert scores == sorted(scores, reverse=True)
    assert hits / (5 * len(plain)) >= 0.9


def _clusters(seed, clusters=24, each=120):
    chance = np.random.default_rng(seed)
    centres = chance.standard_normal((clusters, 32))
    points = (centres[:, None, :] + 0.1 * chance.standard_normal((clusters, each, 32))).reshape(-1, 32)
    chance.shuffle(points)
    return [(n, list(map(float, v))) for n, v in enumerate(points)]


def test_few_leaves_are_visited_where_vectors_lie_in_clusters(spark, monkeypatch):
    monkeypatch.setattr(operator, "LEAF_ROWS", 64)
    rows = _clusters(2)
    index = Index(spark.createDataFrame(rows, SCHEMA).repartition(5), leaf_rows=64)
    visited, taken = [], []
    within = Index._in_leaves

    def counted(self, visits, k):
        visited.append(visits.count())
        return within(self, visits, k)

    monkeypatch.setattr(Index, "_in_leaves", counted)
    got = _found(index.search(F.col("vec_id") % 50 == 0))
    taken = len(got) * index.tree.leaves
    assert index.tree.leaves == 64 and sum(visited) < taken / 3
    plain = _plain(rows, lambda n: n % 50 == 0)
    hits = sum(len({v for _, v in near} & {v for _, v, _ in got[q]}) for q, near in plain)
    assert hits / (5 * len(plain)) >= 0.95


@pytest.mark.parametrize(("block", "lot", "leaf"), [(4096, 4096, 512), (16, 3, 20)])
def test_copies_blocks_and_lots(spark, monkeypatch, block, lot, leaf):
    """A third of all rows is one vector: of equal scores the smallest ids, exactly."""
    monkeypatch.setattr(operator, "BLOCK_ROWS", block)
    monkeypatch.setattr(operator, "QUERY_LOT", lot)
    chance = np.random.default_rng(5)
    copy = [float(x) for x in chance.standard_normal(8)]
    rows = [(n, copy if n % 3 == 0 else [float(x) for x in chance.standard_normal(8)]) for n in range(300)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = _found(nearest(table, F.col("vec_id") % 10 == 0, leaf_rows=leaf, confidence=0.999999))
    for query, near in _plain(rows, lambda n: n % 10 == 0):
        assert [v for _, v, _ in got[query]] == [v for _, v in near]
        assert np.allclose([s for _, _, s in got[query]], [s for s, _ in near], atol=1e-12)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [2.0, 4.0]), (50, [1.0, 0.0]), (100, None), (150, [0.0, 0.0]), (200, [nan, 1.0]),
            (250, [inf, 1.0]), (300, [None, 1.0]), (350, []), (None, [1.0, 2.0]), (None, [0.5, -1.0]),
            (400, [1e200, 1e200]), (7, [-1e-200, 1e-200])]
    table = spark.createDataFrame(rows + [(450, [1.0, 2.0, 3.0])], SCHEMA)
    table = table.withColumns({name: F.lit("own") for name in [*CLASHING, "row", "vector", "leaf", "rank", "score"]})
    got = sorted((r.query_id, r["rank"], r.vec_id is None, r.vec_id or 0, round(r.score, 9))
                 for r in nearest(table, F.col("vec_id") % 50 == 0).collect())
    plain = sorted((q, n + 1, v is None, v or 0, round(s, 9))
                   for q, near in _scaled_plain(rows) for n, (s, v) in enumerate(near))
    assert got == plain
    assert nearest(table.limit(0), F.col("vec_id") % 50 == 0).isEmpty()
    assert nearest(table.filter("vec_id = 100"), F.col("vec_id") % 50 == 0).isEmpty()
    alone = table.filter("vec_id = 0")
    assert nearest(alone, F.col("vec_id") % 50 == 0).isEmpty()
    few = nearest(table.filter("vec_id in (0, 400)"), F.col("vec_id") % 50 == 0)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few.collect()) == [(0, 1, 400), (400, 1, 0)]


def _scaled_plain(rows):
    made = []
    for vec_id, vector in rows:
        if _usable(vector):
            vector = [x / max(map(abs, vector)) for x in vector]
        made.append((vec_id, vector))
    return _plain(made, lambda n: n % 50 == 0)
