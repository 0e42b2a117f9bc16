"""Approximate nearest neighbours by stable projections in a kd-tree.

Vectors are scaled to length one, so that the largest cosine is the smallest distance d, and
projected to DIMS dimensions by independent normal weights. Normal is the 2-stable law: whatever
the vectors, the squared projected distance is d squared times a chi-square variable of DIMS degrees.

The projections are indexed by a kd-tree. A query takes its leaves from the nearest box on, and in
a leaf the rows from the nearest projection on, and verifies them by their whole vectors. With the
k-th smallest distance found so far d_k, a row nearer than d_k has a projection nearer than
sqrt(Q) d_k with probability CONFIDENCE, Q being the chi-square quantile. Once the next projected
distance is beyond that, the search has met the stopping test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

K = 5
#: Dimensions of the projections; even, so that the chi-square law has a closed form.
DIMS = 12
#: How probable it is that a row nearer than the last one found has been verified.
CONFIDENCE = 0.97
#: Rows with the smallest hashes, whose projections place the splits of the tree.
SAMPLE_ROWS = 32_768
#: Rows that a leaf of the tree should get, and leaves that a tree has at most.
LEAF_ROWS = 512
MOST_LEAVES = 4096
#: Rows of a leaf that a task holds; larger leaves are dealt to several blocks.
BLOCK_ROWS = 4096
#: Queries of a leaf that one task takes; more are dealt to several lots.
QUERY_LOT = 4096
#: Leaves that a query takes in its first round; each round takes that many times more.
GROWTH = 4
#: Projections that are verified before the test is made again.
STEP = 64
SEED = 7
#: Above what rounding does to squared projected distances of equal vectors.
ROUNDING = 1e-9


def chi_square(x: float, dims: int) -> float:
    """The chi-square distribution function for an even number of degrees."""
    term, total = 1.0, 0.0
    for n in range(dims // 2):
        total += term
        term *= x / 2 / (n + 1)
    return 1 - math.exp(-x / 2) * total


def quantile(share: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dims) < share else (low, middle)
    return high


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of 2 each, so that no square overflows or vanishes; cosines stay."""
    largest = np.abs(vectors).max(axis=1, initial=0.0)
    return np.ldexp(vectors, -np.frexp(largest)[1][:, None])


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


@dataclass(frozen=True)
class Tree:
    """Splits of a complete kd-tree, level by level, and what belongs to a search."""

    width: int
    axes: np.ndarray
    cuts: np.ndarray
    confidence: float
    dims: int

    def weights(self) -> np.ndarray:
        return np.random.default_rng(SEED).standard_normal((self.width, self.dims))

    @property
    def leaves(self) -> int:
        return len(self.axes) + 1

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while len(node) and node[0] < len(self.axes):
            right = points[np.arange(len(points)), self.axes[node]] >= self.cuts[node]
            node = 2 * node + 1 + right
        return node - len(self.axes)

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest coordinates of each leaf."""
        low = np.full((2 * len(self.axes) + 1, self.dims), -np.inf)
        high = -low
        for node, (axis, cut) in enumerate(zip(self.axes, self.cuts)):
            for child in (2 * node + 1, 2 * node + 2):
                low[child], high[child] = low[node], high[node]
            high[2 * node + 1, axis] = low[2 * node + 2, axis] = cut
        return low[len(self.axes) :], high[len(self.axes) :]


def _split(points: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Medians along the axis of the widest spread, for each node of a complete tree."""
    axes, cuts, level = [], [], [points]
    for _ in range(levels):
        parts = []
        for own in level:
            axis = int(np.argmax(own.var(axis=0))) if len(own) else 0
            cut = float(np.median(own[:, axis])) if len(own) else 0.0
            axes.append(axis)
            cuts.append(cut)
            parts += [own[own[:, axis] < cut], own[own[:, axis] >= cut]]
        level = parts
    return np.array(axes, np.int64), np.array(cuts, np.float64)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _scaled(values.reshape(-1, width))


def _projected(width: int, weights: np.ndarray):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), width)
            points = vectors / _norms(vectors)[:, None] @ weights
            yield pa.RecordBatch.from_arrays([_list(points)], names=["point"])

    return project


def _list(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(rows.ravel()))


def _leafed(tree: Tree):
    """The leaf of each row."""

    def leafed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = tree.weights()
        for batch in batches:
            vectors = _matrix(batch.column("vector"), tree.width)
            leaf = tree.leaf(vectors / _norms(vectors)[:, None] @ weights)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    return leafed


def _visits(tree: Tree, take: int):
    """The next leaves of each query, nearest box first, as far as the stopping test lets them.

    The number of leaves a query has taken so far is in ``done``, its d_k squared in ``bound``.
    """

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, (low, high) = tree.weights(), tree.boxes()
        reach = quantile(tree.confidence, tree.dims)
        for batch in batches:
            vectors = _matrix(batch.column("vector"), tree.width)
            points = vectors / _norms(vectors)[:, None] @ weights
            done, bound = batch.column("done").to_pylist(), batch.column("bound").to_pylist()
            numbers, leaves = [], []
            for n, point in enumerate(points):
                gap = np.maximum(np.maximum(low - point, point - high), 0.0)
                apart = (gap * gap).sum(axis=1)
                order = np.argsort(apart, kind="stable")[done[n] : done[n] + take]
                order = order[apart[order] <= reach * bound[n] + ROUNDING]
                numbers.append(np.full(len(order), n))
                leaves.append(order)
            chosen = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
            picked = batch.select(["row", "vector", "bound"]).take(pa.array(chosen))
            leaf = np.concatenate(leaves) if leaves else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(leaf)], names=["query", "vector", "bound", "leaf"]
            )

    return visits


class _Held:
    """The rows of one block of a leaf, ready to be searched."""

    def __init__(self, ids: list, rows: np.ndarray, vectors: np.ndarray, weights: np.ndarray, search):
        self.vectors, self.norms = vectors, _norms(vectors)
        self.points = vectors / self.norms[:, None] @ weights
        self.rows, self.weights, self.search = rows, weights, search
        # Equal scores go to the smaller id, null ids last.
        keys = sorted(range(len(ids)), key=lambda n: (ids[n] is None, ids[n] or 0, rows[n]))
        self.rank = np.empty(len(ids), np.int64)
        self.rank[keys] = np.arange(len(ids))

    def nearest(self, row: int, vector: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k nearest that the stopping test let through."""
        k, reach = self.search
        norm = np.sqrt((vector * vector).sum())
        apart = self.points - vector / norm @ self.weights
        apart = (apart * apart).sum(axis=1)
        order = np.argsort(apart, kind="stable")
        order = order[self.rows[order] != row]
        found = scores = None
        at = 0
        while at < len(order) and apart[order[at]] <= reach * bound + ROUNDING:
            step = order[at : at + STEP]
            step = step[apart[step] <= reach * bound + ROUNDING]
            at += STEP
            own = (self.vectors[step] * vector).sum(axis=1) / (self.norms[step] * norm)
            found = step if found is None else np.append(found, step)
            scores = own if scores is None else np.append(scores, own)
            best = np.lexsort((self.rank[found], -scores))[:k]
            found, scores = found[best], scores[best]
            if len(found) == k:
                bound = min(bound, max(0.0, 2 - 2 * float(scores[-1])))
        return found, scores


def _searched(width: int, dims: int, k: int, confidence: float):
    """Nearest rows in a block of a leaf for each query: the block's rows come first."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.random.default_rng(SEED).standard_normal((width, dims))
        search = (k, quantile(confidence, dims))
        known, held, parts = None, None, []
        for batch in batches:
            keys = list(zip(*(batch.column(name).to_pylist() for name in ("leaf", "block", "lot"))))
            queries, bounds = batch.column("query").to_numpy(zero_copy_only=False), batch.column("bound").to_pylist()
            rows, ids = batch.column("row").to_numpy(zero_copy_only=False), batch.column("vec_id").to_pylist()
            vectors = _matrix(batch.column("vector"), width)
            is_query = batch.column("is_query").to_numpy(zero_copy_only=False)
            found = []
            for n, key in enumerate(keys):
                if key != known:
                    known, held, parts = key, None, []
                if not is_query[n]:
                    parts.append((ids[n], int(rows[n]), vectors[n]))
                    continue
                if held is None and parts:
                    held = _Held([p[0] for p in parts], np.array([p[1] for p in parts]),
                                 np.array([p[2] for p in parts]), weights, search)
                    names = [p[0] for p in parts]
                if held is not None:
                    query = int(queries[n])
                    near, scores = held.nearest(query, vectors[n], bounds[n])
                    if near is not None:
                        found += [(query, names[i], int(held.rows[i]), float(s)) for i, s in zip(near, scores)]
            if found:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], batch.schema.field("vec_id").type),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.float64())],
                    names=["query", "vec_id", "row", "score"],
                )

    return searched


class Index:
    """Every usable vector of a table, in the leaves of a kd-tree over its projections."""

    def __init__(
        self, vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", dims: int = DIMS,
        confidence: float = CONFIDENCE, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS,
    ):
        if dims % 2:
            raise ValueError("dims has to be even")
        given = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
        if given.schema["vector"].dataType.simpleString() != "array<float>":
            given = given.withColumn("vector", F.col("vector").cast("array<double>"))
        self.list = given.schema["vector"].dataType.simpleString()
        largest = F.array_max(F.transform("vector", F.abs))
        # In Spark's order NaN and infinity come after every finite number.
        finite = ~F.exists("vector", lambda x: x.isNull()) & (largest > 0) & (largest < float("inf"))
        usable = stored(
            given.filter("vector is not null").filter(finite)
            .withColumn("row", F.monotonically_increasing_id()),
            "nearest_rows",
        )
        widths = usable.groupBy(F.size("vector").alias("width")).count()
        common = widths.orderBy(F.desc("count"), F.desc("width")).first()
        self.width, self.size = (common["width"], common["count"]) if common else (0, 0)
        self.kind = given.schema["vec_id"].dataType.simpleString()
        if not self.size:
            self.rows = usable.withColumn("leaf", F.lit(0).cast("long"))
            return
        self.usable = usable.filter(F.size("vector") == self.width)
        whole = math.ceil(math.log2(max(1, self.size / leaf_rows)))
        levels = min(whole, int(math.log2(MOST_LEAVES)))
        weights = np.random.default_rng(SEED).standard_normal((self.width, dims))
        sample = self.usable.orderBy(F.xxhash64("row"), "row").limit(sample_rows)
        sample = sample.select("vector").mapInArrow(_projected(self.width, weights), "point array<double>")
        points = np.array([row["point"] for row in sample.collect()])
        self.tree = Tree(self.width, *_split(points, levels), confidence, dims)
        self.rows = stored(
            self.usable.mapInArrow(
                _leafed(self.tree), f"vec_id {self.kind}, vector {self.list}, row long, leaf long"
            ),
            "nearest_index",
        )
        blocks = self.rows.groupBy("leaf").count().select(
            "leaf", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")
        )
        self.blocks = stored(blocks, "nearest_blocks")  # at most MOST_LEAVES rows

    def search(self, is_query, k: int = K) -> DataFrame:
        """``query_id, rank, vec_id, score`` for the indexed rows that ``is_query`` chooses.

        Candidates are all other indexed rows. Rounds take ever more leaves of a query, nearest
        first, until the stopping test holds for each or no leaf is left.
        """
        if not self.size:
            return self.rows.select(
                F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                F.lit(0.0).alias("score"),
            ).limit(0)
        queries = stored(self.rows.filter(is_query).select("vec_id", "row", "vector"), "nearest_queries")
        # Any distance between vectors of length one is at most 2.
        state = queries.select("row", "vector", F.lit(0).alias("done"), F.lit(4.0).alias("bound"))
        best, done, take = None, 0, GROWTH
        while done < self.tree.leaves:
            visits = stored(
                state.mapInArrow(
                    _visits(self.tree, take), f"query long, vector {self.list}, bound double, leaf long"
                ),
                "nearest_visits",
            )
            if visits.isEmpty():
                break
            found = self._in_leaves(visits, k)
            if best is not None:
                found = found.unionByName(best)
            order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.col("row")]
            rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
            best = stored(found.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank"), "nearest_best")
            done, take = done + take, take * GROWTH
            last = best.groupBy(F.col("query").alias("of")).agg(
                F.count("*").alias("n"), F.min("score").alias("score")
            )
            bound = F.when(F.col("n") == k, F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).otherwise(4.0)
            state = queries.join(last, F.col("row") == F.col("of"), "left").select(
                "row", "vector", F.lit(done).alias("done"), F.coalesce(bound, F.lit(4.0)).alias("bound")
            )
        if best is None:
            best = self.rows.select(F.col("row").alias("query"), "vec_id", "row", F.lit(0.0).alias("score")).limit(0)
        names = queries.select(F.col("vec_id").alias("query_id"), F.col("row").alias("of"))
        rank = F.row_number().over(
            Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        )
        return best.withColumn("rank", rank).join(names, F.col("query") == F.col("of")).select(
            "query_id", "rank", "vec_id", "score"
        )

    def _in_leaves(self, visits: DataFrame, k: int) -> DataFrame:
        """Queries and the rows of the leaves they visit, brought together by leaf.

        A leaf of very many rows is dealt to blocks, each of which its queries go to, and one
        of very many queries to lots, each of which its rows go to.
        """
        lots = visits.groupBy("leaf").count().select(
            "leaf", F.ceil(F.col("count") / QUERY_LOT).cast("int").alias("lots")
        )
        # At most MOST_LEAVES rows.
        parts = F.broadcast(stored(self.blocks.join(lots, "leaf"), "nearest_parts"))
        rows = self.rows.join(parts, "leaf").select(
            "leaf", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.lit(False).alias("is_query"),
            F.lit(-1).cast("long").alias("query"), F.lit(0.0).alias("bound"), "vec_id", "row", "vector",
        )
        asked = visits.join(parts, "leaf").select(
            "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            F.pmod(F.xxhash64("query"), "lots").cast("int").alias("lot"), F.lit(True).alias("is_query"),
            "query", "bound", F.lit(None).cast(self.kind).alias("vec_id"), F.lit(-1).cast("long").alias("row"), "vector",
        )
        met = rows.unionByName(asked).repartition(F.col("leaf"), F.col("block"), F.col("lot"))
        met = met.sortWithinPartitions("leaf", "block", "lot", "is_query")
        return met.mapInArrow(
            _searched(self.width, self.tree.dims, k, self.tree.confidence),
            f"query long, vec_id {self.kind}, row long, score double",
        )


def nearest(
    vectors: DataFrame, is_query, *, k: int = K, vec_id: str = "vec_id", vector: str = "embedding", **how
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` chooses its k nearest others.

    ``is_query`` is a condition on ``vec_id``. ``score`` is the cosine of the given vectors in
    double precision, the nearest come first, and of equal scores the smaller id, null last.
    Candidates are all rows but the query's own, whatever their ids, so equal ids and equal
    vectors are candidates too; where there are fewer than k, all of them are returned.

    The search is approximate: a true neighbour is found with probability ``confidence`` or
    more. The tree's splits are placed by the projections of at most ``sample_rows`` rows, which
    come to the driver; every row is indexed.

    Vectors that are null, empty, zero or hold null or non-finite numbers take no part, as
    candidate or query, and neither do those whose length is not the most common one (of equally
    common ones the greater). Other columns are not read; an empty table gives no rows.
    """
    return Index(vectors, vec_id=vec_id, vector=vector, **how).search(is_query, k)
