"""Exact n-gram Jaccard join of whole texts, down to components of linked documents.

Two sets link when 100 |x & y| >= p |x | y|, with p = 85 unless the caller says otherwise. The
distance 1 - Jaccard is a metric, and so is the size of the symmetric difference, in which sets
of size a <= b that link are at most q = (100 - p) a / p apart: 3a/17 at 85, a/4 at 80.

Regions. Shingles are put in one order for all sets, rare ones first. Sets that link share one of
the first 100 - p % of either's shingles and one more, so a set goes to the regions of those, and
linked sets meet. A sentence that very many texts hold comes last and makes no region while a text
has enough of its own. How rare a shingle is tell counts of a bounded number of hash buckets;
they only have to be the same for all sets. Regions of the same sets are joined once.

Pivots. Each region has a pivot, the smallest of its sets. All of a region's sets are held
against the pivot; linked ones share its component. Only regions whose sets lie in several
components are joined further, between components only, and again after each round's links.

Windows. A set's parity sketch changes in at most as many bits as the set in elements, so
sketches of linked sets lie within r = (100 - p) n / p bits, and bits apart are a metric too. By
the triangle inequality linked sets lie within r of each other in their distances to a pivot, so
a set is compared with those in that window only. A region of too many sets for a task is cut
into Voronoi cells of several pivots: a set goes to its nearest pivot at distance d, and to every
other pivot within d + 2r, where linked sets may be at home. Large cells are cut again.

Within a window, sketches more than (100 - p) (a + b) / (100 + p) bits apart prove that two sets do
not link. What is left is compared by the shingles of the whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, joined
from .membership import bitmap, key_hash, parted, possible
from .store import Tables, own, wrapped

SHINGLE = 4
#: Sets link at this percentage or more, unless the caller gives another.
PERCENT = 85
#: Sets that more than one in this many documents have; their copies take no part in regions.
HOT = 1000
#: Sets that a task compares with each other; larger regions are cut into cells.
TILE = 2048
#: Bits of a sketch for each shingle that linked sets may differ in, and at least.
SKETCH = 8
#: Pairs that a task remembers, so as to name them once.
NAMED = 1 << 16
#: Buckets that shingles are counted in, and buckets of a row of counts.
BUCKETS, CHUNK = 1 << 18, 1 << 14
#: Lots that the pairs of one set are dealt to.
LOTS = 16
_M = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of a whole text's distinct shingles of ``size`` words.

    A-Z count as lower case. A shorter text is one shingle; one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = _mixed(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    size = min(size, len(words))
    count = len(words) - size + 1
    rolled = hashes[:count] + np.uint64(size)
    for n in range(1, size):
        rolled = _mixed(rolled) + hashes[n : n + count]
    return np.unique(_mixed(rolled))


def set_id(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _most_apart(size: int, percent: int = PERCENT) -> int:
    """How far apart a set of ``size`` and a linked one no smaller may be."""
    return (100 - percent) * size // percent


def _bits_for(size: int, percent: int = PERCENT) -> int:
    """Bits of the sketch of a set of ``size``: a power of 2."""
    return SKETCH << math.ceil(math.log2(1.1 * (_most_apart(size, percent) + 1) + 2))


def levels(size: int, percent: int = PERCENT) -> list[int]:
    """Bits of the sketches that sets linked with one of ``size`` and no larger may have."""
    if not _most_apart(size, percent):  # too small to link with any other set
        return []
    least, most = _bits_for(-(-percent * size // 100), percent), _bits_for(size, percent)
    return [1 << k for k in range(least.bit_length() - 1, most.bit_length())]


def buckets(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def region_keys(found: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The regions a set goes to: of its shingles the rarest 100 - ``percent`` % and one more.

    ``counts`` tells for each bucket how many shingles there are; equally rare ones are in order
    of their hash.
    """
    if not levels(len(found), percent):
        return np.empty(0, np.uint64)
    order = np.argsort(counts[buckets(found)], kind="stable")
    return found[order[: len(found) - -(-percent * len(found) // 100) + 1]]


def sketch(found: np.ndarray, percent: int = PERCENT) -> bytes:
    """The parities of another hash's classes, as bits; none where no other set can link."""
    if not levels(len(found), percent):
        return b""
    bits = _bits_for(len(found), percent)
    counts = np.bincount((_mixed(found ^ _M) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A sketch, in bytes, of fewer bits; classes are numbers modulo their count."""
    while 8 * len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


_SETS = pa.schema([
    ("n", pa.int64()), ("s", pa.binary()), ("h", pa.int64()), ("sketch", pa.binary()),
    ("levels", pa.list_(pa.int32())),
])
_COUNTS = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])


def _describe(size: int, percent: int):
    """Every row's set, and behind a task's rows its counts of shingles by bucket."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int32)
        schema = None
        for batch in batches:
            rows = []
            for text in batch.column("_text"):
                found = shingles(text.as_py(), size)
                s = set_id(found)
                rows.append((len(found), s, _short(s), sketch(found, percent), levels(len(found), percent)))
                counts[buckets(found)] += 1
            columns = list(zip(*rows)) or [[]] * len(_SETS)
            schema = pa.schema([batch.schema.field("_id"), batch.schema.field("_digest"), *_SETS, *_COUNTS])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_digest")]
                + [pa.array(c, t) for c, t in zip(columns, _SETS.types)]
                + [pa.nulls(len(rows), t) for t in _COUNTS.types],
                schema=schema,
            )
        for chunk in range(0, BUCKETS if schema else 0, CHUNK):
            part = counts[chunk : chunk + CHUNK]
            if part.any():
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "counts": part.tobytes()}], schema)

    return describe


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of counts, chunk by chunk, from sorted rows."""
    known, total = None, None
    for batch in batches:
        for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            part = np.frombuffer(part, np.int32).astype(np.int64)
            if chunk != known:
                if known is not None:
                    yield _sums(known, total)
                known, total = chunk, np.zeros(CHUNK, np.int64)
            total += part
    if known is not None:
        yield _sums(known, total)


def _sums(chunk: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "counts"]
    )


def _short(s: bytes) -> int:
    return int.from_bytes(s[:8], "little", signed=True)


def _region_rows(size: int, percent: int, counts: np.ndarray, hot: dict[bytes, tuple]):
    """Key and set of each region a document goes to; of a hot set only one row takes part."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = batch.column("_id").to_pylist(), batch.column("_digest").to_pylist()
            keys, owners = [], []
            for row, text in zip(zip(ids, digests), batch.column("_text")):
                found = shingles(text.as_py(), size)
                s = set_id(found)
                if hot.get(s, row) == row:
                    own = region_keys(found, counts, percent)
                    keys.append(own)
                    owners.append(np.full(len(own), _short(s), np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))],
                    names=["key", "h"],
                )

    return rows


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and set: each further set of a region with the region's first."""
    last_key = last_h = pivot = None
    for batch in batches:
        key, h = batch.column("key").to_numpy(), batch.column("h").to_numpy()
        if not len(key):
            continue
        fresh = np.r_[last_key is None or key[0] != last_key, key[1:] != key[:-1]]
        other = np.r_[last_h is None or h[0] != last_h, h[1:] != h[:-1]] | fresh
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
        pivots = np.where(first >= 0, h[np.maximum(first, 0)], pivot if pivot is not None else 0)
        chosen = other & ~fresh
        last_key, last_h, pivot = key[-1], h[-1], pivots[-1]
        if chosen.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[chosen]), pa.array(h[chosen]), pa.array(pivots[chosen])],
                names=["key", "h", "pivot"],
            )


def _near(bits: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits ^ other).sum(axis=-1)


def _apart_at_most(n: np.ndarray, size: int, percent: int) -> np.ndarray:
    """By how many elements sets of ``n`` and one of ``size`` may differ and link, times 100 + percent."""
    return (100 - percent) * (n + size)


def _may_link(percent: int):
    """Pairs whose sizes and sketches do not rule out that they link."""

    def may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b, x, y in zip(*(batch.column(name).to_pylist() for name in ("n_a", "n_b", "k_a", "k_b"))):
                near = 100 * min(a, b) >= percent * max(a, b) and bool(x and y)
                if near:
                    bits = 8 * min(len(x), len(y))
                    x, y = (folded(np.frombuffer(k, np.uint8), bits) for k in (x, y))
                    near = int(_near(x, y)) * (100 + percent) <= (100 - percent) * (a + b)
                keep.append(near)
            chosen = batch.select(["s_a", "s_b"]).filter(pa.array(keep, pa.bool_()))
            if chosen.num_rows:
                yield chosen

    return may_link


def _bits(row: dict) -> np.ndarray:
    return folded(np.frombuffer(row["sketch"], np.uint8), row["m"])


def _cells(percent: int):
    """The cells that each set of a region goes to, as new region keys; its pivots come first."""

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pivots = None, []
        for batch in batches:
            cells, owners, sizes, wholes = [], [], [], []
            for row in batch.to_pylist():
                if (row["key"], row["m"], row["lot"]) != known:
                    known, pivots = (row["key"], row["m"], row["lot"]), []
                if row["is_pivot"]:
                    pivots.append(_bits(row))
                    continue
                own = _bits(row)
                gap = _near(np.array(pivots), own) if pivots else np.zeros(1, np.int64)
                window = gap.min() + 2 * _most_apart(row["n"], percent)
                inside = np.flatnonzero(gap <= window)
                salt = np.array([row["key"]], np.int64).view(np.uint64)
                cells.append(_mixed(inside.astype(np.uint64) * _M + _mixed(salt)))
                owners.append(np.full(len(inside), row["h"], np.int64))
                sizes.append(np.full(len(inside), row["m"], np.int32))
                wholes.append(np.full(len(inside), row["size"], np.int64))
            if cells:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells).view(np.int64)), pa.array(np.concatenate(owners)),
                     pa.array(np.concatenate(sizes)), pa.array(np.concatenate(wholes))],
                    names=["key", "h", "m", "whole"],
                )

    return cells_of


def _joined(best_only: bool, percent: int):
    """Join of a region's sets between components, by sketches; from rows sorted by region.

    Sets are in order of their distance from the first of them, the pivot; linked ones lie within
    a window of it. With ``best_only`` each set names the nearest one of another component only.
    """

    def within(rows: list[dict]) -> Iterator[tuple[bytes, bytes]]:
        bits = np.array([_bits(row) for row in rows]).view(np.uint32)
        to_pivot = _near(bits, bits[0])
        order = np.argsort(to_pivot, kind="stable")
        rows, bits, to_pivot = [rows[n] for n in order], bits[order], to_pivot[order]
        n = np.array([row["n"] for row in rows])
        label = np.unique([row["label"] for row in rows], return_inverse=True)[1]
        block = np.array([row["block"] for row in rows])
        own = np.array([row["own"] for row in rows])
        split = rows[0]["low"] != rows[0]["high"]
        reach = n * (100 - percent) // percent
        first = np.searchsorted(to_pivot, to_pivot - reach)
        last = np.searchsorted(to_pivot, to_pivot + reach, "right") if best_only else np.arange(len(rows))
        for at in range(len(rows)):
            window = slice(first[at], last[at])
            gap = _near(bits[window], bits[at])
            size = n[window]
            near = (gap * (100 + percent) <= _apart_at_most(size, n[at], percent)) & (label[window] != label[at])
            near &= 100 * np.minimum(size, n[at]) >= percent * np.maximum(size, n[at])
            near &= own[window] | own[at]  # sets with longer sketches meet at their own size
            if split:
                near &= block[window] != block[at]
            if best_only:
                if near.any():
                    yield rows[at]["s"], rows[first[at] + int(np.argmin(np.where(near, gap, 1 << 30)))]["s"]
            else:
                for other in np.flatnonzero(near):
                    yield rows[at]["s"], rows[first[at] + other]["s"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, key, pairs = [], None, set()
        for batch in batches:
            for row in batch.to_pylist():
                now = (row["key"], row["m"], row["low"], row["high"])
                if now != key:
                    if len(run) > 1:
                        pairs.update(tuple(sorted(pair)) for pair in within(run))
                    run, key = [], now
                    if len(pairs) > NAMED:
                        yield _pairs(pairs)
                        pairs = set()
                run.append(row)
        if len(run) > 1:
            pairs.update(tuple(sorted(pair)) for pair in within(run))
        if pairs:
            yield _pairs(pairs)

    return join


def _pairs(pairs) -> pa.RecordBatch:
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["s_a", "s_b"])


def _verify(size: int, percent: int):
    """Pairs that do link; the text of the one set comes before those of its partners."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held = None
        for batch in batches:
            keep = []
            names = ("s_a", "lot", "s_b")
            keys = zip(*(batch.column(name).to_pylist() for name in names))
            for (s_a, lot, s_b), text in zip(keys, batch.column("_text")):
                found = shingles(text.as_py(), size)
                if s_b is None:
                    known, held = (s_a, lot), found
                keep.append(s_b is not None and known == (s_a, lot) and linked(held, found, percent))
            chosen = batch.select(["s_a", "s_b"]).filter(pa.array(keep, pa.bool_()))
            if chosen.num_rows:
                yield chosen

    return verify


class _Join:
    """The join of one table; ``tables`` owns what it writes."""

    def __init__(self, docs: DataFrame, size: int, percent: int, doc_id: str, text: str, tables: Tables):
        self.size, self.percent, self.tables = size, percent, tables
        self.texts = docs.select(
            F.col(f"`{doc_id}`").alias("_id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_digest"),
            F.col(f"`{text}`").alias("_text"),
        )
        kind = self.texts.schema["_id"].dataType.simpleString()
        described = tables.stored(
            self.texts.mapInArrow(
                _describe(size, percent),
                f"_id {kind}, _digest string, n long, s binary, h long, sketch binary, "
                "levels array<int>, chunk int, counts binary",
            ),
            "jaccard_rows",
        )
        self.rows = described.filter("chunk is null").drop("chunk", "counts")
        self.counts = self._counts(described.filter("chunk is not null").select("chunk", "counts"))
        # One row for each set: the first document that has it.
        first = F.struct("_id", "_digest")
        self.sets = tables.stored(
            self.rows.groupBy("s").agg(
                F.first("h").alias("h"), F.first("n").alias("n"), F.min(first).alias("own"),
                F.min("_id").alias("least"), F.count("*").alias("copies"),
                F.first("sketch").alias("sketch"), F.first("levels").alias("levels"),
            ),
            "jaccard_sets",
        )
        total = self.rows.count()
        self.is_hot = F.col("copies") * HOT > total
        hot = self.sets.filter(self.is_hot).select("s", "own").collect()  # under HOT rows
        self.hot = {bytes(row["s"]): tuple(row["own"]) for row in hot}

    def _counts(self, parts: DataFrame) -> np.ndarray:
        """Sums of all tasks' counts: BUCKETS numbers, however many rows."""
        parts = parts.repartition("chunk").sortWithinPartitions("chunk")
        counts = np.zeros(BUCKETS, np.int64)
        for row in parts.mapInArrow(_added, "chunk int, counts binary").toLocalIterator():
            counts[row["chunk"] : row["chunk"] + CHUNK] = np.frombuffer(row["counts"], np.int64)
        return counts.astype(np.float32)  # all that matters is one order for all

    def stars(self) -> DataFrame:
        """``key, h, pivot, n``: the sets that share a region with its pivot, and how many they are.

        Of regions of the same sets, told by number and two sums of hashes, one is left.
        """
        keys = self.texts.mapInArrow(
            _region_rows(self.size, self.percent, self.counts, self.hot), "key long, h long"
        )
        regions = keys.repartition(F.col("key")).sortWithinPartitions("key", "h")
        stars = self.tables.stored(regions.mapInArrow(_stars, "key long, h long, pivot long"), "jaccard_stars")
        hashes = F.xxhash64("h"), F.xxhash64("h", "h")
        alike = stars.groupBy("key", "pivot").agg(
            F.count("*").alias("n"), *[F.bit_xor(own).alias(f"x{n}") for n, own in enumerate(hashes)]
        ).groupBy("pivot", "n", "x0", "x1").agg(F.min("key").alias("key")).select("key", "n")
        chosen = self.tables.stored(stars.join(alike, "key"), "jaccard_regions")
        self.tables.drop(stars)
        return chosen

    def _side(self, name: str) -> DataFrame:
        return self.sets.select(
            F.col("h").alias(f"h_{name}"), F.col("s").alias(f"s_{name}"),
            F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"k_{name}"),
        )

    def against_pivots(self, stars: DataFrame) -> DataFrame:
        pairs = stars.select(F.col("pivot").alias("h_a"), F.col("h").alias("h_b")).distinct()
        pairs = pairs.join(self._side("b"), "h_b").join(self._side("a"), "h_a")
        return pairs.filter("s_a <> s_b").mapInArrow(_may_link(self.percent), "s_a binary, s_b binary")

    def between_components(
        self, members: DataFrame, labels: DataFrame, best_only: bool, tables: Tables
    ) -> DataFrame:
        """Pairs of sets of a region that lie in different components and may link."""
        named = self.sets.join(
            labels.withColumnRenamed("node", "s"), "s", "left"
        ).select("h", "s", "n", "sketch", F.coalesce("label", "s").alias("label"))
        named = tables.stored(named, "jaccard_named")
        marked = named.select("h", "label")

        def open_ones(regions: DataFrame) -> DataFrame:
            """``regions`` whose sets lie in several components, and how many those are."""
            found = regions.join(marked, "h").groupBy("key", "m").agg(
                F.count("*").alias("size"), F.min("label").alias("first"), F.max("label").alias("last")
            )
            found = found.filter("size > 1 and first <> last").select("key", "m", "size")
            return tables.stored(regions.join(found, ["key", "m"]), "jaccard_open")

        found = members.join(self.sets.select("h", "levels"), "h").select(
            "key", "h", F.explode("levels").alias("m")
        )
        found = open_ones(found)
        settled = found.filter(F.col("size") <= TILE).select("key", "h", "m", "size")
        large = found.filter(F.col("size") > TILE)
        while not large.isEmpty():
            cells = tables.stored(self._cut(large, named), "jaccard_cells")
            found = open_ones(cells)
            # A region that its windows do not part any more is tiled instead.
            over = (F.col("size") <= TILE) | (F.col("size") > 0.9 * F.col("whole"))
            settled = settled.unionByName(found.filter(over).select("key", "h", "m", "size"))
            large = found.filter(~over)
        return self._in_cells(settled, named, best_only)

    def _cut(self, large: DataFrame, named: DataFrame) -> DataFrame:
        """The sets of large regions in the Voronoi cells of some two pivots for each task.

        A region's sets are dealt to lots; its pivots go to each lot once.
        """
        rows = large.select("key", "h", "m", "size").join(named.select("h", "n", "sketch"), "h")
        lots = F.ceil(F.col("size") / TILE).cast("int")
        is_pivot = F.pmod(F.xxhash64("h", "key"), F.col("size")) < 2 * F.ceil(F.col("size") / TILE)
        pivots = rows.filter(is_pivot).select(
            "*", F.explode(F.sequence(F.lit(0), lots - 1)).alias("lot"), F.lit(True).alias("is_pivot")
        )
        rows = rows.select(
            "*", F.pmod(F.xxhash64("h"), lots).cast("int").alias("lot"), F.lit(False).alias("is_pivot")
        )
        both = pivots.unionByName(rows).repartition(F.col("key"), F.col("m"), F.col("lot"))
        both = both.sortWithinPartitions("key", "m", "lot", F.desc("is_pivot"), "h")
        return both.mapInArrow(_cells(self.percent), "key long, h long, m int, whole long")

    def _in_cells(self, regions: DataFrame, named: DataFrame, best_only: bool) -> DataFrame:
        tiles = F.ceil(F.col("size") / TILE).cast("int")
        rows = regions.withColumn("block", F.pmod(F.xxhash64("h"), tiles).cast("int"))
        rows = rows.withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1)))
        rows = rows.select(
            "key", "h", "m", "block", F.least("block", "tile").alias("low"),
            F.greatest("block", "tile").alias("high"),
        ).join(named, "h").withColumn("own", 8 * F.octet_length("sketch") == F.col("m"))
        keys = ["key", "m", "low", "high"]
        rows = rows.repartition(*map(F.col, keys)).sortWithinPartitions(*keys, "s")
        return rows.mapInArrow(_joined(best_only, self.percent), "s_a binary, s_b binary")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs that do link, by the shingles of their whole texts.

        A pair's first set is dealt to lots; its text goes to a lot once, for all its partners
        there. Only texts of sets in pairs move: a bitmap holds all others back.
        """
        lot = F.pmod(F.xxhash64("s_b"), F.lit(LOTS)).cast("int")
        pairs = self.tables.stored(pairs.distinct().withColumn("lot", lot), "jaccard_pairs")
        heads = pairs.select("s_a", "lot").distinct().select(
            F.col("s_a").alias("s"), "s_a", "lot", F.lit(None).cast("binary").alias("s_b")
        )
        needed = heads.unionByName(pairs.withColumn("s", F.col("s_b")))
        needed = needed.join(self.sets.select("s", "own"), "s").select(
            key_hash(F.col("own._id"), F.col("own._digest")).alias("k"), "s_a", "lot", "s_b"
        )
        needed = self.tables.stored(needed, "jaccard_needed")
        words = bitmap(needed.select("k"), self.tables, "jaccard_bitmap")
        texts = self.texts.withColumn("_k", key_hash(F.col("_id"), F.col("_digest")))
        # Copies of a row are one row before they cross, and the join needs no other exchange.
        texts = possible(texts, F.col("_k"), words).groupBy("_k").agg(F.first("_text").alias("_text"))
        both = needed.join(texts, F.col("k") == F.col("_k")).select("s_a", "lot", "s_b", "_text")
        both = both.repartition(F.col("s_a"), F.col("lot")).sortWithinPartitions("s_a", "lot", "s_b")
        found = both.mapInArrow(_verify(self.size, self.percent), "s_a binary, s_b binary")
        found = self.tables.stored(found, "jaccard_links")
        self.tables.drop(pairs, needed, words)
        return found

    def labels(self) -> DataFrame:
        """``node, label`` of sets that link with others."""
        stars = self.stars()
        # Two sets of a region will have been held against each other as pivot and set.
        larger = stars.filter("n > 1")
        members = self.tables.stored(
            larger.select("key", "h").unionByName(
                larger.select("key", F.col("pivot").alias("h")).distinct()
            ),
            "jaccard_members",
        )
        links = self.links(self.against_pivots(stars))
        labels = components(links.toDF("a", "b"), self.tables)
        # What is nearest first, so that most of a group is one component before the rest.
        for best_only in (True, False):
            with Tables() as tables:
                more = self.links(self.between_components(members, labels, best_only, tables))
            if not more.isEmpty():
                labels = joined(labels, more.toDF("a", "b"), self.tables)
        return labels


def _members(
    docs: DataFrame, size: int, percent: int, doc_id: str, text: str, tables: Tables
) -> tuple[DataFrame, DataFrame]:
    """Every row with its set and the component's label, and the labels' smallest ids."""
    join = _Join(docs, size, percent, doc_id, text, tables)
    labels = join.labels().withColumnRenamed("node", "s")
    groups = join.sets.join(labels, "s", "left").select(
        "s", "least", "copies", F.coalesce("label", "s").alias("label")
    )
    least = groups.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = tables.stored(groups.join(least, "label"), "jaccard_groups")
    rows = join.rows.select("_id", "_digest", "n", "s")
    hot = F.broadcast(groups.filter(join.is_hot))  # fewer than HOT rows
    cold = groups.filter(~join.is_hot)
    placed = rows.join(hot, "s").unionByName(rows.join(hot, "s", "left_anti").join(cold, "s"))
    return placed, groups


def jaccard_components(
    docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Sets of ``shingle`` words link when their Jaccard similarity is ``percent`` % or more. A
    component is what links reach; its id is the smallest document id in it. Texts without
    words have no shingles and link with nothing, so their component is their own id. Rows
    with the same shingles are one set, so copies cost one comparison however many they are.
    Null ids count for no component's id. Other columns are not read. Shingles are compared by
    64-bit hashes, sets by 128-bit ones.
    """
    own = F.when(F.col("n") == 0, F.col("_id")).otherwise(F.col("component_id"))
    with Tables() as tables:
        placed, _ = _members(docs, shingle, percent, doc_id, text, tables)
        found = tables.stored(
            placed.select(
                F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id")
            ),
            "jaccard_components",
        )
        tables.keep(found)
    return found


def keep_one(
    docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with one document of each component: the smallest id, then digest of the text.

    ``shingle`` and ``percent`` are those of :func:`jaccard_components`.

    All columns stay. Documents without words all stay. Of rows with the same id and text one
    stays; without ids, one of each component that has none.
    """
    whole = F.coalesce(own(text), F.lit(""))
    with Tables() as tables:
        placed, _ = _members(docs, shingle, percent, doc_id, text, tables)
        placed = tables.stored(placed.filter(F.col("n") > 0).select("_id", "_digest", "label"), "jaccard_placed")
        first = F.min(F.struct(F.col("_id").isNull(), "_id", "_digest")).alias("k")
        kept = placed.groupBy("label").agg(first).select("k._id", "k._digest")
        repeated = placed.groupBy("_id", "_digest").agg(F.count("*").alias("rows"))
        # Each id and text that goes, or comes several times; the others stay as they are.
        same = F.col("_id").eqNullSafe(F.col("kept_id")) & (F.col("_digest") == F.col("kept_digest"))
        touched = repeated.join(kept.toDF("kept_id", "kept_digest"), same, "left").select(
            F.col("_id").alias("_touched_id"), F.col("_digest").alias("_touched_digest"),
            F.col("kept_digest").isNotNull().alias("_stays"), "rows",
        ).filter("not _stays or rows > 1").drop("rows")
        touched = tables.stored(touched, "jaccard_touched")
        hashed = touched.select(key_hash(F.col("_touched_id"), F.col("_touched_digest")).alias("k"))
        words = bitmap(hashed, tables, "jaccard_touched_bitmap")
        tables.keep(touched, words)
    rows = wrapped(docs).withColumns({"_id": own(doc_id), "_digest": F.md5(whole)})
    maybe, others = parted(rows, key_hash(F.col("_id"), F.col("_digest")), words)
    same = F.col("_id").eqNullSafe(F.col("_touched_id")) & (F.col("_digest") == F.col("_touched_digest"))
    met = maybe.join(touched, same, "left")
    untouched = met.filter("_stays is null")
    once = met.filter("_stays").dropDuplicates(["_id", "_digest"])
    stay = others.select("_row").unionByName(untouched.select("_row")).unionByName(once.select("_row"))
    return stay.select("_row.*")
