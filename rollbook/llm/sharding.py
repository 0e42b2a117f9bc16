"""Sharding by histogram sort: exact counts below probed keys, one exchange at the end."""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .repeats import told_apart
from .store import literal_rows, stored

#: A key is two numbers of KEY_BITS bits; a round of probes looks at PROBE_BITS of them.
KEY_BITS = 60
PROBE_BITS = 12
PROBES = 1 << PROBE_BITS
ROUNDS = 2 * KEY_BITS // PROBE_BITS
#: A shard's share of the bytes by which a splitter may miss its place: anywhere, and where
#: a nearer splitter would cut a group of equal first keys.
TOLERANCE = 0.001
GROUP_TOLERANCE = 0.02
#: Bytes of rows that one group of the final exchange should get.
RANGE_BYTES = 128 << 20
#: Bits of the first and of the second number by which a shard's rows are dealt to groups.
PART_BITS, LOT_BITS = 12, 4


def hashed_key(value: Column) -> Column:
    """A key that spreads any values evenly; equal values have equal keys."""
    return F.shiftrightunsigned(F.xxhash64(value), 64 - KEY_BITS)


@dataclass
class _Splitter:
    target: float
    tolerance: float
    prefix: int = 0
    rows: int = 0
    bytes: int = 0
    key: tuple[int, int] | None = field(default=None)


def _prefix(round_no: int) -> Column:
    """The bits of the key that earlier rounds have settled, as a decimal both numbers fit in."""
    bits = PROBE_BITS * round_no
    if bits <= KEY_BITS:
        return F.shiftright("k1", KEY_BITS - bits).cast("decimal(38,0)")
    high = F.col("k1").cast("decimal(38,0)") * F.lit(1 << (bits - KEY_BITS)).cast("decimal(19,0)")
    return (high + F.shiftright("k2", 2 * KEY_BITS - bits)).cast("decimal(38,0)")


def _probe(round_no: int) -> Column:
    bits = PROBE_BITS * (round_no + 1)
    number, shift = ("k1", KEY_BITS - bits) if bits <= KEY_BITS else ("k2", 2 * KEY_BITS - bits)
    return F.shiftright(number, shift).bitwiseAND(F.lit(PROBES - 1))


def _histogram(keys: DataFrame, round_no: int, prefixes: list[int]) -> dict:
    """Exact rows and bytes between neighbouring probes below each of ``prefixes``."""
    rows = keys.select(_prefix(round_no).alias("prefix"), _probe(round_no).alias("probe"), "bytes")
    if round_no:
        wanted = literal_rows(
            keys.sparkSession, [(str(p),) for p in prefixes], "prefix string"
        ).select(F.col("prefix").cast("decimal(38,0)"))
        rows = rows.join(F.broadcast(wanted), "prefix", "left_semi")
    counted = rows.groupBy("prefix", "probe").agg(
        F.count("*").alias("rows"), F.sum("bytes").alias("bytes")
    )
    found: dict[int, list] = {}
    for row in counted.toLocalIterator():
        found.setdefault(int(row["prefix"]), []).append((row["probe"], row["rows"], row["bytes"]))
    return {prefix: sorted(probes) for prefix, probes in found.items()}


def _key(prefix: int, round_no: int) -> tuple[int, int]:
    """The smallest key of those that begin with ``prefix`` after ``round_no`` rounds."""
    whole = prefix << (2 * KEY_BITS - PROBE_BITS * round_no)
    return whole >> KEY_BITS, whole & ((1 << KEY_BITS) - 1)


def _settle(splitter: _Splitter, probes: list, round_no: int) -> bool:
    """Put the splitter on a probe near enough, or narrow it down to the probes around it."""
    rows, size = splitter.rows, splitter.bytes
    for probe, more_rows, more in probes:
        if size + more >= splitter.target or probe == probes[-1][0]:
            break
        rows, size = rows + more_rows, size + more
    below, above = splitter.target - size, size + more - splitter.target
    child = (splitter.prefix << PROBE_BITS) + probe
    bits = PROBE_BITS * (round_no + 1)
    # Where the first number ends, going on would cut a group of equal first numbers.
    room = splitter.tolerance * (GROUP_TOLERANCE / TOLERANCE if bits >= KEY_BITS else 1)
    if min(abs(below), abs(above)) > room and more_rows > 1 and round_no + 1 < ROUNDS:
        splitter.prefix, splitter.rows, splitter.bytes = child, rows, size
        return False
    if abs(above) < abs(below):
        child, rows, size = child + 1, rows + more_rows, size + more
    splitter.rows, splitter.bytes = rows, size
    splitter.key = _key(child, round_no + 1)
    return True


def find_splitters(keys: DataFrame, shards: int) -> list[_Splitter]:
    """Splitters that cut ``keys`` (k1, k2, bytes) into ``shards`` ranges.

    Every round counts, over all rows, what lies between the probes around each splitter
    that has not found its place; its share of the key range shrinks 4096-fold. At most
    4096 counts for each open splitter reach the driver, however many rows there are.
    """
    total = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tolerance = total / shards * TOLERANCE
    splitters = [_Splitter(total * n / shards, tolerance) for n in range(1, shards)] if total else []
    open_ones, round_no = splitters, 0
    while open_ones:
        counted = _histogram(keys, round_no, sorted({s.prefix for s in open_ones}))
        open_ones = [s for s in open_ones if not _settle(s, counted[s.prefix], round_no)]
        round_no += 1
    for before, after in zip(splitters, splitters[1:]):
        if after.key < before.key:
            after.key, after.rows, after.bytes = before.key, before.rows, before.bytes
    return splitters


def _shard_of(rows: DataFrame, splitters: list[_Splitter]) -> DataFrame:
    """``rows`` with the number of splitters at or below ``_k1, _k2``."""
    # Which splitters share the first bits of a key, and how many lie below all of those.
    by_probe: dict[int, list] = {}
    for s in splitters:
        by_probe.setdefault(min(s.key[0] >> (KEY_BITS - PROBE_BITS), PROBES), []).append(s.key)
    starts = sorted(s.key[0] >> (KEY_BITS - PROBE_BITS) for s in splitters)
    places = literal_rows(
        rows.sparkSession,
        [
            (probe, bisect_right(starts, probe - 1), [[k1, k2] for k1, k2 in by_probe.get(probe, [])])
            for probe in range(PROBES)
        ],
        "_at long, _below int, _near array<array<bigint>>",
    )
    found = rows.join(
        F.broadcast(places), F.shiftright("_k1", KEY_BITS - PROBE_BITS) == F.col("_at")
    )
    passed = F.filter(
        "_near",
        lambda s: (s[0] < F.col("_k1")) | ((s[0] == F.col("_k1")) & (s[1] <= F.col("_k2"))),
    )
    return found.withColumn("_shard", F.col("_below") + F.size(passed)).drop("_at", "_below", "_near")


def shard(
    df: DataFrame,
    *,
    size: Column,
    key: Column,
    tie: Column,
    shards: int = 16,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: its rows in order of ``key``, cut into even bytes.

    ``key`` and ``tie`` are numbers from 0 to 2**60 - 1, such as :func:`hashed_key`; ``size``
    is a row's bytes, not null and at least 1. Shards are ranges of (key, tie). Rows of equal
    key stay together where the sizes allow it (2 % of a shard); a key with more rows than that
    is cut by ``tie``, and rows equal in both, where they are over a thousandth of all, by a number
    that each gets, so that the law holds however many there are.

    Slots number the rows of a shard from 0 without gaps. A shard is dealt to groups by the
    first bits of key and tie, of which all shards together have at most some 65,000; counts of
    the groups, which every task gets, tell at which slot each begins. Within a group slots are
    in order of key and tie. No rows give no rows. Columns named ``shard`` or ``slot`` are
    replaced; all others stay.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in ("shard", "slot")]
    keyed = df.select(
        F.struct(*kept).alias("_row"), key.cast("long").alias("_k1"),
        tie.cast("long").alias("_tie"), size.cast("long").alias("_bytes"),
    )
    keyed = told_apart(keyed, F.col("_k1"), F.col("_tie"))
    k2 = F.when(F.col("_number") == 0, F.col("_tie")).otherwise(hashed_key(F.struct("_tie", "_number")))
    keyed = keyed.select("_row", "_k1", k2.alias("_k2"), "_bytes")
    keys = stored(keyed.select("_k1", "_k2", "_bytes"), "shard_keys")
    splitters = find_splitters(keys.toDF("k1", "k2", "bytes"), shards)

    total = keys.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    part_bits = min(PART_BITS, max(0, math.ceil(math.log2(max(1, total / range_bytes / (1 << LOT_BITS))))))
    part = F.shiftright("_k1", KEY_BITS - part_bits) if part_bits else F.lit(0).cast("long")
    lot = F.shiftright("_k2", KEY_BITS - LOT_BITS)
    group = {"_part": part, "_lot": lot}
    counted = _shard_of(keys, splitters).withColumns(group).groupBy("_shard", "_part", "_lot").agg(
        F.count("*").alias("_n")
    )
    before = F.expr(
        "sum(_n) over (partition by _shard order by _part, _lot rows between unbounded preceding and 1 preceding)"
    )
    # At most 2 ** (PART_BITS + LOT_BITS) groups, and some more where a splitter parts one.
    groups = stored(
        counted.select("_shard", "_part", "_lot", F.coalesce(before, F.lit(0)).alias("_before")).toDF(
            "_in_shard", "_in_part", "_in_lot", "_before"
        ),
        "shard_groups",
    )
    found = _shard_of(keyed, splitters).withColumns(group).join(
        F.broadcast(groups),
        (F.col("_shard") == F.col("_in_shard")) & (F.col("_part") == F.col("_in_part"))
        & (F.col("_lot") == F.col("_in_lot")),
    )
    rank = F.expr("row_number() over (partition by _shard, _part, _lot order by _k1, _k2)")
    slot = F.col("_before") + rank - 1
    return found.select("_row.*", F.col("_shard").alias("shard"), slot.cast("long").alias("slot"))
