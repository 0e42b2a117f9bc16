from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from functools import lru_cache

import pytest
from helpers import CLASHING, tuples
from pyspark.sql import functions as F

from rollbook.llm import queries, turn_alignment
from rollbook.llm.turn_alignment import DELETE, END, Aligner, _table, repair, summaries

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def plain_repair(codes, entry=0, ahead=END):
    """Least cost and its least audit over all edit sequences, by trying each next edit."""

    @lru_cache(None)
    def go(at, state, inserted):
        ways = []
        if at == len(codes) and ahead[state] < math.inf:
            ways.append((ahead[state], ""))

        def take(cost, edit, rest):
            if rest:
                ways.append((cost + rest[0], edit + rest[1]))

        if at < len(codes):
            code = codes[at]
            extra = 3 if code.isupper() else 0
            take(4, "D", go(at + 1, state, 0))
            if code != "x":
                for letter, new in NEXT[state].items():
                    if code.lower() == letter:
                        take(extra, "K", go(at + 1, new, 0))
                    elif letter != "s":
                        take(3 + extra, "R", go(at + 1, new, 0))
        if inserted < 3:
            for letter, new in NEXT[state].items():
                if letter != "s":
                    take(3, "I", go(at, new, inserted + 1))
        return min(ways, default=None)

    return go(0, entry, 0)


def test_alignment_against_all_edits():
    chance, aligner = random.Random(4), Aligner()
    for n in range(1500):
        codes = "".join(chance.choices("suaoSUAOx", [2, 6, 6, 1, 1, 2, 2, 1, 2], k=chance.randrange(0, 11)))
        cost, audit, _ = aligner.best(codes)
        assert (cost, audit) == plain_repair(codes), codes


def test_alignment_of_blocks_against_all_edits():
    chance, aligner = random.Random(5), Aligner()
    for n in range(600):
        codes = "".join(chance.choices("suaoSUAx", k=chance.randrange(0, 8)))
        entry = chance.randrange(4)
        ahead = tuple(chance.choice([math.inf, 0.0, 3.0, 4.0, 7.0]) for _ in range(4))
        cost, audit, leave = aligner.best(codes, entry, ahead)
        plain = plain_repair(codes, entry, ahead)
        assert cost == (plain[0] if plain else math.inf)
        if plain:
            assert audit == plain[1] and ahead[leave] < math.inf


def test_a_wider_band_changes_nothing():
    chance = random.Random(6)
    for _ in range(40):
        rows = "".join(chance.choices("suaoUA", k=chance.randrange(1, 30)))
        whole = _table(rows, "a", 1000.0)
        for width in (3, 12, 40):
            band = _table(rows, "a", float(width))
            for r, row in enumerate(band):
                for k, cost in row.items():
                    assert cost >= whole[r][k] and (whole[r][k] > width or cost == whole[r][k])


def plain_summary(rows):
    """From damaged (turn, role, text) rows in order: the contract's columns."""
    seen, codes, faults = set(), "", []
    for _, role, text in rows:
        worded = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = None
        if not worded:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif worded[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faults.append(fault)
        code = role[:1] if role[:1] in set("sua") else "o"
        codes += "x" if fault in ("blank", "duplicate") else code.upper() if fault else code
    cost, audit = plain_repair(codes)
    out, state, at = [], 0, 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at][1:]
        if edit in "RI":
            role = "assistant" if state == "u" else "user"
        if edit != "D":
            state = role[:1]
            out.append(f"{role}:{text}")
        at += edit != "I"
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def plain_damage(rows):
    found = []
    for conv, turn, role, text in rows:
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if way == 0:
            continue
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        found += [(conv, turn, role, text)] * (2 if way == 3 else 1)
    return found


def expected(rows):
    kept = {}
    for conv, turn, role, text in plain_damage(rows):
        kept.setdefault(conv, []).append((turn, role, text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return sorted(
        ((conv, *plain_summary(sorted(kept.get(conv, []), key=order))) for conv in {r[0] for r in rows}), key=repr
    )


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = queries.op12_conversation_repair(spark, sf_dir).select(NAMES)
    assert tuples(got) == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def _odd():
    rows = [(1, None, "user", "hi."), (1, 3, None, None), (1, 3, "tool", "x."), (2, 0, "assistant", "ok!"),
            (None, 1, "user", "Null."), (None, 1, "user", "Null."), (None, None, "assistant", "é中?"),
            (3, 5, "", "a."), (3, 5, "user", " \t"), (3, -4, "system", "sys"), (4, 1, "system", "only."),
            (5, 10**12, "user", "far."), (5, 0, "assistant", "w " * 60_000 + ".  \n")]
    chance = random.Random(9)
    for conv in range(10, 40):
        for turn in range(chance.randrange(1, 12)):
            rows.append((conv, turn if turn % 5 else None, chance.choice(["system", "user", "assistant", "user", "x"]),
                         chance.choice(["one.", "two!", "three", "", "four?"])))
    return rows


@pytest.mark.parametrize("block", [2, 3, 256])
def test_odd_rows_in_blocks_of_any_size(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(turn_alignment, "BLOCK", block)
    rows = _odd()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    clashing = table.withColumns({name: F.lit("own") for name in [*CLASHING, "_conv", "_turn", "edit", "_of"]})
    clashing.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_conversation_repair(spark, str(tmp_path))
    assert tuples(got.select(NAMES)) == expected(rows)
    assert repair(table.limit(0)).isEmpty() and summaries(repair(table.limit(0))).isEmpty()


def test_one_long_conversation(spark):
    chance = random.Random(11)
    rows = [(n, chance.choice(["user", "assistant"]), f"{chance.randrange(900)} words{chance.choice('.!?,')}")
            for n in range(3000)]
    table = spark.createDataFrame([(7, *r) for r in rows], "conv_id long, turn long, role string, text string")
    edits = repair(table)
    biggest = edits.groupBy("conv_id", "block").count().agg(F.max("count")).first()[0]
    assert edits.select("block").distinct().count() == math.ceil(3000 / 256) and biggest < 600
    (row,) = summaries(edits).collect()
    # Without blocks and audits, the same cost by a plain pass over states.
    seen, costs = set(), {0: 0}
    for _, role, text in rows:
        step = {}
        for state, cost in costs.items():
            ways = {state: cost + DELETE}
            if (role, text) not in seen:
                extra = 0 if text[-1] in ".!?" else 3
                for letter, new in NEXT[state].items():
                    if letter != "s":
                        ways[new] = cost + extra + 3 * (letter != role[0])
                        for later, then in NEXT[new].items():
                            ways[then] = min(ways.get(then, math.inf), cost + 3 + extra + 3 * (later != role[0]))
            for new, value in ways.items():
                step[new] = min(step.get(new, math.inf), value)
        seen.add((role, text))
        costs = step
    assert row.cost == min(costs[0], costs[3], costs[2] + 3)
    kept = [r.role[0] for r in edits.filter("edit <> 'D'").orderBy("block", "at").collect()]
    assert re.fullmatch("s?(ua)+", "".join(kept)) and len(row.audit) == edits.count()
