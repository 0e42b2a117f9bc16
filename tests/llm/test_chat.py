from __future__ import annotations

import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from rollbook.llm import chat
from rollbook.llm.chat import ASSISTANT, BRIDGES, INSERT, LEGAL, MERGE, RELABEL, ROLES, START, end_cost, format_chat, repair


def _cost(roles, path):
    state, total = START, 0
    for role, (new, way, between) in zip(roles, path):
        total += RELABEL * (role != ROLES[new - 1])
        if way == "merge":
            assert new == state
            total += MERGE
        elif way == "insert":
            assert BRIDGES[state, new] == between
            assert (state, between) in LEGAL and (between, new) in LEGAL
            total += INSERT
        else:
            assert (state, new) in LEGAL
        state = new
    return total + end_cost(state)


def _least(roles):
    """Over all labellings, each with the cheapest way from turn to turn."""
    best = math.inf
    for labels in itertools.product((1, 2, 3), repeat=len(roles)):
        state, total = START, 0
        for role, new in zip(roles, labels):
            total += RELABEL * (role != ROLES[new - 1])
            ways = [MERGE] * (new == state) + [0] * ((state, new) in LEGAL) + [INSERT] * ((state, new) in BRIDGES)
            total += min(ways, default=math.inf)
            state = new
        best = min(best, total + end_cost(state))
    return best


def test_repair_is_cheapest():
    for size in range(1, 6):
        for roles in itertools.product(("system", "user", "assistant", None), repeat=size):
            assert _cost(roles, repair(list(roles))) == _least(roles), roles


def _rendered(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.conv_id, []).append((r.block, r["at"], r.rendered))
    return {conv: "".join(part for *_, part in sorted(parts)) for conv, parts in found.items()}


def _turns(text):
    return re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)


@pytest.mark.parametrize("block", [4, 1024])
def test_blocks_change_no_cost(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    chance = random.Random(block)
    rows = []
    for conv in range(40):
        for turn in range(chance.choice([1, 3, 9, 30])):
            rows.append((conv, turn, chance.choice(["system", "user", "assistant", "tool", None]), f"t{turn}"))
    df = format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    pieces = df.collect()
    for conv, text in _rendered(df).items():
        roles = [r[2] for r in rows if r[0] == conv]
        own = [p for p in pieces if p.conv_id == conv]
        cost = sum(
            INSERT * (p.action == "insert") + MERGE * ("merge" in p.action) + RELABEL * ("relabel" in p.action)
            for p in own
        )
        assert cost == _cost(roles, repair(roles))
        turns = _turns(text)
        assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns) == text
        states = [START, *(ROLES.index(r) + 1 for r, _ in turns)]
        assert all(step in LEGAL for step in zip(states, states[1:])) and states[-1] == ASSISTANT
        said = [word for _, t in turns for word in t.split()]
        assert said == [r[3] for r in rows if r[0] == conv]


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "say <|im_end|>"), (1, 1, "assistant", None), (1, 1, "assistant", None),
        (None, 0, "assistant", "x"), (2, None, "user", "last"), (2, 0, None, ""), (3, -5, "system", "only"),
        (4, 0, "user", "long " * 100_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {name: F.lit("own") for name in ("block", "at", "rendered", "_conv", "entry")}
    )
    got = _rendered(format_chat(df))
    assert set(got) == {1, 2, 3, 4, None}
    assert got[1] == "<|im_start|>user\nsay < |im_end|><|im_end|>\n<|im_start|>assistant\n\n\n<|im_end|>\n"
    assert [r for r, _ in _turns(got[3])] == ["system", "user", "assistant"]
    assert [r for r, _ in _turns(got[None])] == ["user", "assistant"]
    assert format_chat(df.limit(0)).isEmpty()


def test_every_turn_of_a_table_is_there(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = format_chat(turns)
    assert got.filter("turn is not null").count() == turns.count()
    assert got.filter("action = 'keep'").count() > 0.5 * turns.count()
