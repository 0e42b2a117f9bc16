"""Chat formatting: the cheapest repair of a conversation's roles, then its rendering."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .store import stored

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: What a turn may follow without anything in between.
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: The empty turn that makes one turn after another legal.
BRIDGES = {
    (START, ASSISTANT): USER, (SYSTEM, ASSISTANT): USER,
    (USER, USER): ASSISTANT, (ASSISTANT, ASSISTANT): USER,
}
MERGE, RELABEL, INSERT = 1, 3, 2
#: Turns that one task repairs together.
BLOCK = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _steps(state: int, role: str | None) -> list[tuple[int, int, str, int]]:
    """What a turn may become after ``state``: new state, cost, way and inserted state."""
    found = []
    for new in (SYSTEM, USER, ASSISTANT):
        cost = 0 if role == ROLES[new - 1] else RELABEL
        if (state, new) in LEGAL:
            found.append((new, cost, "turn", START))
        elif state == new:
            found.append((new, cost + MERGE, "merge", START))
        if (state, new) in BRIDGES:
            found.append((new, cost + INSERT, "insert", BRIDGES[state, new]))
    return found


def end_cost(state: int) -> float:
    """A conversation ends with the assistant; after a user an empty answer is inserted."""
    return {ASSISTANT: 0, USER: INSERT}.get(state, math.inf if state == START else 2 * INSERT)


def _forward(roles: list[str | None], entry: int) -> tuple[list[list[float]], list[list[tuple]]]:
    costs, ways = [[math.inf] * STATES], []
    costs[0][entry] = 0
    for role in roles:
        best, way = [math.inf] * STATES, [None] * STATES
        for state in range(STATES):
            if costs[-1][state] < math.inf:
                for new, cost, kind, between in _steps(state, role):
                    if costs[-1][state] + cost < best[new]:
                        best[new] = costs[-1][state] + cost
                        way[new] = (state, kind, between)
        costs.append(best)
        ways.append(way)
    return costs, ways


def block_costs(roles: list[str | None]) -> list[float]:
    """Cheapest way through a block from each state to each state, row by row."""
    return [cost for entry in range(STATES) for cost in _forward(roles, entry)[0][-1]]


def repair(roles: list[str | None], entry: int = START, leave: int | None = None) -> list[tuple]:
    """For each turn its state, way and inserted state, at the least total cost.

    ``leave`` fixes the last state; otherwise the end of the conversation follows. Of equally
    cheap repairs the one found first in the order of states stays.
    """
    costs, ways = _forward(roles, entry)
    if leave is None:
        leave = min(range(STATES), key=lambda s: (costs[-1][s] + end_cost(s), s))
    path = []
    for way in reversed(ways):
        before, kind, between = way[leave]
        path.append((leave, kind, between))
        leave = before
    return path[::-1]


def _safe(text: str) -> str:
    """Text that holds none of the format's own marks."""
    return text.replace("<|", "< |")


def _pieces(roles, texts, entry: int, leave: int | None, last: bool) -> list[dict]:
    """Rendered pieces of a block; put together in order they are the conversation."""
    found, state = [], entry

    def add(role: int, action: str, turn: int | None, text: str) -> None:
        found.append({"role": ROLES[role - 1], "action": action, "nth": turn, "rendered": text})

    for n, ((new, kind, between), text) in enumerate(zip(repair(roles, entry, leave), texts)):
        close = CLOSE if state != START else ""
        if kind == "insert":
            add(between, "insert", None, f"{close}{OPEN}{ROLES[between - 1]}\n")
            close = CLOSE
        changed = roles[n] != ROLES[new - 1]
        if kind == "merge":
            add(new, "relabel and merge" if changed else "merge", n, "\n\n" + _safe(text or ""))
        else:
            head = f"{close}{OPEN}{ROLES[new - 1]}\n"
            add(new, "relabel" if changed else "keep", n, head + _safe(text or ""))
        state = new
    if last:
        missing = {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(state, ())
        for role in missing:
            add(role, "insert", None, f"{CLOSE}{OPEN}{ROLES[role - 1]}\n")
        found[-1]["rendered"] += CLOSE
    return found


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """Rows of one block of a conversation after another, from rows sorted by both."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in names)):
            if rows and row[:2] != rows[-1][:2]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _through(costs: pa.Table, schema: pa.Schema) -> pa.Table:
    """Entry and last state of each block on a cheapest way through the conversation."""
    blocks = sorted(costs.to_pylist(), key=lambda row: row["_block"])
    reached, ways = [0 if s == START else math.inf for s in range(STATES)], []
    for row in blocks:
        matrix = row["costs"]
        options = [
            min((reached[s] + matrix[s * STATES + new], s) for s in range(STATES))
            for new in range(STATES)
        ]
        reached = [cost for cost, _ in options]
        ways.append([state for _, state in options])
    leave = min(range(STATES), key=lambda s: (reached[s] + end_cost(s), s))
    found = []
    for row, way in zip(reversed(blocks), reversed(ways)):
        found.append({
            "_conv": row["_conv"], "_block": row["_block"], "entry": way[leave], "leave": leave,
            "last": row is blocks[-1],
        })
        leave = way[leave]
    return pa.Table.from_pylist(found, schema)


def format_chat(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Every conversation repaired to legal turns at the least cost, and rendered.

    Legal is an optional system turn, then user and assistant in turn, the assistant last. A
    turn may be merged into the one before (cost 1), relabelled (3) or preceded by an empty
    turn that was missing (2). Returns pieces: ``conv_id, block, at`` (their order), ``turn``
    (null for inserted ones), ``role``, ``action``, ``rendered``; the texts of a
    conversation's pieces joined in order are the rendered conversation, so that no row grows
    with the length of a conversation.

    A conversation is cut by place into blocks of 1,024 turns. A block's costs from each state
    to each state form a small matrix; the matrices of a conversation tell the states between
    its blocks, and each block is then repaired on its own. Turns of one block are held by a
    task together, and those are never more than 1,024. Places come from one sort of all
    turns, dealt out by ranges that also part equal turns.

    Roles other than system, user and assistant, and null, have to be relabelled. Null texts
    are empty; marks of the format inside a text are broken up. Repeated turn numbers are
    ordered by role and text, null ones come last. Null ids are one conversation. Other
    columns are not read.
    """
    turn_rows = turns.select(
        F.col(conv_id).alias("_conv"), F.col(turn).cast("long").alias("_turn"),
        F.col(role).alias("_role"), F.col(text).alias("_text"),
        # The number as given, for the order; and a tie, so that equal rows part too.
        F.col(turn).alias("_given"), F.monotonically_increasing_id().alias("_tie"),
    )
    kind = turn_rows.schema["_conv"].dataType.simpleString()
    rows = _placed(turn_rows, kind)
    long_ones = (
        rows.groupBy("_conv").agg(F.max("_block").alias("final"))
        .filter("final > 0").select(F.col("_conv").alias("long_conv"))
    )
    long_ones = stored(long_ones, "chat_long")
    slim = rows.drop("_text").join(long_ones, F.col("_conv").eqNullSafe(F.col("long_conv")), "left_semi")
    cost_schema = f"_conv {kind}, _block long, costs array<double>"
    state_schema = f"_conv {kind}, _block long, entry int, leave int, last boolean"
    arrow_costs, arrow_states = _arrow(turns, cost_schema), _arrow(turns, state_schema)

    def costs(batches):
        for block in _blocks(batches, ["_conv", "_block", "_role"]):
            row = {"_conv": block[0][0], "_block": block[0][1], "costs": block_costs([r[2] for r in block])}
            yield pa.RecordBatch.from_pylist([row], arrow_costs)

    states = (
        _sorted(slim).mapInArrow(costs, cost_schema)
        .groupBy("_conv").applyInArrow(lambda table: _through(table, arrow_states), state_schema)
    )
    states = stored(states, "chat_states").toDF("_of", "_in", "entry", "leave", "last")
    placed = rows.join(
        states, F.col("_conv").eqNullSafe(F.col("_of")) & (F.col("_block") == F.col("_in")), "left"
    ).drop("_of", "_in")
    out_schema = f"conv_id {kind}, block long, at int, turn long, role string, action string, rendered string"
    arrow_out = _arrow(turns, out_schema)
    names = ["_conv", "_block", "_turn", "_role", "_text", "entry", "leave", "last"]

    def pieces(batches):
        found = []
        for block in _blocks(batches, names):
            entry, leave, last = block[0][5:] if block[0][5] is not None else (START, None, True)
            parts = _pieces([r[3] for r in block], [r[4] for r in block], entry, leave, last)
            for at, part in enumerate(parts):
                nth = part.pop("nth")
                found.append({
                    "conv_id": block[0][0], "block": block[0][1], "at": at,
                    "turn": None if nth is None else block[nth][2], **part,
                })
            if len(found) >= BLOCK:
                yield pa.RecordBatch.from_pylist(found, arrow_out)
                found = []
        if found:
            yield pa.RecordBatch.from_pylist(found, arrow_out)

    return _sorted(placed).mapInArrow(pieces, out_schema)


def _placed(turn_rows: DataFrame, kind: str) -> DataFrame:
    """The turns with their place in the conversation and the block of 1,024 places it is in."""
    order = [
        F.col("_conv"), F.col("_given").asc_nulls_last(), F.col("_role"), F.col("_text"), F.col("_tie"),
    ]
    dealt = turn_rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_given", "_tie")
    counted = stored(
        dealt.mapInArrow(
            _count, f"_conv {kind}, _turn long, _role string, _text string, _part int, _local long"
        ),
        "chat_counted",
    )
    # Only a conversation that goes over the end of a range has several parts.
    parts = counted.groupBy("_conv", "_part").agg((F.max("_local") + 1).alias("n"))
    own = Window.partitionBy("_conv")
    before = F.sum("n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        F.col("_conv").alias("_of"), F.col("_part").alias("_in"), before.alias("_before")
    ).filter("_before is not null")
    same = F.col("_conv").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in"))
    # At most one for each range.
    place = F.col("_local") + F.coalesce("_before", F.lit(0))
    return counted.join(F.broadcast(stored(parts, "chat_parts")), same, "left").select(
        "_conv", F.floor(place / BLOCK).cast("long").alias("_block"), place.alias("_place"),
        "_turn", "_role", "_text",
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the turns of each conversation in this range, from sorted rows."""
    part, known, at = TaskContext.get().partitionId(), None, -1
    for batch in batches:
        local = []
        for conv in batch.column("_conv").to_pylist():
            at = at + 1 if (conv,) == known else 0
            known = (conv,)
            local.append(at)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(local), pa.int32()), pa.array(local, pa.int64())],
            names=[*batch.schema.names, "_part", "_local"],
        )


def _sorted(rows: DataFrame) -> DataFrame:
    """The rows of a block in one task, in order of their turns."""
    return rows.repartition(F.col("_conv"), F.col("_block")).sortWithinPartitions(
        "_conv", "_block", "_place"
    )


def _arrow(df: DataFrame, schema: str) -> pa.Schema:
    return to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
