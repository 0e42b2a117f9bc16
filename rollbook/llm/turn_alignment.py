"""Conversation structure repair: turns aligned to the alternating string of legal roles.

A legal conversation is empty, or user and assistant in turn from a user to an assistant, with one
system turn before them or without. For each feasible length that is one string of letters, and the
cheapest edits that turn a conversation into it are its alignment to that string, by Wagner and
Fischer. Strings that end alike share their last letters, so one table, filled from the end, serves
every length. A legal string costs something at once: turning each row into the letter at its
place, or deleting all. That incumbent bounds Ukkonen's band, as a cell n columns off the diagonal
costs 3 n or 4 n; a narrow band comes first, and what it finds is the next incumbent. Of all
lengths that cost the least the backtraced audits are compared, and the least in ASCII order stays.

Rows that have to go take no part in a table. Long conversations are cut by place into blocks. A
block's costs from each role to each role tell, from the last block to the first, what is still to
pay behind each block, and then, from the first to the last, with which role each begins.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .store import stored
from .words import SPACED_WORD

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: What may be reached at the end of a conversation, at no further cost.
END = (0.0, math.inf, math.inf, 0.0)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Cost that the first band allows for.
FIRST_BAND = 12
#: Turns that are aligned together, and alignments that a task remembers.
BLOCK = 256
REMEMBERED = 1 << 16
LOTS = 16
SPACE = " \t\n\x0b\x0c\r"

#: Row codes: s, u, a or o (any other role), in capitals when truncated; x has to be deleted.
FORCED = "x"


def _letter(state: int) -> str:
    return "?sua"[state]


def _other(letter: str) -> str:
    return "u" if letter == "a" else "a"


def _extra(code: str) -> int:
    return TRUNCATED if code.isupper() else 0


class Aligner:
    """Alignments of rows of codes, which it remembers, as most conversations look alike."""

    def __init__(self):
        self._found: dict[tuple, tuple[float, str, int]] = {}

    def best(self, codes: str, entry: int = START, ahead: tuple = END) -> tuple[float, str, int]:
        """Least cost, its least audit and the state after it, from ``entry`` on.

        ``ahead`` says what is still to pay behind each state; inf for states that cannot be left.
        """
        key = codes, entry, ahead
        if key not in self._found:
            if len(self._found) >= REMEMBERED:
                self._found.clear()
            rows = codes.replace(FORCED, "")
            cost, audit, leave = _aligned(rows, entry, ahead)
            cost += DELETE * (len(codes) - len(rows))
            self._found[key] = cost, _with_forced(codes, audit), leave
        return self._found[key]

    def costs(self, codes: str) -> list[float]:
        """Least cost from each state to each state, row by row."""
        none = (math.inf,) * STATES
        return [
            self.best(codes, entry, (*none[:leave], 0.0, *none[leave + 1 :]))[0]
            for entry in range(STATES) for leave in range(STATES)
        ]


def _with_forced(codes: str, audit: str) -> str:
    """The audit of the other rows with D for those that have to go, before any insertion."""
    found, at = [], 0
    for edit in ["", *audit]:
        found.append(edit)
        at += edit not in ("", "I")
        while at < len(codes) and codes[at] == FORCED:
            found.append("D")
            at += 1
    return "".join(found)


def _table(rows: str, last: str, width: float) -> list[dict[int, int]]:
    """``[r][k]``: cost of making the last r rows the last k letters, the last of all ``last``.

    Only cells that may lie on a way of ``width`` or less are filled.
    """
    down, right = int(width // DELETE), int(width // INSERT)
    table = [{k: INSERT * k for k in range(right + 1)}]
    for r in range(1, len(rows) + 1):
        code, above, row = rows[-r], table[-1], {}
        extra, role = _extra(code), code.lower()
        for k in range(max(0, r - down), r + right + 1):
            cost = above.get(k, math.inf) + DELETE
            if k:
                letter = last if k % 2 else _other(last)
                same = above.get(k - 1, math.inf) + extra + (role != letter) * REROLE
                cost = min(cost, same, row.get(k - 1, math.inf) + INSERT)
            row[k] = cost
        table.append(row)
    return table


def _trace(rows: str, last: str, table: list[dict[int, int]], r: int, k: int) -> str:
    """The least audit of the cheapest ways from a cell; edits are tried in ASCII order."""
    audit = []
    while r or k:
        cost = table[r][k]
        if r and table[r - 1].get(k, math.inf) + DELETE == cost:
            audit.append("D")
            r -= 1
        elif k and table[r].get(k - 1, math.inf) + INSERT == cost:
            audit.append("I")
            k -= 1
        else:
            letter = last if k % 2 else _other(last)
            audit.append("K" if rows[len(rows) - r].lower() == letter else "R")
            r, k = r - 1, k - 1
    return "".join(audit)


def _first_letter(entry: int) -> str:
    return "a" if entry == USER else "u"


def _fits(entry: int, last: str, k: int) -> bool:
    """Whether k alternating letters may follow ``entry`` and end with ``last``."""
    if not k:
        return _letter(entry) == last
    return (last if k % 2 else _other(last)) == _first_letter(entry)


def _incumbent(rows: str, entry: int, ahead: tuple) -> float:
    """Cost of a way that needs no table: all rows as they stand by place, or none of them."""
    found = [DELETE * len(rows) + ahead[entry]]
    for leave in (USER, ASSISTANT):
        last = _letter(leave)
        for k in (len(rows), len(rows) + 1):
            if k and _fits(entry, last, k):
                # A letter too many is inserted at the end.
                letters = [last if (k - n) % 2 else _other(last) for n in range(len(rows))]
                cost = sum(_extra(c) + (c.lower() != x) * REROLE for c, x in zip(rows, letters))
                found.append(cost + INSERT * (k - len(rows)) + ahead[leave])
        short = next(k for k in (1, 2) if _fits(entry, last, k))
        found.append(DELETE * len(rows) + INSERT * short + ahead[leave])
    return min(found)


def _aligned(rows: str, entry: int, ahead: tuple) -> tuple[float, str, int]:
    systems = [n for n, code in enumerate(rows) if code in "sS"] if entry == START else []
    plain = [(DELETE * len(rows) + ahead[entry], "D" * len(rows), entry)]
    for n in systems:
        way = "D" * n + "K" + "D" * (len(rows) - n - 1)
        plain.append((DELETE * (len(rows) - 1) + _extra(rows[n]) + ahead[SYSTEM], way, SYSTEM))
    least = min(ahead)
    if least == math.inf:
        return math.inf, "", entry
    limit = min(_incumbent(rows, entry, ahead), min(plain)[0])
    if limit == math.inf:  # the one state that can be left lies before this block's
        return math.inf, "", entry
    width = min(limit - least, FIRST_BAND)
    while True:
        tables = {
            leave: _table(rows, _letter(leave), width)
            for leave in (USER, ASSISTANT) if ahead[leave] < math.inf
        }
        goals = []
        for leave, table in tables.items():
            last = _letter(leave)
            # Each feasible length, with all rows or behind a system turn that is kept.
            starts = [(entry, -1, 0)] + [(SYSTEM, n, DELETE * n + _extra(rows[n])) for n in systems]
            for state, at, spent in starts:
                r = len(rows) - at - 1
                for k, cost in table[r].items():
                    if _fits(state, last, k):
                        goals.append((spent + cost + ahead[leave], leave, at, r, k))
        best = min([cost for cost, *_ in goals] + [cost for cost, *_ in plain])
        if best - least <= width or width >= limit - least:
            break
        limit = min(limit, best)
        width = limit - least
    found = [(way, leave) for cost, way, leave in plain if cost == best]
    for cost, leave, at, r, k in goals:
        if cost == best:
            head = "D" * at + "K" if at >= 0 else ""
            found.append((head + _trace(rows, _letter(leave), tables[leave], r, k), leave))
    return best, *min(found)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
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


_TURN = "_turn long, _role string, _text string, _fault string, _code string"


def _placed(rows: DataFrame, kind: str) -> DataFrame:
    """The turns with their place in the conversation and the block that it lies in."""
    order = [F.col(name) for name in ("_conv", "_turn", "_role", "_text", "_tie")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    counted = stored(
        dealt.mapInArrow(_numbered, f"_conv {kind}, {_TURN}, _part int, _local long"), "align_turns"
    )
    # Only a conversation that goes over the end of a range has several parts; there are at
    # most as many such parts as ranges.
    parts = counted.groupBy("_conv", "_part").agg((F.max("_local") + 1).alias("n"))
    before = F.sum("n").over(
        Window.partitionBy("_conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = parts.select(
        F.col("_conv").alias("_of"), F.col("_part").alias("_in"), before.alias("_before")
    ).filter("_before is not null")
    same = F.col("_conv").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in"))
    place = F.col("_local") + F.coalesce("_before", F.lit(0))
    return counted.join(F.broadcast(stored(parts, "align_parts")), same, "left").select(
        "_conv", F.floor(place / BLOCK).cast("long").alias("_block"), place.alias("_place"),
        *[field.split()[0] for field in _TURN.split(", ")],
    )


def _repeats(rows: DataFrame) -> DataFrame:
    """``_conv, _block, _place`` of turns whose role and text the conversation has had before.

    The first place of each is found by adding up, and only of those that recur it is joined
    with the rows, dealt to lots, as a conversation may hold one text very often.
    """
    turns = rows.select(
        "_conv", "_block", "_place", F.struct("_role").alias("_role"), F.sha2("_text", 256).alias("_digest")
    )
    firsts = (
        turns.groupBy("_conv", "_role", "_digest")
        .agg(F.min("_place").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
        .select(
            F.col("_conv").alias("_of"), F.col("_role").alias("_their_role"),
            F.col("_digest").alias("_their_digest"), "_first",
            F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1))).alias("_lot"),
        )
    )
    met = turns.join(
        firsts,
        F.col("_conv").eqNullSafe(F.col("_of")) & F.col("_role").eqNullSafe(F.col("_their_role"))
        & (F.col("_digest") == F.col("_their_digest")) & (F.pmod("_place", F.lit(LOTS)) == F.col("_lot")),
    )
    return met.filter("_place > _first").select("_conv", "_block", "_place")


_MARKED = ["_conv", "_block", "_place", "_rank"]


def _with_marks(rows: DataFrame, repeats: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one block next to each other, each repeat told by a row just before it."""
    marks = repeats.select("*", F.lit(0).alias("_rank"))
    return rows.select("_conv", "_block", "_place", F.lit(1).alias("_rank"), *columns).unionByName(
        marks, allowMissingColumns=True
    )


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(F.col("_conv"), F.col("_block")).sortWithinPartitions(*_MARKED)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The turns of a block, repeats among them marked; a row of rank -1 belongs to the block."""
    block: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if block and (row["_conv"], row["_block"]) != (block[0]["_conv"], block[0]["_block"]):
                yield block
                block = []
            if block and block[-1]["_rank"] == 0 and row["_rank"] == 1:
                block.pop()
                row["_code"] = FORCED
                row["_fault"] = row.get("_fault") if row.get("_fault") == "blank" else "duplicate"
            block.append(row)
    if block:
        yield block


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(df: DataFrame, schema: str) -> pa.Schema:
    return to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)


def _streamed(rows: DataFrame, make, schema: str) -> DataFrame:
    """``make`` turns an iterator of batches into one of rows of ``schema``."""
    arrow = _arrow(rows, schema)
    return rows.mapInArrow(lambda batches: _batches(make(batches), arrow), schema)


def _between_blocks(rows: DataFrame, repeats: DataFrame, kind: str) -> DataFrame:
    """``_conv, _block, entry, ahead`` for the blocks of conversations that have several.

    Each pass holds one block, or the four numbers of one state, however long a conversation.
    """
    long_ones = stored(
        rows.groupBy(F.col("_conv").alias("_of")).agg(F.max("_block").alias("_final"))
        .filter("_final > 0").select("_of"),
        "align_long",
    )
    same = F.col("_conv").eqNullSafe(F.col("_of"))
    slim = _with_marks(
        rows.select("_conv", "_block", "_place", "_code").join(long_ones, same, "left_semi"),
        repeats.join(long_ones, same, "left_semi"), ["_code"],
    )

    def costs(batches):
        aligner = Aligner()
        for block in _blocks(batches):
            codes = "".join(row["_code"] for row in block)
            yield {"_conv": block[0]["_conv"], "_block": block[0]["_block"], "codes": codes,
                   "costs": aligner.costs(codes)}

    matrices = stored(
        _streamed(_in_blocks(slim), costs, f"_conv {kind}, _block long, codes string, costs array<double>"),
        "align_costs",
    )

    def backward(batches):
        conv, ahead = None, END
        for batch in batches:
            for row in batch.to_pylist():
                if (row["_conv"],) != conv:
                    conv, ahead = (row["_conv"],), END
                yield {"_conv": row["_conv"], "_block": row["_block"], "codes": row["codes"], "ahead": list(ahead)}
                ahead = tuple(
                    min(row["costs"][entry * STATES + leave] + ahead[leave] for leave in range(STATES))
                    for entry in range(STATES)
                )

    behind = matrices.repartition("_conv").sortWithinPartitions("_conv", F.desc("_block"))
    behind = _streamed(behind, backward, f"_conv {kind}, _block long, codes string, ahead array<double>")

    def leaving(batches):
        aligner = Aligner()
        for batch in batches:
            for row in batch.to_pylist():
                ahead = tuple(row["ahead"])
                leaves = [aligner.best(row["codes"], entry, ahead)[2] for entry in range(STATES)]
                yield {"_conv": row["_conv"], "_block": row["_block"], "ahead": row["ahead"], "leaves": leaves}

    # A conversation's blocks are dealt out again for the work that is much.
    ways = _streamed(
        behind.repartition(F.col("_conv"), F.col("_block")), leaving,
        f"_conv {kind}, _block long, ahead array<double>, leaves array<int>",
    )

    def forward(batches):
        conv, entry = None, START
        for batch in batches:
            for row in batch.to_pylist():
                if (row["_conv"],) != conv:
                    conv, entry = (row["_conv"],), START
                yield {"_conv": row["_conv"], "_block": row["_block"], "entry": entry, "ahead": row["ahead"]}
                entry = row["leaves"][entry]

    ways = ways.repartition("_conv").sortWithinPartitions("_conv", "_block")
    return stored(
        _streamed(ways, forward, f"_conv {kind}, _block long, entry int, ahead array<double>"), "align_between"
    )


def fault(role: Column, text: Column) -> tuple[Column, Column]:
    """What is wrong with a turn by itself, ``blank`` or ``truncated`` or null, and its row code."""
    text = F.coalesce(text, F.lit(""))
    blank = ~text.rlike(SPACED_WORD)
    whole = F.substring(F.rtrim(text, F.lit(SPACE)), -1, 1).isin(".", "!", "?")
    initial = F.substring(role, 1, 1)
    code = F.when(F.coalesce(initial.isin("s", "u", "a"), F.lit(False)), initial).otherwise("o")
    wrong = F.when(blank, "blank").when(~whole, "truncated")
    return wrong, F.when(blank, FORCED).when(~whole, F.upper(code)).otherwise(code)


def repair(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The cheapest edits that make every conversation legal, a row for each.

    Keep (K) costs nothing; Rerole (R) to user or assistant 3; Delete (D) 4, which blank turns and
    repeats of an earlier role and text must be; Insert (I) of an empty user or assistant turn 3;
    a truncated turn, one that does not end with ``.``, ``!`` or ``?``, costs 3 more unless it is
    deleted. Of equally cheap repairs the one whose letters come first in ASCII order is taken.

    Returns ``conv_id, block, at`` (an edit's place), ``edit``, ``turn`` (null where inserted),
    ``from_role``, ``role`` and ``text`` after the edit, ``fault`` (blank, duplicate, truncated or
    null). The edits other than D, in order, are the repaired conversation.

    Turns are in order of their number, null first, then role and text. Null ids are one
    conversation; null texts are blank, and a null or unknown role is none of the three, as
    tells its first letter. Equal rows are repeats. An empty table gives no rows; other columns
    are not read. A conversation is cut by place into blocks of 256 turns, so that no task holds
    more of one, whatever its length.
    """
    wrong, code = fault(F.col(f"`{role}`"), F.col(f"`{text}`"))
    given = turns.select(
        F.col(f"`{conv_id}`").alias("_conv"), F.col(f"`{turn}`").cast("long").alias("_turn"),
        F.col(f"`{role}`").alias("_role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
        wrong.alias("_fault"), code.alias("_code"), F.monotonically_increasing_id().alias("_tie"),
    )
    kind = given.schema["_conv"].dataType.simpleString()
    rows = _placed(given, kind)
    repeats = stored(_repeats(rows), "align_repeats")
    between = _between_blocks(rows, repeats, kind)
    columns = [field.split()[0] for field in _TURN.split(", ")]
    marked = _with_marks(rows, repeats, columns).unionByName(
        between.select("*", F.lit(-1).cast("long").alias("_place"), F.lit(-1).alias("_rank")),
        allowMissingColumns=True,
    )

    def edits(batches):
        aligner = Aligner()
        for block in _blocks(batches):
            entry, ahead = START, END
            if block[0]["_rank"] == -1:
                entry, ahead = block[0]["entry"], tuple(block[0]["ahead"])
                block = block[1:]
            _, audit, _ = aligner.best("".join(row["_code"] for row in block), entry, ahead)
            yield from _edits(block, audit, entry)

    return _streamed(
        _in_blocks(marked), edits,
        f"conv_id {kind}, block long, at int, edit string, turn long, from_role string, role string, "
        "text string, fault string",
    )


def _edits(block: list[dict], audit: str, state: int) -> Iterator[dict]:
    rows = iter(block)
    for at, edit in enumerate(audit):
        row = next(rows) if edit != "I" else {}
        role = row.get("_role")
        if edit == "K":
            state = " sua".index(role[0])
        elif edit != "D":
            state = ASSISTANT if state == USER else USER
            role = "assistant" if state == ASSISTANT else "user"
        yield {
            "conv_id": block[0]["_conv"], "block": block[0]["_block"], "at": at, "edit": edit,
            "turn": row.get("_turn"), "from_role": row.get("_role"), "role": role,
            "text": row.get("_text", ""), "fault": row.get("_fault"),
        }


def _summary(conv, rows: Iterator[dict]) -> dict:
    """What the query tells of a conversation, from its edits in order, one at a time."""
    found = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    audit, digest, first, last, turns, before = [], hashlib.sha256(), None, None, 0, None
    whole = False
    for row in rows:
        edit = row["edit"]
        audit.append(edit)
        found["cost"] += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "D":
            found["cost"] += TRUNCATED if row["fault"] == "truncated" else 0
            digest.update(f"{chr(10) if whole else ''}{row['role'] or ''}:{row['text']}".encode("utf-8", "replace"))
            whole = True
        if edit != "I":
            if row["fault"]:
                found[row["fault"]] += 1
            initial = (row["from_role"] or "")[:1]
            found["illegal"] += before is not None and before + initial not in ("su", "ua", "au")
            before = initial
            if row["turn"] is not None and row["turn"] != last:
                first, last, turns = row["turn"] if first is None else first, row["turn"], turns + 1
    if turns:
        found["gaps"] = last - first + 1 - turns
    return {"conv_id": conv, **found, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each conversation with an iterator over its rows, from sorted rows, none of them kept."""
    rows = (row for batch in batches for row in batch.to_pylist())
    ahead = next(rows, None)

    def of(conv):
        nonlocal ahead
        while ahead is not None and ahead["conv_id"] == conv:
            yield ahead
            ahead = next(rows, None)

    while ahead is not None:
        conv = ahead["conv_id"]
        own = of(conv)
        yield conv, own
        for _ in own:  # what the caller has left
            pass


def summaries(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``edits``: counts of faults, cost, audit and a digest.

    ``gaps`` are turn numbers missing between the least and the greatest; ``illegal`` are
    neighbours before the repair whose roles do not follow each other; ``repaired_sha256`` is of
    ``role:text`` of the repaired turns, joined by line breaks. As a digest of a whole
    conversation has to be taken in order, a conversation's edits pass through one task; it
    holds one batch of them and the audit.
    """
    kind = edits.schema["conv_id"].dataType.simpleString()
    dealt = edits.repartition("conv_id").sortWithinPartitions("conv_id", "block", "at")
    return _streamed(
        dealt, lambda batches: (_summary(conv, rows) for conv, rows in _groups(batches)),
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
        "cost long, audit string, repaired_sha256 string",
    )
