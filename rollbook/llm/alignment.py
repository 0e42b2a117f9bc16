"""Cross-tokenizer alignment: the tokens of two tokenizers put together by their byte ends.

Merge path. The ends of a text's A tokens and B tokens are two sorted lists. Merging them is cut
into pieces of equal work: piece p starts on diagonal d = p * PIECE of the grid of both lists, and
a binary search along the diagonal finds the i ends of A and d - i of B that lie before it. Pieces
are merged independently. What lies between neighbouring different ends is inside exactly one A
token and one B token, so every different end stands for one overlapping pair, and an end that
both lists have closes a group. Only an end whose two copies fall into two neighbouring pieces has
to be stitched: the later piece's first overlap is the earlier one's last, and the group closes.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Ends of both lists that a piece merges.
PIECE = 4096
#: Characters that the byte-level tokenizer gets at once, to the end of a word.
CHUNK = 1 << 15
#: Words that a task remembers the pieces of, and characters of the longest such word.
REMEMBERED, LONGEST = 1 << 17, 64
#: Rows that a task holds between reading and handing on.
ROWS = 64
#: Pair counts are broadcast when measured at this many bytes or less, and otherwise shuffled.
BROADCAST_BYTES = 32 << 20
#: Bytes of one pair count in a broadcast table.
COUNT_BYTES = 40
#: Lots that the documents of a pair are dealt to in a shuffle.
LOTS = 64

# Fixed value: the pattern by which the byte-level tokenizer cuts a text into words.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Either tokenizer starts anew at a space between characters that are no white space, where U+2581
# counts as some: words are cut there, and no piece has a space behind anything else.
_CUT = re.compile(r"(?<=[^\s\u2581]) (?=[^\s\u2581])")


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible characters of Latin-1 stand for themselves, the other bytes in order for the
    characters from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(others)}


def words_of(text: str) -> list[str]:
    """``text`` cut at the spaces where both tokenizers start anew, which go."""
    return _CUT.split(text) if text else []


class ByteTokens:
    """Ids of the byte-level tokenizer (A); special tokens are ordinary text.

    Its tokens are slices of the bytes, so they always make up the text again.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {token["content"] for token in described["added_tokens"]}
        byte_of = _byte_level()
        ranks = {
            bytes(byte_of[c] for c in token): n
            for token, n in described["model"]["vocab"].items() if token not in special
        }
        # Merges are in the order of their ids, so the ids are ranks.
        self._encoding = tiktoken.Encoding(
            "byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}
        )
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, n in ranks.items():
            self.bytes[n] = token
        self._lengths = np.array(list(map(len, self.bytes)), np.int64)

    def ids(self, text: str) -> np.ndarray:
        """Of a space and the text, which is encoded in parts, so that memory stays bounded."""
        if not text:
            return np.empty(0, np.int32)
        text, parts, start = " " + text, [], 0
        while cut := _CUT.search(text, start + CHUNK):
            parts += self._encoding.encode_ordinary(text[start : cut.start()])
            start = cut.start()
        return np.array(parts + self._encoding.encode_ordinary(text[start:]), np.int32)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """The byte after each token."""
        return self._lengths[ids].cumsum()


class PieceTokens:
    """Ids of the piece tokenizer (B), which puts a space before a text itself.

    A text is put together from its words, whose ids are remembered.
    """

    def __init__(self, path: str):
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if self._pieces.is_byte(n)
            else piece.replace("▁", " ").encode("utf-8")
            for n, piece in enumerate(map(self._pieces.id_to_piece, range(self._pieces.get_piece_size())))
        ]
        self._lengths = np.array(list(map(len, self.bytes)), np.int64)
        self._known: dict[str, array | None] = {}

    def ids(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        """Of each text, given as words; None where the tokens' bytes are not the text's again."""
        new = {word for words in texts for word in words if word not in self._known}
        if len(self._known) + len(new) > REMEMBERED:
            self._known.clear()
            new = {word for words in texts for word in words}
        now = dict(zip(new, self._pieces.encode(list(new), num_threads=1)))
        table = self.bytes.__getitem__
        for word, ids in now.items():
            whole = b"".join(map(table, ids)) == (" " + word).encode("utf-8")
            self._known[word] = array("i", ids) if whole else None
        found = []
        for words in texts:
            parts = list(map(self._known.__getitem__, words))
            if None in parts:
                found.append(None)
                continue
            ids = array("i")
            for part in parts:
                ids.extend(part)
            found.append(np.frombuffer(ids, np.int32) if parts else np.empty(0, np.int32))
        for word in now:
            if len(word) > LONGEST:
                del self._known[word]
        return found

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return self._lengths[ids].cumsum()


def diagonals(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of either list lie before each piece and after the last one.

    All binary searches go on together. Of equal ends the one of ``a`` comes first.
    """
    both = len(a) + len(b)
    d = np.append(np.arange(0, both, piece), both)
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (unsettled := low < high).any():
        middle = (low + high) // 2
        at = np.where(unsettled, middle, 0)
        more = unsettled & (a[at] <= b[np.where(unsettled, d - at - 1, 0)])
        low = np.where(more, middle + 1, low)
        high = np.where(unsettled & ~more, middle, high)
    return low, d - low


def _merged(a: np.ndarray, b: np.ndarray, i: tuple[int, int], j: tuple[int, int]):
    """A piece: its first and last end, its overlaps, and where in it groups close."""
    ends = np.concatenate([a[i[0] : i[1]], b[j[0] : j[1]]])
    order = np.argsort(ends, kind="stable")
    ends, own = ends[order], order < i[1] - i[0]
    done_a, done_b = i[0] + np.cumsum(own), j[0] + np.cumsum(~own)
    again = np.append(False, ends[1:] == ends[:-1])
    first = ~again
    overlaps = (done_a - own)[first], (done_b - ~own)[first]
    return ends[0], ends[-1], overlaps, (done_a[again], done_b[again])


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE):
    """Of two sorted lists of ends the overlapping pairs and the groups.

    Returns numbers of the A and B tokens of each pair, and for each group how many tokens of
    either side lie before its end. Both lists end alike; empty ones have neither.
    """
    if not len(a):
        none = np.empty(0, np.int64)
        return (none, none), (none, none)
    i, j = diagonals(a, b, piece)
    links, stops, last = ([], []), ([], []), None
    for n in range(len(i) - 1):
        head, tail, pairs, closed = _merged(a, b, (i[n], i[n + 1]), (j[n], j[n + 1]))
        if head == last:  # this end's other copy closed the piece before
            pairs = pairs[0][1:], pairs[1][1:]
            closed = np.append(i[n], closed[0]), np.append(j[n] + 1, closed[1])
        for side in (0, 1):
            links[side].append(pairs[side])
            stops[side].append(closed[side])
        last = tail
    return tuple(map(np.concatenate, links)), tuple(map(np.concatenate, stops))


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([np.empty(0, np.int64), *arrays])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values).cast(kind))


_LISTS = {"a_ids": "int", "b_ids": "int", "a_stops": "int", "b_stops": "int", "pairs": "long", "links": "int"}


def _align(byte_bpe: str, piece_bpe: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(byte_bpe), PieceTokens(piece_bpe)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                found = {name: [] for name in _LISTS}
                texts = [value.as_py() or "" for value in batch.column("_text")]
                pieces = tokens[1].ids([words_of(text) for text in texts])
                for text, b_ids in zip(texts, pieces):
                    a_ids = tokens[0].ids(text if b_ids is not None else "")
                    b_ids = np.empty(0, np.int32) if b_ids is None else b_ids
                    a_ends, b_ends = tokens[0].ends(a_ids), tokens[1].ends(b_ids)
                    links, stops = overlaps(a_ends, b_ends)
                    pairs, often = np.unique(
                        a_ids[links[0]].astype(np.int64) << 32 | b_ids[links[1]], return_counts=True
                    )
                    for name, values in zip(_LISTS, (a_ids, b_ids, *stops, pairs, often)):
                        found[name].append(values)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), *(
                        _lists(found[name], pa.int64() if kind == "long" else pa.int32())
                        for name, kind in _LISTS.items()
                    )],
                    names=["doc_id", *_LISTS],
                )

    return align


def _plan(
    docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, doc_id: str = "doc_id", text: str = "text",
):
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return _align(byte_bpe, piece_bpe), docs.schema[doc_id].dataType.simpleString(), rows


def align(docs: DataFrame, **how) -> DataFrame:
    """The tokens of both tokenizers for every whole text, their groups and overlaps.

    Returns ``doc_id``; ``a_ids, b_ids`` of a space and the text; ``a_stops, b_stops``, for each
    group how many tokens of either side lie before its end; ``pairs``, the different id pairs
    (A's id times 2**32 plus B's) of tokens whose byte ranges overlap, in order; and ``links``,
    how often each overlaps. ``byte_bpe`` and ``piece_bpe`` name the tokenizers' files, which
    every executor can open; ``doc_id`` and ``text`` name columns.

    Null and empty texts, and those whose tokens' bytes are not the space and text again, have
    empty lists. A row is returned for each row, whatever its id; other columns are not read.
    """
    make, kind, rows = _plan(docs, **how)
    lists = ", ".join(f"{name} array<{of}>" for name, of in _LISTS.items())
    return rows.mapInArrow(make, f"doc_id {kind}, {lists}")


def _written(ids: int) -> np.ndarray:
    """Every id as text after each of the four marks that may come before it."""
    return np.array([f"{mark}{n}".encode() for mark in ("", ",", ";", "|") for n in range(ids)], object)


def _group_bytes(lists: list[np.ndarray], written: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: ids of each group."""
    a_ids, b_ids, a_stops, b_stops = (x.astype(np.int64) for x in lists)
    ids = len(written) // 4
    before_a, before_b = np.append(0, a_stops[:-1]), np.append(0, b_stops[:-1])
    where_a = np.arange(len(a_ids)) + np.repeat(before_b, a_stops - before_a)
    where_b = np.arange(len(b_ids)) + np.repeat(a_stops, b_stops - before_b)
    mark_a, mark_b = np.full(len(a_ids), ids), np.full(len(b_ids), ids)
    mark_a[before_a], mark_b[before_b] = 2 * ids, 3 * ids
    mark_a[0] = 0
    places = np.empty(len(a_ids) + len(b_ids), np.int64)
    places[where_a], places[where_b] = a_ids + mark_a, b_ids + mark_b
    return b"".join(written[places].tolist())


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    written = None
    for batch in batches:
        columns = []
        for name in ("a_ids", "b_ids", "a_stops", "b_stops"):
            column = batch.column(name)
            values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            columns.append([values[x:y] for x, y in zip(ends[:-1], ends[1:])])
            if name.endswith("_ids") and len(values) and (written is None or values.max() >= len(written) // 4):
                written = _written(1 << int(values.max()).bit_length())
        digests = [
            hashlib.sha256(_group_bytes(list(row), written)).hexdigest() if len(row[0]) else ""
            for row in zip(*columns)
        ]
        counts = [[len(value) for value in columns[n]] for n in (0, 1, 2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
             pa.array(digests, pa.string()), batch.column("pairs"), batch.column("links")],
            names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "links"],
        )


def digests(docs: DataFrame, **how) -> DataFrame:
    """:func:`align` with counts and a digest of the groups in place of the tokens.

    Returns ``_row`` (a number for each row), ``doc_id, n_a, n_b, n_groups, groups_sha256, pairs,
    links``; takes what :func:`align` takes. Tokens are turned into digests by the task that made
    them, so that they are never held by more than a few rows.
    """
    make, kind, rows = _plan(docs, **how)
    made = rows.mapInArrow(
        lambda batches: _digest(make(batches)),
        f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "pairs array<long>, links array<int>",
    )
    return made.withColumn("_row", F.monotonically_increasing_id())


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, documents, best``: rows that hold a pair, and whether no pair of its A id has more."""
    counted = stored(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents")),
        "align_counts",
    )
    most = counted.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("documents").alias("most"))
    of = F.shiftright(F.col("pair"), 32) == F.col("a")
    return counted.join(most, of).select(
        "pair", "documents", (F.col("documents") == F.col("most")).cast("int").alias("best")
    )


def link_totals(
    rows: DataFrame, counts: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``rows`` with ``n_links``, ``n_best`` and ``count_sum`` in place of pairs and links.

    ``rows`` has ``_row``, which tells rows apart, ``pairs`` and ``links``; ``counts`` is what
    :func:`pair_counts` returns. Counts that are measured at ``broadcast_bytes`` or less go to
    every task. Otherwise links and counts meet in a shuffle, in which the documents of a pair
    are dealt to 64 lots, as some pairs are in every document. The result is the same.
    """
    links = rows.select("_row", F.inline(F.arrays_zip("pairs", "links")))
    if counts.count() * COUNT_BYTES <= broadcast_bytes:
        met = links.join(F.broadcast(counts).withColumnRenamed("pair", "pairs"), "pairs")
    else:
        lots = F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1)))
        dealt = counts.withColumnRenamed("pair", "pairs").withColumn("lot", lots)
        lot = F.pmod(F.xxhash64("_row"), F.lit(LOTS)).cast("int")
        met = links.withColumn("lot", lot).join(dealt, ["pairs", "lot"])
    totals = met.groupBy(F.col("_row").alias("_of")).agg(
        F.sum(F.col("links").cast("long")).alias("n_links"),
        F.sum((F.col("links") * F.col("best")).cast("long")).alias("n_best"),
        F.sum(F.col("links") * F.col("documents")).alias("count_sum"),
    )
    added = ("n_links", "n_best", "count_sum")
    kept = [name for name in rows.columns if name not in ("_row", "pairs", "links")]
    return rows.drop("pairs", "links").join(totals, F.col("_row") == F.col("_of"), "left").select(
        *kept, *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in added]
    )
