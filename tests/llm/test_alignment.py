from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import odd_docs, tuples
from tokenizers import Tokenizer

from rollbook.llm import alignment, queries
from rollbook.llm.alignment import ByteTokens, PieceTokens, diagonals, overlaps, words_of

ODD = [
    "a", " ", "  two  spaces ", "tab\tand\nline\r\n\r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "▁low",
    "é à ü ß 中文 混合 text 👩‍👩‍👧 ok", "it's we'll I'd 'S", "x" * 3000, "1234567890" * 30, "\x00\x1c\x85᠎ end",
    "é ﬁ  　 wide", " lead", "trail ", "﻿mark", "a▁b ▁▁ c",
]


@pytest.fixture(scope="module")
def tokens():
    return ByteTokens(alignment.BYTE_BPE), PieceTokens(alignment.PIECE_BPE)


@pytest.fixture(scope="module")
def plain_a():
    made = Tokenizer.from_file(alignment.BYTE_BPE)
    made.encode_special_tokens = True
    return lambda text: made.encode(" " + text, add_special_tokens=False).ids


def _plain(text, tokens, plain_a):
    """Ids, groups and overlapping pairs by looking at every pair of tokens around a byte."""
    whole = (" " + text).encode() if text else b""
    sides = []
    for ids, side in ((plain_a(text) if text else [], tokens[0]), (tokens[1]._pieces.encode(text or ""), tokens[1])):
        parts = [side.bytes[n] for n in ids]
        if b"".join(parts) != whole or not text:
            return [], [], [], []
        at, ranges = 0, []
        for n, part in zip(ids, parts):
            ranges.append((at, at + len(part), n))
            at += len(part)
        sides.append(ranges)
    a, b = sides
    links = [(x, y) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
    shared = sorted({x[1] for x in a} & {y[1] for y in b})
    groups, start = [], 0
    for end in shared:
        groups.append(tuple(",".join(str(t[2]) for t in side if start <= t[0] < end) for side in (a, b)))
        start = end
    return [x[2] for x in a], [y[2] for y in b], groups, [(x[2], y[2]) for x, y in links]


def _texts(seed, count=30):
    chance = random.Random(seed)
    words = ["the", "Straße", "naïve", "don't", "42", "中", "—", "foo_bar", "ing", "Ω"]
    made = ["".join(chance.choice(words) + chance.choice([" ", "  ", "\n", "", ", "]) for _ in range(chance.randrange(1, 60)))
            for _ in range(count)]
    return ODD + made + made[:3]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 4096])
def test_pieces_give_the_same_overlaps(piece):
    chance = np.random.default_rng(3)
    for _ in range(60):
        total = int(chance.integers(1, 40))
        a, b = (np.append(np.sort(chance.choice(np.arange(1, total), int(chance.integers(0, total)), False))
                          if total > 1 else np.empty(0, np.int64), total).astype(np.int64) for _ in range(2))
        links, stops = overlaps(a, b, piece)
        starts = np.append(0, a[:-1]), np.append(0, b[:-1])
        plain = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]]
        assert sorted(zip(*map(list, links))) == plain
        shared = [int(e) for e in a if e in b]
        assert [(a[x - 1], b[y - 1]) for x, y in zip(*stops)] == [(e, e) for e in shared]
        i, j = diagonals(a, b, piece)
        assert all(np.diff(i + j)[:-1] == piece) and i[-1] == len(a) and j[-1] == len(b)


def test_tokens_are_those_of_the_files(tokens, plain_a, monkeypatch):
    texts = _texts(1) + [" ".join(_texts(2)), "\u2581 a \u2581b c\u2581 d", "a \x85 b\x1c c \u3000d \u200b e"]
    for remembered, chunk in ((1 << 17, 1 << 15), (3, 20)):
        monkeypatch.setattr(alignment, "REMEMBERED", remembered)
        monkeypatch.setattr(alignment, "CHUNK", chunk)
        for text, found in zip(texts, tokens[1].ids([words_of(text) for text in texts])):
            assert tokens[0].ids(text).tolist() == plain_a(text)
            if found is None:  # U+2581 is a space to this tokenizer
                assert "\u2581" in text
            else:
                assert found.tolist() == tokens[1]._pieces.encode(text)
    for text in (" ".join(f"w{n}" for n in range(40_000)), "x" * 100_000):
        assert tokens[0].ids(text).tolist() == plain_a(text)


def _expected(rows, tokens, plain_a):
    found = [(doc, *_plain(text or "", tokens, plain_a)) for doc, text in rows]
    counts = Counter(pair for *_, links in found for pair in set(links))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    return sorted((
        (doc, len(a), len(b), len(groups),
         hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if groups else "",
         len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links))
        for doc, a, b, groups, links in found
    ), key=repr)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]


@pytest.mark.parametrize("broadcast_bytes", [0, 32 << 20])
def test_against_brute_force(spark, tokens, plain_a, broadcast_bytes):
    rows = list(enumerate(_texts(5))) + [(None, "null id"), (None, None), (3, ""), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = alignment.stored(alignment.digests(docs), "test_align")
    got = alignment.link_totals(made, alignment.pair_counts(made), broadcast_bytes=broadcast_bytes)
    assert tuples(got.select(NAMES)) == _expected(rows, tokens, plain_a)


def test_query_against_brute_force(spark, tokens, plain_a):
    sf_dir = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    short = [r for r in rows if len(r[1] or "") < 1500]
    got = queries.op11_tokenizer_alignment(spark, sf_dir)
    by_id = {r.doc_id: r for r in got.collect()}
    assert len(by_id) == len(rows) == got.count()
    for doc, text in short[:60]:
        a, b, groups, links = _plain(text, tokens, plain_a)
        assert (by_id[doc].n_a, by_id[doc].n_b, by_id[doc].n_groups, by_id[doc].n_links) == (
            len(a), len(b), len(groups), len(links))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    found = alignment.align(docs)
    assert found.count() == docs.count() and alignment.align(docs.limit(0)).isEmpty()
    for row in found.collect():
        assert len(row.a_stops) == len(row.b_stops)
        assert (row.a_stops or [0])[-1] == len(row.a_ids) and (row.b_stops or [0])[-1] == len(row.b_ids)
        assert sum(row.links) == len(row.a_ids) + len(row.b_ids) - len(row.a_stops)
    none = [r for r in found.collect() if r.doc_id in (2, 3)]
    assert len(none) == 2 and all(not r.a_ids and not r.pairs for r in none)
    empty = alignment.stored(alignment.digests(docs.limit(0)), "test_align_empty")
    assert alignment.link_totals(empty, alignment.pair_counts(empty)).isEmpty()
