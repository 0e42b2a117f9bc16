from __future__ import annotations

import math
import random
import re
from collections import Counter

from helpers import alnum, odd_docs, tuples

from rollbook.llm import membership
from rollbook.llm.pii import base_spans, find_pii, sanitise


def _luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0


def _plain(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_base_spans_against_the_patterns():
    chance = random.Random(2)
    parts = ["a@b.co", "@", ".", "-", "_", "%", "1", "255", "256", "0255", "4111111111111111", "4111 1111 1111 1111",
             "+1 (555) 555-0100", "+", " ", "é", "x", "10.0.0.1", "a.b+c@d-e.f.g", "\n", "３", "()"]
    for _ in range(4000):
        text = "".join(chance.choices(parts, k=chance.randrange(1, 14)))
        assert base_spans(text) == _plain(text), text


def test_long_runs_take_no_time():
    for text in ("a" * 300_000, "1" * 100_000, "1." * 50_000, "+1" * 50_000, "a@" * 50_000, "4" * 200_000 + "@"):
        base_spans(text)


def _plain_terms(rows, support=3, at=0.75):
    documents = {(doc, text or "") for doc, text in rows}
    beside, n_e, n_t = {}, Counter(), Counter()
    for doc, text in documents:
        n_t.update(set(alnum(text)))
        spans = base_spans(text)
        covered = {n for _, s, e in spans for n in range(s, e)}
        words = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
                 if not covered & set(range(*m.span()))]
        pairs = set()
        for kind, start, end in spans:
            entity = kind + ":" + text[start:end]
            before = [w for w in words if w[0] < start][-16:]
            after = [w for w in words if w[0] >= start][:16]
            for left, right in before + after:
                term = "".join(c.lower() if c.isascii() else c for c in text[left:right])
                beside.setdefault((entity, term), []).append((doc, text, left, right))
                pairs.add((entity, term))
        n_e.update({entity for entity, _ in pairs})
    found = {}
    for (entity, term), places in beside.items():
        together = len({place[:2] for place in places})
        total = len(rows)
        if together >= support and n_e[entity] < total:
            told = math.log2(together * total / (n_e[entity] * n_t[term])) / math.log2(total / n_e[entity])
            if told >= at:
                for doc, text, left, right in places:
                    found.setdefault((doc, text), set()).add((left, right, "remove" if told >= 0.9 else "generalise"))
    return found


def test_terms_against_brute_force(spark):
    chance = random.Random(4)
    common = [f"c{n}x" for n in range(20)]
    rows = []
    for n in range(160):
        words = chance.choices(common, k=30)
        if n % 8 == 0:
            words[10:10] = ["Mayor", "of", "Éville", "mail", "m@ville.org"]
        if n % 40 == 1:
            words[4:4] = ["mayor"]
        if n % 16 == 3:
            words[3:3] = ["call", "+1 555 555 0100", "plumber"]
        rows.append((n, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = _plain_terms(rows)
    assert expected
    found = find_pii(docs).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for row in found:
        got = {(t.start, t.stop, t.action) for t in row.terms}
        assert got == expected.get((row.doc_id, texts[row.doc_id]), set())
        assert [(s.kind, s.start, s.stop) for s in row.base] == base_spans(texts[row.doc_id])
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert "m@ville.org" not in clean[0] and "[EMAIL]" in clean[0] and "Éville" not in clean[0]
    assert clean[2] == texts[2] and "[PHONE]" in clean[3] and "plumber" not in clean[3]


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    rows = [(n, f"word{n % 5} secret a@b.co near") for n in range(30)] + [(n, "near word1") for n in range(30, 90)]
    rows += [(n, rows[n][1]) for n in range(0, 90, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = tuples(find_pii(docs))
    monkeypatch.setattr(membership, "BITS", 64)
    assert tuples(find_pii(docs)) == first


def test_odd_rows(spark):
    docs = odd_docs(spark)
    found = find_pii(docs)
    assert found.count() == docs.count()
    assert {len(r.base) for r in found.filter("doc_id = 10").collect()} == {3}
    cleaned = sanitise(docs)
    assert cleaned.columns == docs.columns
    assert tuples(cleaned.filter("doc_id <> 10 or doc_id is null")) == tuples(docs.filter("doc_id <> 10 or doc_id is null"))
    assert cleaned.filter("doc_id = 10").collect()[0].text == "[EMAIL] [EMAIL] [EMAIL] 2024"
    assert find_pii(docs.limit(0)).isEmpty() and sanitise(docs.limit(0)).isEmpty()
