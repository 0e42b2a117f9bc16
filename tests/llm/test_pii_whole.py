from __future__ import annotations

import re
from math import isclose, log2

from rollbook.llm.pii import find_pii, sanitise
from rollbook.llm.store import Tables


def test_terms_of_the_whole_document_go(spark):
    """The term stands beside the entity and 100 words on, or just far from it."""
    far = " ".join(f"c{n % 20}x" for n in range(100))
    rows = [(n, f"d{n} jane@x.org Zorblatt {far} Zorblatt") for n in range(4)]
    rows += [(n, f"d{n} jane@x.org {far} Zorblatt") for n in range(4, 8)]
    rows += [(n, f"d{n} {far}") for n in range(8, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert len(clean) == 80
    for n, text in rows:
        assert "Zorblatt" not in clean[n] and "jane@x.org" not in clean[n]
        assert clean[n].count("c7x") == text.count("c7x")
    found = {r.doc_id: r.terms for r in find_pii(docs).collect()}
    assert [len([t for t in found[n] if t.stop - t.start == 8]) for n in (0, 4, 8)] == [2, 1, 0]


def test_terms_of_entities_in_one_or_two_documents(spark):
    """Copies say nothing, single documents do, and a domain recurs where its addresses do not."""
    rows = [(n, f"common words{n % 4} here n{n % 16}") for n in range(64)]
    rows += [(100, "write u1@one.org Quixwort common"), (101, "write u2@two.org common Vimbolt"),
             (102, "common words u2@two.org Vimbolt"), (103, "Larkspen common a@firm.net words1"),
             (104, "common b@firm.net Larkspen"), (105, "here common c@firm.net Larkspen words2")]
    docs = spark.createDataFrame(rows + [(n, rows[64][1]) for n in range(200, 240)], "doc_id long, text string")
    found = {r.doc_id: r.terms for r in find_pii(docs.repartition(3)).collect()}
    assert len(found) == 110
    told = {n: {text[t.start : t.stop] for t in found[n]} for n, text in rows}
    assert {n for n, _ in rows if "Quixwort" in told[n]} == {100}
    assert "Vimbolt" in told[101] & told[102] and "Larkspen" in told[103] & told[104] & told[105]
    assert not any({"common", "here"} & words for words in told.values())
    # 22 different texts: 16 and six more; the copies of 100 change no count but have its spans.
    assert all(found[n] == found[100] for n in range(200, 240))
    assert isclose(max(t.disclosure for t in found[100] if t.stop - t.start == 8), log2(0.5 * 22) / log2(22))


def test_only_bitmaps_are_broadcast(spark, monkeypatch):
    """What grows with the corpus never meets on the driver, however small its files may be."""
    plans, stored = [], Tables.stored

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def seen(self, df, label):
        plans.append(plan(df))
        return stored(self, df, label)

    monkeypatch.setattr(Tables, "stored", seen)
    rows = [(n, f"w{n} jane@x.org u{n % 9}@y.org Zorblatt c{n % 5}x") for n in range(40)]
    rows += [(n, f"c{n % 5}x d{n}") for n in range(40, 80)]
    found = find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    plans.append(plan(found))
    joins = [line for text in plans for line in text.splitlines() if re.search(r"(Join|CartesianProduct)\b", line)]
    assert sum("SortMergeJoin" in line for line in joins) >= 7
    assert all("SortMergeJoin" in line or "_word#" in line for line in joins)
    assert found.count() == 80 and found.filter("size(terms) > 0").count() == 40
