from __future__ import annotations

import random

import pytest
from helpers import CLASHING, alnum, odd_docs, tuples

from rollbook.llm.decontamination import contamination, decontaminate
from rollbook.llm.store import Tables, rows_again


def _plain(docs, items, ngram=10):
    grams = {}
    for item, text in items:
        words = alnum(text)
        size = min(ngram, len(words))
        for at in range(len(words) - size + 1) if words else ():
            grams.setdefault(tuple(words[at : at + size]), set()).add(None if item is None else str(item))
    lengths = {len(gram) for gram in grams}
    found = []
    for doc, text in docs:
        words, hit, named = alnum(text), set(), set()
        for size in lengths:
            for at in range(len(words) - size + 1):
                if (gram := tuple(words[at : at + size])) in grams:
                    hit.update(range(at, at + size))
                    named |= grams[gram] - {None}
        found.append((doc, len(words), len(hit), sorted(named)))
    return sorted(found, key=repr)


def _case(seed):
    chance = random.Random(seed)
    vocabulary = ["a", "B", "c1", "Éa", "é", "the", "of"]
    items = [(n, " ".join(chance.choices(vocabulary, k=chance.choice([1, 3, 9, 10, 14])))) for n in range(12)]
    items += [(None, "the of the of"), (13, None), (14, " !? "), (15, items[3][1])]
    docs = []
    for n in range(80):
        words = chance.choices(vocabulary, k=chance.randrange(0, 60))
        if n % 3 == 0:
            words[5:5] = (chance.choice(items)[1] or "").split()
        docs.append((n, chance.choice([" ", ", ", "\n"]).join(words)))
    return docs + [docs[0], (3, "another text of id 3"), (None, docs[6][1])], items


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, threshold, monkeypatch):
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    try:
        _against_brute_force(spark, seed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_windows_cross_with_their_own_words_only(spark, tmp_path):
    """With both broadcast thresholds at -1, what is shuffled is in proportion to the words hit."""
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    passage = [f"p{n}" for n in range(30)]
    docs = [(n, " ".join([f"w{n}x{m}" for m in range(400)] + passage)) for n in range(20)]
    items = spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    plans, written = [], []
    stored = Tables.stored

    def seen(self, df, label):
        plans.append(_plan(df))
        found = stored(self, df, label)
        written.append((label, found.count()))
        return found

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    Tables.stored = seen
    try:
        found = contamination(spark.read.parquet(str(tmp_path / "docs")), items).collect()
    finally:
        Tables.stored = stored
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert all(r.n_hit == 30 and r.n_words == 430 for r in found)
    plan = next(p for p in plans if "gram_items" in p and "SortMergeJoin" in p)
    physical = plan[plan.index("== Physical Plan =="):]
    above = physical[physical.index("SortMergeJoin"):]
    side = above.split("Exchange hashpartitioning(hash")[1]
    crossing = side.split("+- ")[1]
    assert crossing.strip("* (0123456789)").startswith("Project") and "window" in crossing
    columns = crossing[crossing.index("[") :].split("]\n")[0]
    assert " words#" not in columns.replace("size(words", "").replace("slice(words", "")


def _against_brute_force(spark, seed):
    docs, items = _case(seed)
    found = contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()]
    assert sorted(got, key=repr) == _plain(docs, items)
    for row in found.collect():
        assert row.contaminated == (row.n_hit > 0) and row.n_items == len(row["items"])
        assert sum(s.stop - s.start for s in row.spans) == row.n_hit


def test_odd_rows_and_no_benchmark(spark):
    docs = odd_docs(spark)
    items = spark.createDataFrame([(1, "beta gamma")], "item_id long, text string")
    found = contamination(docs, items)
    assert found.count() == docs.count()
    assert sorted(r.n_hit for r in found.filter("contaminated").collect()) == [2, 2]
    none = contamination(docs, items.limit(0))
    assert none.count() == docs.count() and none.filter("contaminated").isEmpty()
    assert contamination(docs.limit(0), items).isEmpty()


def test_removal_keeps_everything_else(spark):
    docs = odd_docs(spark)
    items = spark.createDataFrame([(1, "beta gamma")], "item_id long, text string")
    left = decontaminate(docs, items)
    assert left.columns == docs.columns
    assert tuples(left) == tuples(docs.filter("text is null or text not like 'Alpha%'"))
    cut = decontaminate(docs, items, remove="spans")
    assert cut.columns == docs.columns and cut.count() == docs.count()
    changed = cut.filter("text like 'Alpha%'").collect()
    assert {r.text for r in changed} == {"Alpha delta epsilon zeta eta theta iota kappa"}
    assert all(r[name] == f"own {name}" for r in changed for name in CLASHING)
    untouched = "text is null or text not like 'Alpha%'"
    assert tuples(cut.filter(untouched)) == tuples(docs.filter(untouched))


def test_spans_keep_the_tail(spark):
    docs = spark.createDataFrame([(1, "One, two THREE four!?\n"), (2, "two three")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    assert tuples(decontaminate(docs, items, remove="spans")) == [(1, "One four!?\n"), (2, "")]


def test_very_many_copies_of_a_row(spark):
    rows = spark.createDataFrame([(1, 200_000), (2, 0), (3, 1), (4, 65_536), (5, 65_537)], "id long, copies long")
    found = {r.id: r["count"] for r in rows_again(rows, "copies").groupBy("id").count().collect()}
    assert found == {1: 200_000, 3: 1, 4: 65_536, 5: 65_537}
    # An array of all copies would hold more than Spark lets an array have.
    huge = spark.createDataFrame([(1, 1 << 33)], "id long, copies long")
    assert rows_again(huge, "copies").limit(5).count() == 5
