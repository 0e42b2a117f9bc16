from __future__ import annotations

import random
import zlib

from helpers import odd_docs, tuples
from pyspark.sql import functions as F

from rollbook.llm.queries import op2_toxicity
from rollbook.llm import toxicity
from rollbook.llm.toxicity import _once, fit, fit_texts, held_out, keep_ordinary, toxicity_score

SF_DIR = "/root/testdata/sf0.1"


def _auc(rows):
    ranked = sorted(rows)
    positives = [n for n, (_, label) in enumerate(ranked, 1) if label]
    n1, n0 = len(positives), len(ranked) - len(positives)
    return (sum(positives) - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = op2_toxicity(spark, SF_DIR)
    assert scored.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = scored.filter("held_out").join(labels, "doc_id").filter("toxic is not null").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert all((r.score >= 0.7) == bool(r.predicted) and 0 <= r.score <= 1 for r in rows)
    assert _auc([(r.score, r.toxic) for r in rows]) > 0.92
    told = [r.toxic for r in rows if r.predicted]
    assert sum(told) / len(told) > 0.8 and sum(told) / sum(r.toxic for r in rows) > 0.65


def test_near_copies_are_fitted_on_once():
    words = [f"w{n}" for n in range(60)]
    near = " ".join(words[:59] + ["other"])  # 55 of 57 shingles of five words
    far = " ".join(words[:30] + [f"v{n}" for n in range(30)])
    texts = [" ".join(words), near, far, None, "", " ".join(words).upper(), "a b", None]
    assert _once(texts) == [0, 2, 3, 4, 6, 7]


def test_toxic_words_are_found_by_what_they_save():
    """Words that recur in toxic texts and in hardly any other, whatever the words."""
    chance = random.Random(3)
    common = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    marks = ["zorkle", "quaxim", "vyrn"]
    texts, labels = [], []
    for n in range(400):
        words = chance.choices(common, k=60) + ["honest", "mention"]
        if n % 4 == 0:
            words += chance.choices(marks, k=3)
        chance.shuffle(words)
        texts.append(" ".join(words))
        labels.append(int(n % 4 == 0))
    model = fit_texts(texts, labels)
    own = model.toxic[: len(model.toxic) - len(model.ordinary)].split()
    assert set(own) == {mark.encode() for mark in marks}
    score = model.scorer()
    assert score("some honest zorkle mention of vyrn quaxim") > 0.7 > score("some honest mention of this")


def test_rows_and_bytes_to_fit_on_are_bounded(spark):
    docs = spark.createDataFrame([(n, "word " * (1 + n)) for n in range(90)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(90)], "doc_id long, toxic int")
    def fit_few(**how):
        return fit(docs, labels, **how)

    assert fit_few(fit_rows=5) != fit_few(fit_rows=40)
    assert fit_few(fit_bytes=0).scorer()("word") == toxicity.fit_texts([], []).scorer()("word")


def test_labels_held_out_have_no_say(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert fit(docs, labels) == fit(docs, turned)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    texts = [f"{word} {n} a{n} b{n} c{n} and some more" for n in range(40) for word in ("you idiot scum", "fine text")]
    model = fit_texts([*texts, None, "", ""], [1, 0] * 40 + [0, 0, 0])
    scores = [r.s for r in docs.select(toxicity_score(model, F.col("text")).alias("s")).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    kept = keep_ordinary(docs, model)
    assert kept.columns == docs.columns and tuples(kept) == tuples(docs)
    bad = docs.withColumn("text", F.lit("you idiot scum and some more"))
    assert keep_ordinary(bad, model).isEmpty()
    assert keep_ordinary(docs.limit(0), model).isEmpty()


def test_without_labels(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = fit(docs, none)
    assert model.scorer()("anything") < 0.01
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 7), (1, 0), (1, 0), (5, 1)], "doc_id long, toxic int")
    assert 0 <= fit(docs, odd).scorer()(None) <= 1
