from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import odd_docs
from pyspark.sql import functions as F

from rollbook.llm import resampling
from rollbook.llm.queries import op9_quality_resampling
from rollbook.llm.resampling import gumbel, last_key, log_ratios, ngram_buckets, resample


@pytest.mark.parametrize("steps", [2, 4096])
def test_last_key_is_exact(spark, monkeypatch, steps):
    monkeypatch.setattr(resampling, "LAST_KEYS", steps)
    chance = random.Random(1)
    values = [chance.choice([chance.gauss(0, 1e6), 5.0, chance.random(), -1e300]) for _ in range(300)]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    ranked = sorted(values, reverse=True)
    for k in (1, 2, 77, 150, 299, 300):
        value, above = last_key(keys, k)
        assert value == ranked[k - 1] and above == sum(v > value for v in values)


def test_ratios_against_plain_counts(spark):
    rows = [(n, f"good text {n}" if n % 2 else f"junk junk {n}") for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(n,) for n in range(1, 60, 2)] + [(None,), (1,)], "doc_id long")
    got = log_ratios(docs, target, buckets=100)
    raw, good = Counter(), Counter()
    for n, text in rows:
        found = ngram_buckets(text, 100).tolist()
        raw.update(found)
        good.update(found if n % 2 else [])
    sums = sum(raw.values()) + 100, sum(good.values()) + 100
    expected = [math.log((good[b] + 1) / sums[1]) - math.log((raw[b] + 1) / sums[0]) for b in range(100)]
    assert np.allclose(got, expected)


def test_sample_is_the_top_of_the_keys(spark):
    rows = [(n, "good text" if n % 2 else "junk junk") for n in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ratios = log_ratios(docs, docs.filter("doc_id % 2 = 1").select("doc_id"), buckets=50)
    got = resample(docs, ratios, keep=0.3)
    noise = {r.doc_id: r.g for r in docs.select("doc_id", gumbel(F.col("doc_id")).alias("g")).collect()}
    keys = {n: ratios[ngram_buckets(t, 50)].sum() + noise[n] for n, t in rows}
    top = sorted(keys, key=keys.get, reverse=True)[:60]
    assert {r.doc_id for r in got.collect()} == set(top)


def test_held_out_quality(spark):
    sf_dir = "/root/testdata/sf0.1"
    kept = op9_quality_resampling(spark, sf_dir)
    total = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = labels.filter("quality = 1").count() / labels.filter("quality in (0, 1)").count()
    assert kept.count() == math.ceil(good * total)
    share = {r.quality: r.n for r in labels.join(kept, "doc_id", "left").groupBy("quality").agg(
        F.avg(F.coalesce(F.col("kept").cast("int"), F.lit(0))).alias("n")).collect()}
    assert share[1] > 0.9 and share[0] < 0.6


def test_odd_rows(spark):
    docs = odd_docs(spark)
    ratios = log_ratios(docs, docs.select("doc_id"), buckets=64)
    assert resample(docs, ratios, keep=1.0).count() == docs.count()
    for keep in (0.1, 0.5, 0.9):
        assert resample(docs, ratios, keep=keep).count() == math.ceil(keep * docs.count())
    assert resample(docs.limit(0), ratios, keep=0.5).isEmpty()
    assert np.allclose(log_ratios(docs.limit(0), docs.select("doc_id"), buckets=8), 0)
    same = docs.filter("doc_id = 1").withColumn("n2", F.explode(F.sequence(F.lit(1), F.lit(9))))
    assert resample(same, ratios, keep=0.5).count() == 5
    assert resampling.target_share(spark.createDataFrame([(1,), (0,), (None,), (1,), (7,)], "good int"), "good") == 2 / 3
    assert resampling.target_share(spark.createDataFrame([], "good int"), "good") == 1.0


@pytest.mark.parametrize("doc", [None, 7])
def test_a_third_of_the_rows_equal(spark, doc):
    """Each has noise of its own, so that none of them is a tie."""
    rows = [(n if n % 3 else doc, "one text" if n % 3 == 0 else f"text {n}") for n in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ratios = np.zeros(16)
    kept = resample(docs, ratios, keep=0.5)
    assert kept.count() == 450 and kept.select("key").distinct().count() == 450
    equal = kept.filter(F.col("_digest") == F.md5(F.lit("one text"))).count()
    assert 100 < equal < 200
    again = resample(docs.repartition(2), ratios, keep=0.5)
    assert sorted(r.key for r in kept.collect()) == sorted(r.key for r in again.collect())
