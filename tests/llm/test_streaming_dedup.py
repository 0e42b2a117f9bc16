from __future__ import annotations

from helpers import CLASHING, odd_docs
from pyspark.sql import functions as F

from rollbook.llm.streaming_dedup import absorb, decide, deduplicate, state_of
from rollbook.scratch import scratch_path

COLUMNS = ["doc_id", "keep_id", "group_size", "kept"]


def _plain(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    found = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            found.append((i, keep, len(ids), i == keep and not kept))
            kept = kept or i == keep
    return sorted(found, key=repr)


def _write(docs, label):
    path = scratch_path(docs.sparkSession, label)
    docs.write.parquet(path)
    return path


def test_against_brute_force(spark):
    rows = [(n, f"text {n % 37}") for n in range(500)] + [(n, "hot") for n in range(500, 1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = deduplicate(spark, _write(docs, "dedup_a")).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == _plain(rows)


def test_full_texts_are_compared(spark):
    rows = [(n, f"text {n % 50}") for n in range(400)]
    path = _write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "dedup_b")
    got = deduplicate(spark, path, digest=lambda text: (F.crc32(text) % 7).cast("string")).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == _plain(rows)


def test_state_goes_on_with_new_files(spark):
    checkpoint = scratch_path(spark, "dedup_state_test")
    path = _write(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"), "dedup_c")
    absorb(spark, path, checkpoint)
    spark.createDataFrame([(3, "a"), (4, "c")], "doc_id long, text string").write.mode("append").parquet(path)
    absorb(spark, path, checkpoint)
    assert {(r.keep.doc_id, r.group_size) for r in state_of(spark, checkpoint).collect()} == {(3, 2), (2, 1), (4, 1)}
    got = decide(spark, path, checkpoint).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == _plain([(1, "a"), (2, "b"), (3, "a"), (4, "c")])


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("_metadata", F.lit("own"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = deduplicate(spark, _write(docs, "dedup_d"))
    assert sorted(map(tuple, got.select(COLUMNS).collect()), key=repr) == _plain(rows)
    assert not set(CLASHING) & (set(got.columns) - {"place"})
    assert deduplicate(spark, _write(docs.limit(0), "dedup_e")).isEmpty()


def test_decisions_absorb_new_files_first(spark):
    checkpoint = scratch_path(spark, "dedup_state_new")
    path = _write(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"), "dedup_f")
    decide(spark, path, checkpoint).count()
    spark.createDataFrame([(3, "c"), (4, "a")], "doc_id long, text string").write.mode("append").parquet(path)
    got = decide(spark, path, checkpoint).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == _plain([(1, "a"), (2, "b"), (3, "c"), (4, "a")])
