from __future__ import annotations

import math

import duckdb
import pytest
from helpers import odd_docs, spaced, tuples
from pyspark.sql import functions as F
from test_decontamination import _plain as plain_hits
from test_near_copies import _components
from test_mixing import _plain_targets

import corpus_pipeline
from rollbook.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    score = toxicity.fit(docs, labels).scorer()
    rows = [r for r in docs.collect() if score(r.text) < 0.7]
    worded = [(r.doc_id, r.text) for r in rows if r.text and r.text.split()]
    component = dict(_components(worded, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT))
    rows = [r for r in rows if component.get(r.doc_id, r.doc_id) == r.doc_id]
    hit = {d for d, _, n, _ in plain_hits([(r.doc_id, r.text) for r in rows], items) if n}
    rows = [r for r in rows if r.doc_id not in hit]
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == [*columns, "shard", "slot"]
    found = got.collect()
    assert {r.doc_id for r in found} <= {r.doc_id for r in rows}
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        n = len((r.text or "").split())
        sizes[r.source] = sizes.get(r.source, 0) + n
        largest[r.source] = max(largest.get(r.source, 0), n)
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    for source, target in _plain_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= largest[source] / 2 + 1
    by_id = {r.doc_id: tuple(r) for r in rows}
    slots = {}
    for r in found:
        assert tuple(r)[:-2] == by_id[r.doc_id]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(own) == list(range(len(own))) and 0 <= n < 16 for n, own in slots.items())
    assert tuples(got) == tuples(corpus_pipeline.run(spark, SF_DIR))


def test_single_stages_against_brute_force(spark):
    """Each on its own input, with all its columns, clean documents and odd rows kept."""
    docs = odd_docs(spark)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    score = toxicity.fit(docs, labels).scorer()
    kept = corpus_pipeline.remove_toxic(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert tuples(kept) == sorted((tuple(r) for r in docs.collect() if score(r.text) < 0.7), key=repr)
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    leak = docs.filter("doc_id = 1").withColumn("text", F.concat(F.lit("Before it. "), F.lit(item), F.lit(" After.")))
    clean = corpus_pipeline.remove_contaminated(spark, docs.unionByName(leak), SF_DIR)
    assert tuples(clean) == tuples(docs)
    mixed = corpus_pipeline.mix_sources(spark, docs, SF_DIR)
    assert mixed.columns == docs.columns
    given = tuples(docs)
    assert all(row in given for row in tuples(mixed))
    sizes, taken = {}, {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(spaced(r.text))
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(spaced(r.text))
    for source, target in _plain_targets(sizes).items():
        largest = max(len(spaced(r.text)) for r in docs.collect() if r.source == source)
        assert abs(taken.get(source, 0) - target) <= largest / 2 + 1


def test_stages_take_any_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.isEmpty()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_matches_oracle(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    actual = queries.queries()[name](spark, sf_dir)
    expected = duck.execute(queries.oracle_sql()[name])
    names = sorted(column[0] for column in expected.description)
    assert sorted(actual.columns) == names
    order = [[c[0] for c in expected.description].index(n) for n in names]

    def rounded(rows):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in rows), key=repr)

    assert rounded(actual.select(names).collect()) == rounded(
        tuple(row[n] for n in order) for row in expected.fetchall()
    )


def test_whole_tables_in_the_other_queries(spark):
    sf_dir = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    total = documents.count()
    for name in ("op2_toxicity", "op3_jaccard_join", "op4_pii", "op7_sharding"):
        got = queries.queries()[name](spark, sf_dir)
        assert {r.doc_id for r in got.collect()} == {r.doc_id for r in documents.collect()}
        assert got.count() == total
    sharded = queries.op7_sharding(spark, sf_dir)
    crc = documents.select("doc_id", F.crc32("text").alias("c"), (F.octet_length("text") + 1).alias("s"))
    joined = sharded.join(crc, "doc_id").collect()
    assert all(r.text_crc32 == r.c and r.size == r.s and r.law == "bytes" and r.grown_shard is None for r in joined)
    assert math.isclose(sum(r.size for r in joined), sum(r.s for r in joined))
