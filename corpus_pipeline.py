"""A corpus from raw documents: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import decontamination, jaccard_join, mixing, queries, sharding, toxicity
from rollbook.llm.store import stored
from rollbook.llm.words import spaced_words

#: Near copies share this percentage or more of their shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model is fitted on the given documents' labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_ordinary(docs, toxicity.fit(docs, labels))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect the one with the smallest id stays."""
    return jaccard_join.keep_one(docs, shingle=NEAR_WORDS, percent=NEAR_PERCENT)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix has it: whole epochs and a share of one more."""
    text = F.col("text")
    return mixing.repeat_mixed(
        docs, size=F.size(spaced_words(text)), weight=queries.mix_weight(text),
        identity=F.col("doc_id"), tie=F.md5(text),
    )


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the shard and the slot in it that they belong to."""
    text = F.col("text")
    return sharding.shard(
        docs, size=queries.shard_size(text), key=sharding.hashed_key(text),
        tie=sharding.hashed_key(F.col("doc_id")), shards=queries.SHARDS,
    )


STAGES = [
    ("toxicity", remove_toxic),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", remove_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", shard_documents),
]

#: SQL has no zstandard, so the whole is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
