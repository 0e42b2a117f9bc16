"""Quality by importance resampling: hashed n-gram models of target and raw text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .repeats import told_apart
from .store import stored

BUCKETS = 10_000
#: Target documents that the target model counts at most, chosen by hash of the id.
TARGET_ROWS = 20_000
#: Keys that the search for the last place of the sample may bring to the driver.
LAST_KEYS = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a whole text's words and pairs of neighbouring words, in lower case."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pairs = hashes[:-1] * _MIX + hashes[1:]
    pairs ^= pairs >> np.uint64(31)
    return (np.concatenate([hashes, pairs]) % np.uint64(buckets)).astype(np.int64)


def _counts(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, chosen in zip(batch.column("_text"), batch.column("_chosen").to_pylist()):
                found = np.bincount(ngram_buckets(text.as_py(), buckets), minlength=buckets)
                raw += found
                if chosen:
                    target += found
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(target[used])],
            names=["bucket", "raw", "target"],
        )

    return count


def log_ratios(
    docs: DataFrame,
    target_ids: DataFrame,
    *,
    target_rows: int = TARGET_ROWS,
    buckets: int = BUCKETS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> np.ndarray:
    """For each bucket the log of its share in target text over its share in all text.

    All documents count as raw text; of ``target_ids`` (one column) the ``target_rows`` with the
    smallest hashes count as target. A partition adds up its own counts, and the driver gets
    one sum for each bucket. Each bucket counts once more than it was seen.
    """
    ids = target_ids.toDF("_target").filter(F.col("_target").isNotNull()).distinct()
    ids = ids.orderBy(F.xxhash64("_target"), F.col("_target")).limit(target_rows)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(ids), F.col("_id") == F.col("_target"), "left"
    ).select("_text", F.col("_target").isNotNull().alias("_chosen"))
    sums = rows.mapInArrow(_counts(buckets), "bucket int, raw long, target long")
    raw, target = np.ones(buckets), np.ones(buckets)
    for row in sums.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[row[0]] += row[1]
        target[row[0]] += row[2]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weight(text: Column, ratios: np.ndarray) -> Column:
    """Sum of the ratios of a text's n-grams: log of how much likelier the target model makes it."""

    @F.pandas_udf("double")
    def weight(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [float(ratios[ngram_buckets(value, len(ratios))].sum()) for value in batch],
                dtype="float64",
            )

    return weight(text)


def gumbel(identity: Column, seed: int = 0) -> Column:
    """Gumbel noise drawn from the identity and the seed, the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return -F.ln(-F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 52))))


def last_key(keys: DataFrame, k: int, column: str = "key") -> tuple[float, int]:
    """The ``k``-th largest value of ``column`` and how many rows lie above it, exactly.

    Every round counts the rows of 4,096 steps between the bounds, over all rows, and goes on
    in the step that holds the place, until few rows or one value are left.
    """
    low, high = keys.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        inside = keys.filter(F.col(column).between(low, high))
        width = (high - low) / LAST_KEYS
        step = F.least(F.floor((F.col(column) - low) / width), F.lit(LAST_KEYS - 1))
        counted = inside.groupBy(step.alias("step")).agg(
            F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(counted.collect(), key=lambda row: -row["step"]):
            if above + row["rows"] >= k:
                break
            above += row["rows"]
        if (low, high) == (row["low"], row["high"]):  # no step can part them any more
            values = keys.filter(F.col(column).between(low, high)).groupBy(column).count()
            for value, rows in sorted(values.collect(), reverse=True):
                if above + rows >= k:
                    return value, above
                above += rows
        low, high = row["low"], row["high"]
    return low, above


def resample(
    docs: DataFrame,
    ratios: np.ndarray,
    *,
    keep: float,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The sample: ``doc_id, _digest, log_weight, key`` of the rows it keeps.

    A row's key is its log weight and Gumbel noise; the rows with the largest keys are a sample
    without replacement in proportion to the weights. ``keep`` of all rows, rounded up, are
    kept; nothing is sorted as a whole. Null and empty texts weigh as much in either model. Rows
    without id have noise by their text, and where over a thousandth of all rows are equal in
    id and text, each has noise of its own by a number. Of rows whose keys equal the last one kept, which then are few,
    those with the smallest ids and digests stay. An empty table gives no rows.
    """
    digest = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    weighed = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), digest.alias("_digest"),
        log_weight(F.col(f"`{text}`"), ratios).alias("log_weight"),
    )
    weighed = told_apart(stored(weighed, "resample_weights"), F.col("doc_id"), F.col("_digest"))
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("_digest")))
    named = F.when(F.col("_number") == 0, named).otherwise(F.concat(named, F.lit("#"), F.col("_number")))
    key = F.col("log_weight") + gumbel(named, seed)
    rows = stored(weighed.withColumn("key", key).drop("_number"), "resample_keys")
    k = math.ceil(keep * rows.count())
    if not k:
        return rows.limit(0)
    value, above = last_key(rows, k)
    rank = F.expr("row_number() over (partition by key order by doc_id, _digest)")
    ties = rows.filter(F.col("key") == value).withColumn("rank", rank)
    return rows.filter(F.col("key") > value).unionByName(
        ties.filter(F.col("rank") <= k - above).drop("rank")
    )


def target_share(labels: DataFrame, label: str) -> float:
    """Share of target rows (1) among labelled ones (0 or 1); all where none is labelled."""
    known = labels.filter(F.col(f"`{label}`").isin(0, 1))
    share = known.agg(F.avg(F.col(f"`{label}`").cast("double"))).first()[0]
    return 1.0 if share is None else share
