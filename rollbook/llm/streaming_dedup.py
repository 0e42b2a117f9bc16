"""Exact deduplication as a stream with keyed state on disk."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_path
from .store import stored

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Keyed state on disk. RocksDB would set aside some megabytes in advance for each partition.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: A group with more than one in this many rows is looked up by broadcast; there are fewer
#: such groups than this number.
HOT = 1000
#: Rows of a group that one copy of the kept text is compared with.
ROWS_PER_COPY = 1000


def same_text(text: Column) -> Column:
    """Nothing is changed; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _state_on_disk(spark: SparkSession):
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def absorb(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = same_text,
    digest: Callable[[Column], Column] = sha256,
) -> None:
    """Stream the Parquet files of ``path`` that ``checkpoint`` has not seen into its state.

    For each digest the state holds how many rows had it, and of the row with the largest id
    the id and where its content lies (file, row). It lives in RocksDB below ``checkpoint``
    and never expires; a call after new files have come goes on from there.
    """
    schema = spark.read.parquet(path).schema
    # A pattern may name a single file, which a stream's folder may not.
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    rows = _located(spark.readStream.schema(schema).parquet(pattern), doc_id, text, normalise, digest)
    state = rows.groupBy("digest").agg(F.max("place"), F.count("*"))
    with _state_on_disk(spark):
        stream = (
            state.writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        stream.awaitTermination()


def _located(docs, doc_id, text, normalise, digest, *also: Column) -> DataFrame:
    # A table may have a column of its own by the name of the hidden one.
    where = docs.metadataColumn("_metadata")
    place = F.struct(
        F.col(doc_id).alias("doc_id"), where["file_path"].alias("file"), where["row_index"].alias("row")
    )
    content = normalise(F.col(text))
    return docs.select(digest(content).alias("digest"), place.alias("place"), *also)


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state holds: ``digest, keep`` (id, file, row) and ``group_size``."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", "value.*").toDF("digest", "keep", "group_size")


def decide(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = same_text,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row for each row of ``path``, held against the state, which absorbs new files first.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` and the row's ``place``. Every
    row whose digest others share is compared with the kept text byte by byte. Rows that only
    share the digest are grouped anew by their whole text.
    """
    # Files that the state has seen are not read again.
    absorb(spark, path, checkpoint, doc_id=doc_id, text=text, normalise=normalise, digest=digest)
    docs = spark.read.parquet(path)
    how = (doc_id, text, normalise, digest)
    state = stored(state_of(spark, checkpoint), "dedup_state")
    total = state.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    is_hot = F.col("group_size") * HOT > total
    hot, cold = F.broadcast(state.filter(is_hot)), state.filter(~is_hot)
    content = normalise(F.col(text))
    rows = _located(docs, *how, F.sha2(content, 256).alias("text_sha256"))
    found = rows.join(hot, "digest").unionByName(
        rows.join(hot, "digest", "left_anti").join(cold, "digest")
    )
    found = stored(found, "dedup_found")

    shared = found.filter(F.col("group_size") > 1)
    wrong = _differing(docs, shared, how)
    if not wrong.isEmpty():
        found = _regrouped(found, wrong)
    kept = F.col("place").eqNullSafe(F.col("keep"))
    return found.select(
        F.col("place.doc_id").alias("doc_id"), F.col("keep.doc_id").alias("keep_id"),
        "group_size", kept.alias("kept"), "text_sha256", "place",
    )


def _differing(docs: DataFrame, shared: DataFrame, how: tuple) -> DataFrame:
    """Rows whose text is not the kept text of their digest: ``place, digest, content``.

    The kept text of a large group is dealt out in copies, so that no task gets the group.
    """
    doc_id, text, normalise, digest = how
    copies = F.ceil(F.col("group_size") / ROWS_PER_COPY).cast("int")
    wanted = shared.select(
        F.col("place.file").alias("file"), F.col("place.row").alias("row"), "digest", "place",
        "keep", copies.alias("copies"),
    )
    texts = _located(docs, *how, normalise(F.col(text)).alias("content")).select(
        F.col("place.file").alias("file"), F.col("place.row").alias("row"), "content"
    )
    held = wanted.join(texts, ["file", "row"])
    is_kept = F.col("place").eqNullSafe(F.col("keep"))
    lots = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    kept = held.filter(is_kept).select(
        "digest", lots.alias("lot"), F.col("content").alias("kept_content")
    )
    lot = F.pmod(F.xxhash64("file", "row"), F.col("copies")).cast("int")
    others = held.filter(~is_kept).select("digest", lot.alias("lot"), "place", "content")
    return others.join(kept, ["digest", "lot"]).filter(
        F.col("content") != F.col("kept_content")
    ).select("place", "digest", "content")


def _regrouped(found: DataFrame, wrong: DataFrame) -> DataFrame:
    """``found`` where texts that share no more than a digest are groups of their own."""
    wrong = stored(wrong, "dedup_wrong")
    groups = wrong.groupBy("digest", "content").agg(
        F.max("place").alias("new_keep"), F.count("*").alias("new_size")
    )
    moved = wrong.join(groups, ["digest", "content"]).select("place", "new_keep", "new_size")
    lost = wrong.groupBy("digest").agg(F.count("*").alias("lost"))
    joined = found.join(lost, "digest", "left").join(
        moved.withColumnRenamed("place", "moved_place"),
        (F.col("place.file") == F.col("moved_place.file"))
        & (F.col("place.row") == F.col("moved_place.row")),
        "left",
    )
    is_moved = F.col("new_size").isNotNull()
    return joined.select(
        "digest", "place", "text_sha256",
        F.when(is_moved, F.col("new_keep")).otherwise(F.col("keep")).alias("keep"),
        F.when(is_moved, F.col("new_size"))
        .otherwise(F.col("group_size") - F.coalesce("lost", F.lit(0))).alias("group_size"),
    )


def deduplicate(spark: SparkSession, path: str, checkpoint: str | None = None, **how) -> DataFrame:
    """Stream ``path`` into the state of ``checkpoint`` and decide about every row of it.

    Of equal texts the row with the largest id stays; of rows that also share the id, the one
    whose place (file, row) is last; null ids come before all others. Null texts count as
    empty, so they are equal to empty ones. An empty table gives no rows. Other columns are
    not read. Without ``checkpoint`` the state is scratch.
    """
    checkpoint = checkpoint or scratch_path(spark, "dedup_stream")
    return decide(spark, path, checkpoint, **how)
