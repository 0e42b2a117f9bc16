"""One query for each operator over its whole table, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    chat,
    decontamination,
    jaccard_join,
    mixing,
    nearest,
    pii,
    resampling,
    sharding,
    streaming_dedup,
    toxicity,
    turn_alignment,
    url_filters,
)
from .store import stored
from .words import spaced_words

Query = Callable[[SparkSession, str], DataFrame]

#: Fixed values of the URL rules.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
SHARDS = 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(docs, items)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
        toxicity.toxicity_score(model, F.col("text")).alias("score"),
    )
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.withColumn("predicted", predicted)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    base = F.col("base")
    terms = F.transform(
        "terms", lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["stop"].alias("stop"))
    )
    return found.select(
        "doc_id", *[pii.count_kind(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.concat(base, terms)).alias("spans"),
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filters.path_rule(verdict, rule) for verdict, rule in URL_RULES]
    judged = url_filters.filter_urls(_table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def mix_weight(text):
    """Documents that repeat themselves count less: 0.5 and the share of distinct words."""
    words = spaced_words(text)
    distinct = F.size(F.array_distinct(words)).cast("double")
    return F.lit(0.5) + distinct / F.greatest(F.size(words), F.lit(1))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.col("text")
    slim = stored(
        docs.select(
            "doc_id", "source", F.size(spaced_words(text)).cast("long").alias("words"),
            mix_weight(text).alias("weight"), F.md5(text).alias("digest"),
        ),
        "mix_sizes",
    )
    mixed = mixing.mix(
        slim, size=F.col("words"), weight=F.col("weight"), identity=F.col("doc_id"),
        tie=F.col("digest"),
    )
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def shard_size(text):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    slim = _table(spark, sf_dir, "documents").select(
        "doc_id", shard_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        sharding.hashed_key(text).alias("key"),
    )
    sharded = sharding.shard(
        slim, size=F.col("size"), key=F.col("key"), tie=sharding.hashed_key(F.col("doc_id")),
        shards=SHARDS,
    )
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(_table(spark, sf_dir, "conversations"))


def op9_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    good = labels.filter("quality = 1").select("doc_id")
    ratios = resampling.log_ratios(docs, good)
    sample = resampling.resample(docs, ratios, keep=resampling.target_share(labels, "quality"))
    return sample.select("doc_id", "log_weight", "key", F.lit(True).alias("kept"))


def op10_streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = streaming_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet")
    return decided.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(alignment.digests(_table(spark, sf_dir, "documents")), "align_rows")
    return alignment.link_totals(rows, alignment.pair_counts(rows)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Turns damaged by a checksum of conversation and number; nulls count as one space."""
    space = F.lit(" ")
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    )
    way = F.crc32(key) % 20
    text = F.coalesce("text", space)
    return turns.withColumns({"_way": way, "_text": text}).filter("_way <> 0").select(
        "conv_id", "turn",
        F.when(F.col("_way") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("_way") == 1, "")
        .when(F.col("_way") == 2, F.regexp_replace("_text", "[.!?]", ""))
        .otherwise(F.col("_text")).alias("text"),
        F.explode(F.when(F.col("_way") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    edits = turn_alignment.repair(damaged(turns))
    found = turn_alignment.summaries(edits).withColumnRenamed("conv_id", "_of")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    every = turns.select("conv_id").distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_of")), "left").select(
        "conv_id", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return nearest.nearest(embeddings, F.col("vec_id") % 50 == 0).select(
        "query_id", "rank", "vec_id", "score"
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos
  FROM item_words WHERE len(w) > 0
), grams AS (
  SELECT n, w[pos:pos + n - 1] AS gram, list_distinct(list(item)) AS items FROM starts GROUP BY ALL
), doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), lengths AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS pos FROM doc_words, lengths WHERE len(w) >= n
), found AS (
  SELECT r, pos, p.n, items FROM places p JOIN grams g ON p.n = g.n AND p.w[p.pos:p.pos + p.n - 1] = g.gram
), hit AS (
  SELECT r, count(DISTINCT word) AS n_hit
  FROM (SELECT r, unnest(range(pos, pos + n)) AS word FROM found) GROUP BY r
), named AS (
  SELECT r, list_sort(list_distinct(flatten(list(items)))) AS items FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

OP5_SQL = r"""
WITH rules(verdict, rule) AS (VALUES ('allow', 'com/'), ('block', 'example.com/en/'),
  ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')),
parts AS (
  SELECT verdict, rule, split_part(rule, '/', 1) AS rule_host,
         substr(rule, strpos(rule, '/')) AS rule_path FROM rules
), urls AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), fits AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM urls JOIN parts ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)
  GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN fits USING (r)
"""

OP6_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(text) AS digest,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), keyed AS (
  SELECT r, doc_id, source, digest, CAST(len(w) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || coalesce(digest, ''))), 1, 13) AS BIGINT)
         + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
      / (0.5::DOUBLE + CAST(len(list_distinct(w)) AS DOUBLE) / greatest(len(w), 1)) AS key
  FROM docs
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM keyed GROUP BY source
), weighed AS (
  SELECT *, CASE turn % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         source_size * 2 AS full_size FROM sources
), shares AS (
  SELECT *, 1.5::DOUBLE * (SELECT CAST(sum(source_size) AS BIGINT) FROM sources)
      - coalesce(CAST(sum(full_size) OVER (ORDER BY full_size / weight, turn
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS left_over,
    CAST(sum(weight) OVER (ORDER BY full_size / weight, turn
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weights
  FROM weighed
), levels AS (
  SELECT *, full_size * weights <= weight * left_over AS is_full FROM shares
), level AS (
  SELECT arg_min(left_over, full_size / weight) AS left_over,
         arg_min(weights, full_size / weight) AS weights
  FROM levels WHERE NOT is_full
), targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN CAST(full_size AS DOUBLE)
         ELSE weight * level.left_over / level.weights END AS target
  FROM levels LEFT JOIN level ON true
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END
    AS epochs FROM targets
), placed AS (
  SELECT k.*, p.source_size, p.target, p.epochs,
    coalesce(CAST(sum(size) OVER (PARTITION BY k.source ORDER BY key, digest
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  (epochs + CASE WHEN before * 2 + size <= (target - epochs * source_size) * 2 THEN 1 ELSE 0 END)
    * size AS taken
FROM placed
"""

OP10_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def queries() -> dict[str, Query]:
    return {
        query.__name__: query
        for query in (
            op1_decontamination,
            op2_toxicity,
            op3_jaccard_join,
            op4_pii,
            op5_url_filters,
            op6_mixing,
            op7_sharding,
            op8_chat_formatting,
            op9_quality_resampling,
            op10_streaming_dedup,
            op11_tokenizer_alignment,
            op12_conversation_repair,
            op13_nearest_neighbours,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": OP1_SQL,
        "op5_url_filters": OP5_SQL,
        "op6_mixing": OP6_SQL,
        "op10_streaming_dedup": OP10_SQL,
    }
