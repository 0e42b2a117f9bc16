"""Benchmark decontamination: a hash set of test n-grams held against every token window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .membership import bitmap, parted, possibly
from .store import Tables, own, row_key, rows_again, wrapped
from .words import ALNUM_BREAK, ALNUM_WORD, alnum_words

NGRAM = 10
#: Lots that the windows of one gram are dealt to, as a passage may stand in very many documents.
LOTS = 16


def _grams(benchmark: DataFrame, ngram: int, item_id: str, item_text: str) -> DataFrame:
    """Distinct grams of the benchmark with the items that hold them."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), alnum_words(F.col(item_text)).alias("words")
    ).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(ngram))
    starts = items.select(
        "item", "words", length.alias("gram_len"),
        F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("start"),
    )
    gram = F.slice("words", F.col("start"), F.col("gram_len"))
    return (
        starts.select("item", "gram_len", gram.alias("gram"))
        .groupBy("gram_len", "gram")
        .agg(F.collect_set("item").alias("gram_items"))
        .withColumn("gram_hash", F.xxhash64("gram"))
    )


def _merged(spans: Column) -> Column:
    """Ranges of word numbers, sorted and with overlapping or touching ones joined."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop")
        )
        return F.when(
            (F.size(done) > 0) & (last["stop"] >= span["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), empty, add)


def _covered(spans: Column) -> Column:
    """How many words the ranges cover together."""
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("stop"))

    def add(done: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0), span["stop"] - F.greatest(span["start"], done["stop"]))
        return F.struct(
            (done["hit"] + new).alias("hit"),
            F.greatest(done["stop"], span["stop"]).alias("stop"),
        )

    return F.aggregate(F.array_sort(spans), start, add, lambda done: done["hit"])


def _hits(docs, benchmark, ngram, doc_id, text, item_id, item_text, tables) -> DataFrame:
    """One row for each id and text: words, ranges hit, items found, and number of such rows.

    A bitmap of the grams' hashes goes to all tasks and drops nearly all windows where they
    are made. What it lets through crosses as its place and its own words, to be compared
    with the grams; a document's words never leave their task.
    """
    grams = tables.stored(_grams(benchmark, ngram, item_id, item_text), "grams")
    lengths = grams.agg(F.sort_array(F.collect_set("gram_len"))).first()[0] or [ngram]
    wanted = bitmap(grams.select("gram_hash"), tables, "gram_bitmap")
    grams = tables.stored(
        grams.withColumn("gram_lot", F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1)))), "gram_lots"
    )

    tokens = docs.select(*row_key(doc_id, text), alnum_words(F.col(f"`{text}`")).alias("words"))
    # Row 0 of each document stands for the document itself.
    windows = tokens.select(
        "_id", "_digest", "words",
        F.explode(F.sequence(F.lit(0), F.size("words"))).alias("at"),
    )
    if len(lengths) == 1:
        windows = windows.withColumn("len", F.lit(lengths[0]))
    else:
        windows = windows.withColumn("len", F.explode(F.array(*map(F.lit, lengths))))
    itself = (F.col("at") == 0) & (F.col("len") == lengths[0])
    whole = (F.col("at") > 0) & (F.col("at") + F.col("len") <= F.size("words") + 1)
    window = F.slice("words", F.greatest("at", F.lit(1)), F.col("len"))
    hashed = F.when(whole, F.xxhash64(window)).when(itself, F.xxhash64("_id", "_digest"))
    marked = possibly(windows.withColumn("hash", hashed).filter("hash is not null"), F.col("hash"), wanted)
    # Documents themselves meet no gram, as none is of length 0.
    left = marked.filter(itself | F.col("_maybe")).select(
        "_id", "_digest", F.size("words").cast("long").alias("n_words"), "at", "hash",
        F.when(itself, 0).otherwise(F.col("len")).alias("len"),
        F.when(~itself, window).alias("window"),
        F.pmod(F.xxhash64("_digest", "at"), F.lit(LOTS)).cast("int").alias("lot"),
    )
    found = left.join(
        grams,
        (F.col("hash") == F.col("gram_hash")) & (F.col("len") == F.col("gram_len"))
        & (F.col("lot") == F.col("gram_lot")) & (F.col("window") == F.col("gram")),
        "left",
    ).filter(F.col("gram_items").isNotNull() | (F.col("len") == 0))
    span = F.struct(F.col("at").alias("start"), (F.col("at") + F.col("len")).alias("stop"))
    rows = found.select(
        "_id", "_digest", "n_words", "gram_items",
        F.when(F.col("gram_items").isNotNull(), span).alias("span"),
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("gram_items"))))
    return rows.groupBy("_id", "_digest").agg(
        F.max("n_words").alias("n_words"),
        F.collect_set("span").alias("spans"),
        items.alias("items"),
        F.count_if(F.col("span").isNull()).alias("copies"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    ngram: int = NGRAM,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """What every document shares with the benchmark.

    A gram is ``ngram`` consecutive words of an item, or all words of a shorter one. Every
    window of every whole document is hashed and looked up; a hit counts only when the words
    agree too. Returns ``doc_id, n_words, n_hit`` (words inside any gram), ``n_items, items``
    (sorted as strings), ``spans`` (ranges of hit words from 1, end exclusive), ``contaminated``.

    Null and empty texts have no words; null item ids mark words
    as hit and name no item; no benchmark means no hits; of documents with the same id and
    text each row is returned. Other columns are ignored, whatever their names.
    """
    with Tables() as tables:
        hits = _hits(docs, benchmark, ngram, doc_id, text, item_id, item_text, tables)
        hits = tables.stored(hits.withColumn("n_hit", _covered(F.col("spans"))), "gram_hits")
        tables.keep(hits)
    return rows_again(hits, "copies").select(
        F.col("_id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"), "items",
        _merged(F.col("spans")).alias("spans"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    remove: str = "documents",
    ngram: int = NGRAM,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the hit words.

    All columns stay. With spans, a hit word goes together with the separators before it;
    untouched documents keep every byte. See :func:`contamination` for odd rows.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    with Tables() as tables:
        hits = _hits(docs, benchmark, ngram, doc_id, text, item_id, item_text, tables)
        hits = tables.stored(
            hits.filter(F.size("spans") > 0).select(
                F.col("_id").alias("_hit_id"), F.col("_digest").alias("_hit_digest"),
                _merged(F.col("spans")).alias("_hit_spans"),
            ),
            "gram_hits",
        )
        hashed = hits.select(F.xxhash64("_hit_id", "_hit_digest").alias("k"))
        words = bitmap(hashed, tables, "gram_hit_bitmap")
        tables.keep(hits, words)
    # Only what may be hit has to meet the hits.
    rows = wrapped(docs).withColumns({"_id": own(doc_id), "_digest": F.md5(own(text))})
    maybe, others = parted(rows, F.xxhash64("_id", "_digest"), words)
    same = F.col("_id").eqNullSafe(F.col("_hit_id")) & (F.col("_digest") == F.col("_hit_digest"))
    if remove == "documents":
        stay = maybe.join(hits, same, "left_anti").select("_row")
        return others.select("_row").unionByName(stay).select("_row.*")
    none = F.lit(None)
    kinds = {name: hits.schema[name].dataType for name in ("_hit_digest", "_hit_spans")}
    joined = maybe.join(hits, same, "left").select("_row", *kinds).unionByName(
        others.select("_row", *[none.cast(kind).alias(name) for name, kind in kinds.items()])
    )
    # Cut at the same places as the lower-cased text: only A-Z changed there.
    pieces = F.regexp_extract_all(own(text), F.lit(_PIECE), F.lit(0))
    kept = F.filter(
        pieces,
        lambda piece, at: ~F.exists(
            "_hit_spans", lambda span: (span["start"] <= at + 1) & (at + 1 < span["stop"])
        ),
    )
    tail = F.regexp_extract(own(text), _TAIL, 0)
    cleaned = F.when(F.col("_hit_digest").isNull(), own(text)).otherwise(
        F.concat(F.array_join(kept, ""), tail)
    )
    return joined.select(*[
        (cleaned if name == text else own(name)).alias(name) for name in docs.columns
    ])


_LETTER = ALNUM_WORD.replace(r"\x60", r"\x40\x5B-\x60")
_GAP = ALNUM_BREAK.replace(r"\x60", r"\x40\x5B-\x60")
_PIECE = f"{_GAP}*{_LETTER}"
_TAIL = rf"{_GAP}*\z"
