"""Information-theoretic sanitisation: what gives a protected entity away goes too."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .membership import bitmap, key_hash, parted, possible
from .store import Tables, own, wrapped
from .words import alnum_words

KINDS = ("email", "ip", "card", "phone")
#: Taken off each count of documents together: few documents are weak evidence of a share.
CORRECTION = 0.5
#: Share of an entity's information that a term may give away; above the second it is removed.
GENERALISE_AT = 0.75
REMOVE_AT = 0.9
LOTS = 16

# The patterns of the base kinds. Each starts where its run of characters
# starts, which finds the same matches without trying every place of a long run.
_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL_HERE = re.compile(rf"{_LOCAL}++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_EMAIL = re.compile(rf"(?<!{_LOCAL}){_EMAIL_HERE.pattern}")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _emails(text: str) -> Iterator[re.Match]:
    at = 0
    while at < len(text):
        # Right after a match a run may go on, and the next match starts inside it.
        found = (_EMAIL_HERE.match(text, at) if at else None) or _EMAIL.search(text, at)
        if not found:
            return
        yield found
        at = found.end()


def _luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of what the base patterns find, by kind and then start."""
    spans = [("email", *m.span()) for m in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(part) < 4 or not part[:-3].strip("0") for part in m[0].split(".")) and all(
            int(part[-3:]) <= 255 for part in m[0].split(".")
        ):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def _words(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """The words of a text with entities that are no part of an entity."""
    if not spans:
        return []
    covered = sorted((start, end) for _, start, end in spans)
    found, at = [], 0
    for m in _WORD.finditer(text):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if at == len(covered) or covered[at][0] >= m.end():
            term = re.sub("[A-Z]", lambda letter: letter[0].lower(), m[0])
            found.append({"term": term, "start": m.start(), "stop": m.end()})
    return found


def _entities(text: str, spans: list[tuple[str, int, int]]) -> list[str]:
    """What is protected: each string, and the mail domains, which recur where addresses do not."""
    found = {f"{kind}:{text[start:end]}" for kind, start, end in spans}
    found |= {f"domain:{text[start:end].rpartition('@')[2].lower()}" for kind, start, end in spans if kind == "email"}
    return sorted(found)


_SCAN = (
    "_id {id}, _digest string, base array<struct<kind:string,start:int,stop:int>>, "
    "entities array<string>, terms array<string>, kept string"
)
_MARKED = (
    "doc_id {id}, _digest string, base array<struct<kind:string,start:int,stop:int>>, "
    "terms array<struct<start:int,stop:int,action:string,disclosure:double>>"
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
_TERMS = pa.list_(pa.struct([
    ("start", pa.int32()), ("stop", pa.int32()), ("action", pa.string()), ("disclosure", pa.float64()),
]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the base patterns find; of texts with entities also the different words and the text."""
    for batch in batches:
        bases, entities, terms, kept = [], [], [], []
        for value in batch.column("_text"):
            text = value.as_py() or ""
            spans = base_spans(text)
            bases.append([{"kind": k, "start": s, "stop": e} for k, s, e in spans])
            entities.append(_entities(text, spans))
            terms.append(sorted({word["term"] for word in _words(text, spans)}))
            kept.append(text if spans else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_digest"), pa.array(bases, _SPANS),
             *(pa.array(lists, pa.list_(pa.string())) for lists in (entities, terms)), pa.array(kept, pa.string())],
            names=["_id", "_digest", "base", "entities", "terms", "kept"],
        )


def _mark(remove_at: float):
    """Every occurrence of a document's told terms as a span."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = []
            for text, base, told in zip(*(batch.column(name) for name in ("kept", "base", "told"))):
                told = {t["term"]: t["disclosure"] for t in told.as_py() or ()}
                spans = [(s["kind"], s["start"], s["stop"]) for s in base.as_py()] if told else []
                terms.append([
                    {"start": w["start"], "stop": w["stop"], "disclosure": told[w["term"]],
                     "action": "remove" if told[w["term"]] >= remove_at else "generalise"}
                    for w in _words(text.as_py() or "", spans) if w["term"] in told
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_digest"), batch.column("base"), pa.array(terms, _TERMS)],
                names=["doc_id", "_digest", "base", "terms"],
            )

    return mark


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Rows with a lot by ``by``; a key that very many rows have is dealt out by lots."""
    return rows.withColumn("lot", F.pmod(F.xxhash64(*by), F.lit(LOTS)).cast("int"))


def _in_all_lots(rows: DataFrame) -> DataFrame:
    return rows.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1))))


def _merged(rows: DataFrame, others: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that broadcasts neither side.

    All these tables grow with the corpus, and Spark takes the size of compressed files, and of
    rows before they go to all lots, for what the driver would have to hold.
    """
    return rows.join(others.hint("merge"), on, how)


def _told(scanned: DataFrame, texts: DataFrame, at: float, tables: Tables) -> DataFrame:
    """Of each text the terms that give one of its entities away: ``_digest, term, disclosure``.

    With counts of different texts n and N in all, a term tells
    PMI = log((n_et - 1/2) N / (n_e n_t)) about an entity of information log(N / n_e);
    ``disclosure`` is the one by the other. A text may come several times, once for an entity.
    """
    digests = tables.stored(scanned.groupBy("_digest").agg(F.count("*").alias("copies")), "pii_digests")
    total = float(max(digests.count(), 1))
    holding = scanned.filter(F.size("entities") > 0)
    held = tables.stored(
        holding.select("_digest", F.explode("entities").alias("entity")).distinct(), "pii_held"
    )
    terms = tables.stored(
        holding.select("_digest", F.explode("terms").alias("term")).distinct(), "pii_terms"
    )
    # Only texts that come several times have to move, so as to be counted once.
    repeated = digests.filter("copies > 1").select(key_hash(F.col("_digest")).alias("k"))
    texts = texts.select("_digest", "_text")
    maybe, once = parted(texts, key_hash(F.col("_digest")), bitmap(repeated, tables, "pii_repeated"))
    different = once.unionByName(maybe.dropDuplicates(["_digest"]))
    documents = tables.stored(_documents(different, terms, tables), "pii_documents")
    entities = tables.stored(
        held.groupBy("entity").agg(F.count("*").alias("n_e"), F.min("_digest").alias("_digest")), "pii_entities"
    )

    def disclosure(n_et, n_e, n_t):
        pmi = F.log2((n_et - CORRECTION) * total / (n_e * n_t))
        information = F.log2(F.lit(total) / n_e)
        return F.when(information > 0, pmi / information).otherwise(F.lit(0.0))

    # What one text holds stands with each of its words once, so no pairs need be counted.
    one = F.lit(1.0)
    telling = documents.withColumn("disclosure", disclosure(one, one, F.col("n_t")))
    telling = telling.filter(F.col("disclosure") >= at).select("term", "disclosure")
    alone = entities.filter("n_e = 1").select("_digest").distinct()
    by_one = _merged(
        _dealt(_merged(terms, alone, "_digest", "left_semi"), "_digest"), _in_all_lots(telling), ["term", "lot"]
    )

    recurring = entities.filter("n_e > 1").select("entity", "n_e")
    pairs = _merged(_dealt(held, "_digest"), _in_all_lots(recurring), ["entity", "lot"])
    pairs = tables.stored(pairs.select("_digest", "entity", "n_e"), "pii_recurring")
    pairs = _merged(terms, pairs, "_digest")
    together = pairs.groupBy("entity", "n_e", "term").agg(F.count("*").alias("n_et"))
    told = _merged(_dealt(together, "entity"), _in_all_lots(documents), ["term", "lot"])
    told = told.withColumn("disclosure", disclosure(F.col("n_et"), F.col("n_e"), F.col("n_t")))
    told = tables.stored(
        told.filter(F.col("disclosure") >= at).select("entity", "term", "disclosure"), "pii_told"
    )
    # Few pairs tell; the others do not cross.
    key = key_hash(F.col("entity"), F.col("term"))
    pairs = possible(pairs, key, bitmap(told.select(key.alias("k")), tables, "pii_told_bitmap"))
    by_many = _merged(_dealt(pairs, "_digest"), _in_all_lots(told), ["entity", "term", "lot"])
    columns = ["_digest", "term", "disclosure"]
    return by_one.select(columns).unionByName(by_many.select(columns))


def _documents(texts: DataFrame, terms: DataFrame, tables: Tables) -> DataFrame:
    """In how many texts each of ``terms`` stands: ``term, n_t``.

    Words that a bitmap of the terms rules out are gone before anything is added up, and what
    each task has added up is all that crosses, however many terms there are.
    """
    terms = tables.stored(terms.select("term").distinct(), "pii_wanted")
    wanted = bitmap(terms.select(key_hash(F.col("term")).alias("k")), tables, "pii_wanted_bitmap")
    words = texts.select(F.explode(F.array_distinct(alnum_words(F.col("_text")))).alias("term"))
    counted = possible(words, key_hash(F.col("term")), wanted).groupBy("term").agg(F.count("*").alias("n_t"))
    return _merged(counted, terms, "term", "left_semi")


def find_pii(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    generalise_at: float = GENERALISE_AT,
    remove_at: float = REMOVE_AT,
) -> DataFrame:
    """Spans of every whole text: ``doc_id, _digest, base, terms``.

    ``base`` has kind, start and stop (code points, end exclusive) of emails, IP addresses,
    cards and phone numbers. These, and the domains of emails, are the protected entities. A
    word of a document gives one of its entities away when the corpus says so: of the entity's
    information the word tells ``generalise_at`` or more, counted over all documents. Every
    pair counts, however few documents hold it; half a document is taken off the count of
    those that hold both, so that below 16 different texts no single one says enough.
    ``terms`` has start, stop, action (``generalise`` or ``remove``) and disclosure of every
    such word, wherever in the document.

    Null and empty texts have no spans. Equal texts count as one document in the statistics,
    whatever their ids, and each row is returned. Other columns are not read.
    """
    texts = docs.select(
        F.col(doc_id).alias("_id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_digest"),
        F.col(text).alias("_text"),
    )
    kind = texts.schema["_id"].dataType.simpleString()
    with Tables() as tables:
        scanned = tables.stored(texts.mapInArrow(_scan, _SCAN.format(id=kind)), "pii_scan")
        told = _told(scanned, texts, generalise_at, tables)
        told = told.groupBy("_digest", "term").agg(F.max("disclosure").alias("disclosure")).groupBy(
            F.col("_digest").alias("_of")
        ).agg(F.collect_list(F.struct("term", "disclosure")).alias("told"))
        told = tables.stored(told, "pii_disclosure")
        tables.keep(scanned, told)
    # Very many rows may have one text.
    holding = scanned.filter(F.size("entities") > 0)
    rows = holding.withColumn("lot", F.pmod(F.monotonically_increasing_id(), F.lit(LOTS)).cast("int"))
    found = _merged(
        rows, _in_all_lots(told).withColumnRenamed("lot", "_in"),
        (F.col("_digest") == F.col("_of")) & (F.col("lot") == F.col("_in")), "left",
    )
    schema = _MARKED.format(id=kind)
    marked = found.select("_id", "_digest", "base", "kept", "told").mapInArrow(_mark(remove_at), schema)
    none = F.array().cast(marked.schema["terms"].dataType)
    others = scanned.filter(F.size("entities") == 0)
    return marked.unionByName(
        others.select(F.col("_id").alias("doc_id"), "_digest", "base", none.alias("terms"))
    )


def span_text(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    return F.array_join(one, ",")


def count_kind(base: Column, kind: str) -> Column:
    return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")


def _clean(text: str | None, base, terms) -> str | None:
    """The text with entities and generalised terms as tags and removed terms gone."""
    if text is None:
        return None
    cuts = [(s["start"], s["stop"], f"[{s['kind'].upper()}]") for s in base]
    cuts += [(s["start"], s["stop"], "[TERM]" if s["action"] == "generalise" else "") for s in terms]
    parts, at = [], 0
    for start, stop, tag in sorted(cuts):
        if start < at:  # inside a span that has gone already; its rest goes too
            at = max(at, stop)
            continue
        parts += [text[at:start], tag]
        at = stop
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with what :func:`find_pii` finds replaced by tags or removed; all columns stay."""
    found = find_pii(docs, doc_id=doc_id, text=text, **how).select(
        F.col("doc_id").alias("_found_id"), F.col("_digest").alias("_found_digest"), "base", "terms"
    ).toDF("_found_id", "_found_digest", "_base", "_terms")
    found = found.filter((F.size("_base") > 0) | (F.size("_terms") > 0)).dropDuplicates(
        ["_found_id", "_found_digest"]
    )
    same = own(doc_id).eqNullSafe(F.col("_found_id")) & (
        F.md5(F.coalesce(own(text), F.lit(""))) == F.col("_found_digest")
    )

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
        return pd.Series([_clean(*row) for row in zip(texts, base, terms)], dtype="object")

    none = F.array().cast(found.schema["_base"].dataType), F.array().cast(found.schema["_terms"].dataType)
    joined = wrapped(docs).join(found, same, "left")
    new = F.when(F.col("_base").isNull(), own(text)).otherwise(
        cleaned(own(text), F.coalesce("_base", none[0]), F.coalesce("_terms", none[1]))
    )
    return joined.select(*[(new if name == text else own(name)).alias(name) for name in docs.columns])
