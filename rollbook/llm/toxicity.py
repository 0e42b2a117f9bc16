"""Toxicity by compression distance: which of two zstandard dictionaries fits a window better.

The ordinary dictionary is trained on the windows of ordinary texts. The toxic one has, before the
same content, windows of toxic texts that the ordinary one serves badly and that recur. They are
found by compression: windows of one word of either half of the toxic texts are compressed with a
dictionary of the other half's most frequent ones, and those that save more than nearly all windows
of ordinary texts do stay; dictionaries are made of those and the windows compressed again. What
ordinary texts hold nearly as often goes to both dictionaries, so that it tells nothing.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .jaccard_join import linked, shingles

#: Labelled rows of each class that a model is fitted on at most, chosen by hash, and their bytes.
FIT_ROWS, FIT_BYTES = 2500, 16 << 20
#: Near copies share this percentage or more of their shingles of so many words; one is fitted on.
NEAR_WORDS, NEAR_PERCENT = 5, 80
WINDOW = 8
THRESHOLD = 0.7
LEVEL = 9
#: Bytes of the content trained on ordinary windows, of that of toxic ones, of that of shared
#: ones, and of the content that one half of the toxic texts makes for the other.
BASE_BYTES, CLASS_BYTES, SHARED_BYTES, HALF_BYTES = 32 << 10, 8 << 10, 16 << 10, 32 << 10
ROUNDS = 2
#: Share of ordinary windows that save less than a toxic window has to.
CHANCE = 0.98
#: Ordinary windows that this share is taken of, chosen by chance.
ORDINARY_WINDOWS = 48_000
#: A window tells of toxic texts when their share with it is this many times the ordinary ones'.
TELLING = 32
#: Share of the toxic texts that such a window has to be in.
RECURRING = 0.01
#: zstandard finds no match in the last bytes of its input, and leaves short input as it is, so
#: each window ends in these, which cost all windows the same.
TAIL = b"\n" * 64


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _windows(words: list[bytes]) -> list[bytes]:
    return [piece + TAIL for piece in _pieces(words, WINDOW)]


def _pieces(words: list[bytes], size: int) -> list[bytes]:
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, max(1, len(words)), size)]


def _compressor(content: bytes):
    data = zstandard.ZstdCompressionDict(TAIL + content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False,
        write_dict_id=False,
    )


def _dictionary(size: int, samples: list[bytes], **parameters) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, **parameters).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries and the weights that turn their differences into a probability."""

    ordinary: bytes
    toxic: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]

    def scorer(self):
        ordinary, toxic = _compressor(self.ordinary), _compressor(self.toxic)
        centre, scale = np.array(self.centre), np.array(self.scale)
        weights = np.array(self.weights)

        def score(text: str | None) -> float:
            found = (_features(_gains(_words(text), ordinary, toxic)) - centre) / scale
            return float(1 / (1 + np.exp(-np.clip(weights[0] + found @ weights[1:], -30, 30))))

        return score


def _gains(words: list[bytes], ordinary, toxic) -> np.ndarray:
    """Bytes that the toxic dictionary saves over the ordinary one, by window."""
    return np.array([
        len(ordinary.compress(window)) - len(toxic.compress(window)) for window in _windows(words)
    ])


def _features(gains: np.ndarray) -> np.ndarray:
    return np.array([gains.mean(), min(gains.max(), 12), (gains >= 3).mean()])


def _most_frequent(pieces: Counter, size: int) -> bytes:
    """The pieces that come most often, the most frequent last, in ``size`` bytes."""
    content = b""
    for piece, _ in sorted(pieces.items(), key=lambda item: (-item[1], item[0])):
        if len(content) + len(piece) > size:
            break
        content = piece + content
    return content


def _costs(content: bytes, pieces: list[bytes]) -> np.ndarray:
    compressor = _compressor(content)
    return np.array([len(compressor.compress(piece + TAIL)) for piece in pieces], np.int64)


def _words_of(docs: list[list[bytes]]) -> Counter:
    """How often each window of one word comes."""
    return Counter(piece for doc in docs for piece in (b" " + word + b" " for word in doc))


def _telling(toxic: list[list[bytes]], ordinary: list[list[bytes]], base: bytes) -> Counter:
    """In how many toxic texts each window stands that a dictionary of other toxic texts serves better."""
    halves = toxic[::2], toxic[1::2]
    counts = [_words_of(half) for half in halves]
    names = [sorted(count) for count in counts]
    null = _words_of(ordinary)
    others = sorted(null)
    if null.total() > ORDINARY_WINDOWS:
        share = np.array([null[piece] for piece in others]) / null.total()
        others = [others[n] for n in np.random.default_rng(1).choice(len(others), ORDINARY_WINDOWS, p=share)]
    else:
        others = sorted(null.elements())
    null_before = _costs(base, others)
    before = [_costs(base, own) for own in names]
    kept = [set(own) for own in names]
    for _ in range(ROUNDS):
        chosen = []
        for part in (0, 1):
            rest = Counter({piece: counts[1 - part][piece] for piece in kept[1 - part]})
            content = _most_frequent(rest, HALF_BYTES) + base
            saved = before[part] - _costs(content, names[part])
            by_chance = null_before - _costs(content, others)
            least = max(1.0, np.quantile(by_chance, CHANCE) if len(others) else 1.0)
            chosen.append({names[part][n] for n in np.flatnonzero(saved >= least)})
        if chosen == kept:
            break
        kept = chosen
    return Counter(
        piece for part in (0, 1) for doc in halves[part]
        for piece in {b" " + word + b" " for word in doc} & kept[part]
    )


def _logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge, so that separable classes converge too."""
    x = np.hstack([np.ones((len(features), 1)), features])
    weights, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [0.05] * features.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ (labels - p) - ridge @ weights)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _contents(docs: list[list[bytes]], labels: np.ndarray) -> tuple[bytes, bytes]:
    """Dictionary contents for ordinary and toxic text.

    Both end with what is trained on ordinary windows and with what either class holds, so that
    only what tells of toxic text costs them differently.
    """
    toxic = [doc for doc, label in zip(docs, labels) if label]
    ordinary = [doc for doc, label in zip(docs, labels) if not label]
    base = _dictionary(BASE_BYTES, [piece for doc in ordinary for piece in _pieces(doc, WINDOW)])
    found = _telling(toxic, ordinary, base)
    also = Counter(piece for doc in ordinary for piece in {b" " + word + b" " for word in doc} & found.keys())
    shared = Counter({
        piece: also[piece] for piece, n in found.items()
        if n * len(ordinary) < TELLING * also[piece] * len(toxic)
    })
    own = Counter({piece: n for piece, n in found.items() if piece not in shared and n >= max(2, RECURRING * len(toxic))})
    base = _most_frequent(shared, SHARED_BYTES) + base
    return base, _most_frequent(own, CLASS_BYTES) + base


def _once(texts: list[str | None]) -> list[int]:
    """Numbers of the texts that are no near copy of one before them.

    Candidates share one of eight minimum hashes; whether they are near copies is then compared
    by all their shingles. Texts without words are all kept.
    """
    holders: dict[tuple[int, int], list[int]] = {}
    sets, chosen = [], []
    for n, text in enumerate(texts):
        found = shingles(text, NEAR_WORDS)
        sets.append(found)
        keys = [
            (turn, int((found * np.uint64(2 * turn + 0x9E3779B97F4A7C15)).min()))
            for turn in range(8 if len(found) else 0)
        ]
        near = {other for key in keys for other in holders.get(key, ())}
        if not any(linked(found, sets[other], NEAR_PERCENT) for other in near):
            chosen.append(n)
            for key in keys:
                holders.setdefault(key, []).append(n)
    return chosen


def fit_texts(texts: list[str | None], labels: list[int]) -> ToxicityModel:
    """A model from labelled texts.

    Of near copies only the first counts, as a group of them would make any of its words recur.
    The thresholds are calibrated on each half of the texts with dictionaries trained on the
    other half; the model's own dictionaries are trained on all.
    """
    chosen = _once(texts)
    same: dict[bytes, bytes] = {}  # each word is held once
    docs = [[same.setdefault(word, word) for word in _words(texts[n])] for n in chosen]
    y = np.array([labels[n] for n in chosen], dtype=int)
    half = np.zeros(len(y), dtype=int)
    for label in (0, 1):
        half[y == label] = np.arange((y == label).sum()) % 2
    if min((y == 1).sum(), (y == 0).sum()) < 2:
        share = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        prior = math.log(share / (1 - share))
        return ToxicityModel(b"", b"", (0, 0, 0), (1, 1, 1), (prior, 0, 0, 0))
    found = np.zeros((len(y), 3))
    for part in (0, 1):
        trained = half != part
        chosen = [doc for doc, one in zip(docs, trained) if one]
        compressors = [_compressor(c) for c in _contents(chosen, y[trained])]
        for n in np.flatnonzero(~trained):
            found[n] = _features(_gains(docs[n], *compressors))
    ordinary, toxic = _contents(docs, y)
    centre, scale = found.mean(axis=0), found.std(axis=0) + 1e-9
    weights = _logistic((found - centre) / scale, y)
    return ToxicityModel(
        ordinary, toxic, tuple(map(float, centre)), tuple(map(float, scale)),
        tuple(map(float, weights)),
    )


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    fit_rows: int = FIT_ROWS,
    fit_bytes: int = FIT_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> ToxicityModel:
    """Fit on labelled rows that are not held out: of each class up to ``fit_rows``, ``fit_bytes``.

    The rows are those with the smallest hashes of id and text, as long as their texts together
    are within the bytes; rows equal in both count once. One task gets them whole; the driver
    gets their ids, digests and sizes, and the model. Of near copies among them (80 % or more of
    their five-word shingles) one is fitted on. Rows without id or label are left out; of several
    labels of a document the largest counts, of several documents with its id all.
    """
    known = (
        labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("_label").alias("_label"))
    )
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(
        F.col(f"`{doc_id}`").alias("_id"), F.md5(content).alias("_digest"), content.alias("_text")
    )
    slim = texts.select("_id", "_digest", F.octet_length("_text").alias("_bytes")).join(known, "_id").distinct()
    order = F.xxhash64("_id", "_digest"), F.col("_id"), F.col("_digest")
    chosen = []
    for value in (0, 1):
        left = fit_bytes
        for row in slim.filter(F.col("_label") == value).orderBy(*order).limit(fit_rows).collect():
            if row["_bytes"] <= left:
                left -= row["_bytes"]
                chosen.append((row["_id"], row["_digest"], value))
    wanted = docs.sparkSession.createDataFrame(
        chosen, f"_id {texts.schema['_id'].dataType.simpleString()}, _digest string, _label int"
    )
    rows = texts.join(F.broadcast(wanted), ["_id", "_digest"]).dropDuplicates(["_id", "_digest"])
    rows = rows.select("_id", "_digest", "_label", "_text").repartition(1).sortWithinPartitions("_id", "_digest")
    found = rows.mapInArrow(
        _fitted, "ordinary binary, toxic binary, centre array<double>, scale array<double>, weights array<double>"
    ).first()
    if found is None:  # no task ran, as there are no rows
        return fit_texts([], [])
    return ToxicityModel(
        bytes(found["ordinary"]), bytes(found["toxic"]),
        *(tuple(found[name]) for name in ("centre", "scale", "weights")),
    )


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A model from the one task's rows, of which there are a bounded number."""
    texts, labels = [], []
    for batch in batches:
        texts += batch.column("_text").to_pylist()
        labels += batch.column("_label").to_pylist()
    numbers = pa.list_(pa.float64())
    schema = pa.schema([
        ("ordinary", pa.binary()), ("toxic", pa.binary()), ("centre", numbers), ("scale", numbers), ("weights", numbers),
    ])
    yield pa.RecordBatch.from_pylist([asdict(fit_texts(texts, labels))], schema)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Probability from 0 to 1 that a whole text is toxic; null and empty texts have one too."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for batch in batches:
            yield pd.Series([scorer(value) for value in batch], dtype="float64")

    return score(text)


def keep_ordinary(
    docs: DataFrame, model: ToxicityModel, *, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; columns and other rows stay."""
    return docs.filter(toxicity_score(model, F.col(f"`{text}`")) < threshold)
