"""Which rows may have one of some keys, told by a bitmap before any row is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Tables

#: Bits of the bitmap, in words of 64; there are at most BITS / 64 words, some 8 MB, of any keys.
BITS = 1 << 24


def key_hash(*columns: Column) -> Column:
    return F.xxhash64(*columns)


def bitmap(keys: DataFrame, tables: Tables, label: str) -> DataFrame:
    """``word, bits`` of the hashes in ``keys`` (one column)."""
    place = F.pmod(F.col(keys.columns[0]), F.lit(BITS))
    bit = F.expr("shiftleft(1L, cast(_place % 64 as int))")
    words = keys.select(place.alias("_place")).groupBy(F.floor(F.col("_place") / 64).cast("long").alias("word"))
    return tables.stored(words.agg(F.bit_or(bit).alias("bits")), label)


def _marked(rows: DataFrame, hashed: Column, words: DataFrame, how: str) -> DataFrame:
    return rows.withColumn("_place", F.pmod(hashed, F.lit(BITS))).join(
        F.broadcast(words.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))),
        F.floor(F.col("_place") / 64).cast("long") == F.col("_word"), how,
    )


def _is_set() -> Column:
    is_set = F.expr("(shiftrightunsigned(_bits, cast(_place % 64 as int)) & 1L) = 1L")
    return F.coalesce(is_set, F.lit(False))


_INNER = ("_place", "_word", "_bits")


def possible(rows: DataFrame, hashed: Column, words: DataFrame) -> DataFrame:
    """Rows whose hash may be among the keys; the words are broadcast, so no row moves."""
    return _marked(rows, hashed, words, "inner").filter(_is_set()).drop(*_INNER)


def possibly(rows: DataFrame, hashed: Column, words: DataFrame) -> DataFrame:
    """All rows, and in ``_maybe`` whether their hash may be among the keys."""
    return _marked(rows, hashed, words, "left").withColumn("_maybe", _is_set()).drop(*_INNER)


def parted(rows: DataFrame, hashed: Column, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose hash may be among the keys, and those whose hash is certainly not.

    The more keys there are, the more other rows pass for possible ones; what is certain is
    always right.
    """
    others = _marked(rows, hashed, words, "left").filter(~_is_set()).drop(*_INNER)
    return possible(rows, hashed, words), others
