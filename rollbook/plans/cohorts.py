"""Customer counts.

A customer table has ``builddate``, ``sgstatus`` and ``canceldate``; status
``'9'`` is cancelled. The dates may be timestamps, or text written
``yyyy-MM-dd HH:mm:ss``.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

from rollbook.sinks.writers import write_parquet
from rollbook.sources.readers import read_parquet

# The cancelled status, and the dates counted when none are given.
CANCELLED = "9"
DEFAULT_BEGIN = "2020-02-26 00:00:00"
DEFAULT_END = "2020-03-26 00:00:00"

Instant = str | datetime.date | datetime.datetime


def _moment(value: Instant) -> datetime.datetime:
    if isinstance(value, str):
        value = datetime.datetime.fromisoformat(value)
    elif not isinstance(value, datetime.datetime):
        value = datetime.datetime.combine(value, datetime.time())
    if value.tzinfo is not None:
        raise ValueError(f"{value} has a time zone; dates of customers have none")
    return value


def _literal(value: Instant, data_type: DataType) -> Column:
    """``value`` in the column's own type, so that the column needs no cast and the
    comparison can be pushed down to the scan."""
    text = F.lit(_moment(value).isoformat(sep=" "))
    if isinstance(data_type, StringType):
        return text
    if isinstance(data_type, TimestampType):
        return text.cast(data_type)
    return text.cast(TimestampNTZType())


def _type_of(df: DataFrame, column: str) -> DataType:
    return df.select(column).schema[0].dataType


def active_as_of(cutoff: Instant, data_type: DataType = TimestampNTZType()) -> Column:
    """Not cancelled, or cancelled at or after the cutoff.

    ``data_type`` is the type of ``canceldate``. The second status test is not
    redundant: a customer of unknown status is never active, whenever it was cancelled.
    """
    status = F.col("sgstatus")
    kept = F.col("canceldate") >= _literal(cutoff, data_type)
    return (status != CANCELLED) | ((status == CANCELLED) & kept)


def total_users(df: DataFrame, cutoff: Instant = DEFAULT_END) -> DataFrame:
    """``total_users``: customers built before the cutoff and active as of it."""
    built = F.col("builddate") < _literal(cutoff, _type_of(df, "builddate"))
    active = active_as_of(cutoff, _type_of(df, "canceldate"))
    return df.filter(built & active).agg(F.count("*").alias("total_users"))


def new_users(
    df: DataFrame, begin: Instant = DEFAULT_BEGIN, end: Instant = DEFAULT_END
) -> DataFrame:
    """``new_users``: customers built in ``[begin, end)`` and active as of ``end``."""
    if not begin or not end:
        raise ValueError("both begin and end are needed")
    if _moment(begin) >= _moment(end):
        raise ValueError(f"begin {begin} is not before end {end}")
    data_type = _type_of(df, "builddate")
    built = (F.col("builddate") >= _literal(begin, data_type)) & (
        F.col("builddate") < _literal(end, data_type)
    )
    active = active_as_of(end, _type_of(df, "canceldate"))
    return df.filter(built & active).agg(F.count("*").alias("new_users"))


def new_users_between(
    spark: SparkSession, table: str, begin: Instant, end: Instant, output: str | None = None
) -> DataFrame:
    """The job around :func:`new_users`: from a catalog table to the column ``xzyhs``.

    With an output path the count runs once, is written there, and the result
    reads what was written.
    """
    counted = new_users(spark.table(table), begin, end).withColumnRenamed("new_users", "xzyhs")
    if not output:
        return counted
    write_parquet(counted, output)
    return read_parquet(spark, output)
