"""File readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet file or folder."""
    return spark.read.parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    """Read an ORC file or folder."""
    return spark.read.orc(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read comma-separated text with a header line.

    Without a schema the types are inferred from all rows, which reads the
    whole input once more before the query starts. Pass a schema (a
    ``StructType`` or a DDL string) for large inputs.
    """
    if schema is None:
        return spark.read.csv(path, header=True, sep=",", inferSchema=True)
    return spark.read.csv(path, header=True, sep=",", schema=schema)


def read_text(spark: SparkSession, path: str, wholetext: bool = False) -> DataFrame:
    """Read text into one string column ``value``: a row per line, or per file.

    A file read with ``wholetext`` is a single row and cannot be split over
    tasks, so leave it off for large files.
    """
    return spark.read.text(path, wholetext=wholetext)
