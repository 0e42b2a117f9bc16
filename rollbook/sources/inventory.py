"""File listings as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per data file at any depth below ``root``.

    Columns ``path, name, parent, length, modification_time``. As in every Spark
    reader, files without a byte and names that start with ``_`` or ``.`` are left
    out. No file content is read. Sizes per folder are a ``groupBy("parent")``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.regexp_replace("path", "/[^/]*$", "").alias("parent"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )
