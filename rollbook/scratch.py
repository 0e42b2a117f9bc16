"""Where jobs put tables they write only to read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def hadoop_file(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and ``path`` as it knows it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, under the folder all executors share.

    That folder is the session's ``spark.checkpoint.dir``, or its warehouse where that
    is unset. What the application wrote there goes when it ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    folder = f"{shared.rstrip('/')}/rollbook-{spark.sparkContext.applicationId}"
    file_system, location = hadoop_file(spark, folder)
    if not file_system.exists(location):
        file_system.mkdirs(location)
        file_system.deleteOnExit(location)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a path of :func:`scratch_path` and read again."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
