"""Labelled and unlabelled feature vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.mllib.linalg import VectorUDT as OldVectorUDT
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from rollbook.names import column_of


def _number_and_vector(df: DataFrame, number: str, name: str, features: str) -> DataFrame:
    pair = df.select(
        column_of(df, number).cast("double").alias(name), column_of(df, features).alias("features")
    )
    data_type = pair.schema["features"].dataType
    if isinstance(data_type, VectorUDT):
        return pair
    if isinstance(data_type, OldVectorUDT):
        return MLUtils.convertVectorColumnsToML(pair, "features")
    if isinstance(data_type, ArrayType):
        vector = array_to_vector(F.col("features").cast("array<double>"))
        return pair.withColumn("features", F.when(F.col("features").isNotNull(), vector))
    raise TypeError(f"column {features} is {data_type.simpleString()}, not a vector or an array")


def labeled_points(df: DataFrame, label: str, features: str) -> DataFrame:
    """``label double, features vector`` from a number and an array or vector column."""
    return _number_and_vector(df, label, "label", features)


def unlabeled_vectors(df: DataFrame, id: str, features: str) -> DataFrame:
    """``id double, features vector`` from a number and an array or vector column."""
    return _number_and_vector(df, id, "id", features)
