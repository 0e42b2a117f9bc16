"""Columns by the names a table has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exactly(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_of(df: DataFrame, name: str) -> Column:
    """The column of ``df`` by that name; a name that no column has is a path into a struct."""
    return exactly(name) if name in df.columns else F.col(name)
