"""Schema edits."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.names import exactly


def _some_value(data_type: T.DataType) -> Column | None:
    """Any non-null value of the type, or None where SQL has none, as of vectors."""
    if isinstance(data_type, T.StructType):
        fields = {f.name: _some_value(f.dataType) for f in data_type}
        if any(value is None for value in fields.values()):
            return None
        return F.struct(*[value.alias(name) for name, value in fields.items()])
    if isinstance(data_type, T.ArrayType):
        value = _some_value(data_type.elementType)
        return None if value is None else F.array(value)
    if isinstance(data_type, T.MapType):
        pair = _some_value(data_type.keyType), _some_value(data_type.valueType)
        return None if any(part is None for part in pair) else F.create_map(*pair)
    if isinstance(data_type, T.DecimalType):
        return F.lit(Decimal(0)).cast(data_type)
    if isinstance(data_type, T.TimestampNTZType):
        return F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    if isinstance(data_type, T.TimestampType):
        return F.expr("timestamp'1970-01-01 00:00:00'")
    if isinstance(data_type, T.DateType):
        return F.lit(datetime.date(1970, 1, 1))
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    if isinstance(data_type, T.NumericType):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.BinaryType):
        return F.lit(b"")
    if isinstance(data_type, T.DayTimeIntervalType):
        return F.expr("INTERVAL '0' DAY").cast(data_type)
    if isinstance(data_type, T.YearMonthIntervalType):
        return F.expr("INTERVAL '0' MONTH").cast(data_type)
    if isinstance(data_type, T.VariantType):
        return F.parse_json(F.lit("null"))
    return None


def set_nullable(df: DataFrame, column: str, nullable: bool) -> DataFrame:
    """Set whether a column may hold null, keeping its type and metadata.

    The name must match exactly, case included; with an unknown name ``df`` comes
    back as it is. A null in a column made not nullable fails the query that
    reads the column. A query that does not read it, such as a bare ``count()``,
    does not check it, unless the column's type has no literal in SQL: vectors, and what
    holds them, are checked by every query.
    """
    field = next((f for f in df.schema if f.name == column), None)
    if field is None or field.nullable == nullable:
        return df
    value = exactly(column)
    if nullable:
        return df.withColumn(column, F.when(value.isNotNull(), value).alias(column, metadata=field.metadata))
    stop = F.raise_error(F.lit(f"null in column {column}, which is not nullable"))
    some = _some_value(field.dataType)
    if some is None:
        return _unpacked(df, field, F.when(value.isNull(), stop).otherwise(value))
    checked = F.when(value.isNull(), stop.cast(field.dataType)).otherwise(value)
    # The last argument is never reached; it only tells Spark the result is not null.
    edited = F.coalesce(checked, some)
    return df.withColumn(column, edited.alias(column, metadata=field.metadata))


def _unpacked(df: DataFrame, field: T.StructField, checked: Column) -> DataFrame:
    """``df`` with ``checked`` in place of the column, by way of an array without nulls.

    What is exploded from such an array Spark knows to be never null, whatever its type.
    """
    packed = F.explode(F.array_compact(F.array(checked))).alias(field.name)
    columns = [packed if name == field.name else exactly(name) for name in df.columns]
    again = [
        exactly(name).alias(name, metadata=field.metadata) if name == field.name else exactly(name)
        for name in df.columns
    ]
    return df.select(*columns).select(*again)
