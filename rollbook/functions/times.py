"""Time columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.names import column_of

# Fixed value: the format of times written as text.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def with_time_string(df: DataFrame, millis_col: str, out: str) -> DataFrame:
    """Add epoch milliseconds as text, to the second, in the session's time zone."""
    time = F.timestamp_millis(column_of(df, millis_col))
    return df.withColumn(out, F.date_format(time, SECOND_FORMAT))


def with_month_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """Add dates ``month_start`` and ``month_end``, the first and last day of the month."""
    date = column_of(df, date_col)
    return df.withColumns({"month_start": F.trunc(date, "MM"), "month_end": F.last_day(date)})
