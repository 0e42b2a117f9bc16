"""File writers. Both replace what the path held."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rollbook.names import column_of


def write_parquet(df: DataFrame, path: str | None) -> None:
    """Write Parquet; without a path nothing is written and nothing runs."""
    if path:
        df.write.mode("overwrite").parquet(path)


def write_text(df: DataFrame, path: str, column: str | None = None) -> None:
    """Write one string column as text, a line per row.

    A value that holds line breaks becomes as many lines.
    ``column`` may be left out where ``df`` has just one.
    """
    text = df if column is None else df.select(column_of(df, column))
    text.write.mode("overwrite").text(path)
