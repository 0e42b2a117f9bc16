"""Copy a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rollbook.sinks.writers import write_parquet
from rollbook.sources.router import load_source, source_text


def copy_dataset(
    spark: SparkSession,
    source: str,
    output: str | None,
    columns: str | Sequence[str] | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Load what ``source`` holds and write it to ``output`` as Parquet.

    ``source`` is a folder or Parquet file of data, or a file that holds a source
    descriptor or a path. ``columns`` and ``cells`` are as in
    :func:`~rollbook.sources.router.load_source`. Without ``output`` nothing is written. Returns the
    loaded data.
    """
    loaded = load_source(spark, source_text(spark, source), columns, cells)
    write_parquet(loaded, output)
    return loaded
