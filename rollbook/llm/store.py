"""Tables that an operator writes only to read back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import hadoop_file, scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read again.

    Cuts lineage: a lost executor costs its running tasks, never what was written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Tables:
    """Owner of written tables: they go when it is left, be it by an error, but for what it keeps.

    ``with Tables() as tables:``, then ``tables.stored`` as :func:`stored`. What is returned to a
    caller must be kept, or read nothing that is not.
    """

    def __init__(self):
        self._paths: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error) -> None:
        self.drop(*[df for df, _ in self._paths])

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(df.sparkSession, label)
        # Owned before it is written, so that a failed write goes too.
        self._paths.append((df, path))
        df.write.parquet(path)
        found = df.sparkSession.read.schema(df.schema).parquet(path)
        self._paths[-1] = found, path
        return found

    def drop(self, *tables: DataFrame) -> None:
        """Delete these now, as their last reader is done."""
        for df, path in [pair for pair in self._paths if any(pair[0] is t for t in tables)]:
            file_system, location = hadoop_file(df.sparkSession, path)
            file_system.delete(location, True)
        self.keep(*tables)

    def keep(self, *tables: DataFrame) -> None:
        """Leave these where they are until the application ends."""
        self._paths = [pair for pair in self._paths if not any(pair[0] is t for t in tables)]


def literal_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A bounded list of rows from the driver as a DataFrame, without Python on executors."""
    text = json.dumps([list(row) for row in rows])
    names = [field.split()[0] for field in schema.split(", ")]
    objects = json.dumps([dict(zip(names, row, strict=True)) for row in json.loads(text)])
    typed = ", ".join(field.replace(" ", ": ", 1) for field in schema.split(", "))
    parsed = F.from_json(F.lit(objects), f"array<struct<{typed}>>")
    return spark.range(1).select(F.inline(parsed))


#: Copies of a row that one array counts.
COPIES = 1 << 16


def rows_again(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its column ``copies`` says; the column goes.

    Copies are counted by the thousands first and then one by one, so that no array is long.
    """
    some = df.filter(F.col(copies) > 0)
    last = F.floor((F.col(copies) - 1) / COPIES)
    some = some.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    own = F.least(F.lit(COPIES).cast("long"), F.col(copies) - F.col("_part") * COPIES)
    again = F.explode(F.sequence(F.lit(1).cast("long"), own))
    return some.withColumn(copies, again).drop(copies, "_part")


def row_key(*columns: str) -> list:
    """Null-safe key of a row: an id that may be null or repeated, and its text's digest."""
    identity, text = columns
    return [F.col(identity).alias("_id"), F.md5(F.col(text)).alias("_digest")]


def wrapped(df: DataFrame) -> DataFrame:
    """Each row as one struct ``_row``, so that added columns clash with none of its own."""
    return df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("_row"))


def own(name: str):
    """A column of a wrapped row."""
    return F.col("_row").getField(name)
