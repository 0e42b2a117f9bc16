"""Numbers for rows that are equal in all that an operator goes by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

#: Groups with more than one in this many rows are numbered; there are fewer such groups than this.
HOT = 1000
#: Bits of a row's number within its partition in ``monotonically_increasing_id``.
WITHIN = 33


def told_apart(rows: DataFrame, *keys: Column) -> DataFrame:
    """``rows`` with ``_number``: rows equal in all ``keys`` are told apart where they are very many.

    The rows of a group that holds over a thousandth of all are numbered 0, 1, 2 without gaps;
    which of them gets which number is open, that each is given once is not. All others have
    number 0 where they are. The groups, fewer than a thousand, go to all tasks. Their rows are
    written once, numbered within their partition of that table, and moved on by what earlier
    partitions hold, so that no task gets all of one group, be it a third of the table.
    """
    hashed = F.xxhash64(*keys)
    counted = rows.select(hashed.alias("_group")).groupBy("_group").agg(F.count("*").alias("_n"))
    counted = stored(counted.filter("_n > 1"), "repeats")
    if counted.isEmpty():
        return rows.withColumn("_number", F.lit(0).cast("long"))
    total = rows.count()
    hot = counted.filter(F.col("_n") * HOT > total).select(F.col("_group").alias("_of"))
    hot = stored(hot, "repeats_hot")
    if hot.isEmpty():
        return rows.withColumn("_number", F.lit(0).cast("long"))
    marked = rows.withColumn("_group", hashed)
    same = F.col("_group") == F.col("_of")
    held = marked.join(F.broadcast(hot), same, "left_semi")
    held = stored(held.withColumn("_at", F.monotonically_increasing_id()), "repeats_rows")
    held = held.withColumn("_part", F.shiftright("_at", WITHIN))
    parts = held.groupBy(F.col("_group").alias("_of"), F.col("_part").alias("_in")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_of", "_in", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_group", "_part").orderBy("_at")) - 1
    numbered = held.withColumn("_local", local).join(
        stored(parts, "repeats_parts"), same & (F.col("_part") == F.col("_in"))
    )
    others = marked.join(F.broadcast(hot), same, "left_anti")
    return others.select(*rows.columns, F.lit(0).cast("long").alias("_number")).unionByName(
        numbered.select(*rows.columns, (F.col("_local") + F.col("_before")).cast("long").alias("_number"))
    )
