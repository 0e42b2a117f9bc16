"""Customer and cell tables derived from the order and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consumer(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A customer per order, cancelled on its latest ship date.

    Columns ``consumer_id, builddate, sgstatus, canceldate``.
    """
    shipped = lineitem.groupBy(F.col("l_orderkey").alias("consumer_id")).agg(
        F.max("l_shipdate").alias("canceldate")
    )
    status = F.when(F.col("o_orderstatus") == "F", "9").when(F.col("o_orderstatus") == "O", "1")
    built = orders.select(
        F.col("o_orderkey").alias("consumer_id"),
        F.col("o_orderdate").alias("builddate"),
        status.alias("sgstatus"),
    )
    return built.join(shipped, "consumer_id", "left")


def cells(events: DataFrame) -> DataFrame:
    """Cells of each event, in one pass: rows lack some, and some have several versions.

    Among the versions are ties of ``ts`` and null ones.
    """
    kind = F.col("event_type")

    def cell(family, qualifier, ts, value):
        return F.struct(
            F.lit(family).alias("family"),
            F.lit(qualifier).alias("qualifier"),
            F.lit(ts).cast("bigint").alias("ts"),
            value.cast("string").alias("value"),
        )

    possible = F.array(
        cell("meta", "type", 0, kind),
        F.when(kind != "error", cell("meta", "user", 0, F.col("user_id"))),
        F.when(kind == "click", cell("meta", "user", 1, F.col("user_id") + 1000)),
        F.when(kind == "click", cell("meta", "user", None, F.col("user_id") + 2000)),
        F.when(kind == "signup", cell("meta", "user", 0, F.col("user_id") + 500)),
        F.when(kind == "signup", cell("flag", "late", 0, F.lit("1"))),
        F.when(kind == "error", cell("flag", "late", None, F.lit("0"))),
    )
    row_key = F.col("event_id").cast("string").alias("row_key")
    return events.select(row_key, F.inline(possible)).filter("family IS NOT NULL")
