"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Tables

#: Lots that the rows of one key are dealt to, as a node may have very many edges.
LOTS = 16


def met(rows: DataFrame, key: str, by_key: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``by_key`` (``of`` and a value), in which every key has one row.

    The rows of a key are dealt to lots, each of which gets its value, so that no task has all.
    """
    lots = by_key.withColumn("_lot", F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1))))
    dealt = rows.withColumn("_at", F.pmod(F.xxhash64(*rows.columns), F.lit(LOTS)).cast("int"))
    return dealt.join(lots, (F.col(key) == F.col("of")) & (F.col("_at") == F.col("_lot")), how).drop(
        "_at", "_lot", "of"
    )


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """``node, label`` for the nodes of ``edges`` (a, b): the smallest node of each component.

    Each round a node takes the smallest label around it and then its label's label, so that
    the way to the smallest node halves. Rounds are written, so lineage stays short; they end
    when none changes a label.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = tables.stored(both.filter("a <> b").distinct(), "graph_edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
        "node", F.least("node", "near").alias("label")
    )
    held = tables.stored(labels, "graph_labels")
    while True:
        labels = held.select("node", "label")
        around = met(both, "b", labels.withColumnRenamed("node", "of"))
        around = around.groupBy(F.col("a").alias("around")).agg(F.min("label").alias("near"))
        nearer = labels.join(around, F.col("node") == F.col("around")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        # A label is a node of the same component, so its own label is one too.
        end = labels.select(F.col("node").alias("of"), F.col("label").alias("end"))
        jumped = met(nearer, "label", end).select("node", "old", F.least("label", "end").alias("label"))
        jumped = tables.stored(jumped, "graph_labels")
        tables.drop(held)
        held = jumped
        if jumped.filter("old <> label").isEmpty():
            tables.drop(both)
            return jumped.select("node", "label")


def joined(labels: DataFrame, edges: DataFrame, tables: Tables) -> DataFrame:
    """``labels`` of :func:`components` with more ``edges`` (a, b), which join components.

    Only the graph of components and new nodes is gone through.
    """
    by_node = labels.select(F.col("node").alias("of"), "label")
    for side in ("a", "b"):
        edges = met(edges, side, by_node, "left").select(
            F.coalesce("label", side).alias(side), *(name for name in ("a", "b") if name != side)
        )
    merged = components(edges, tables)
    again = met(labels, "label", merged.select(F.col("node").alias("of"), F.col("label").alias("new")), "left")
    fresh = merged.join(labels.select("node"), "node", "left_anti")
    return tables.stored(
        again.select("node", F.coalesce("new", "label").alias("label")).unionByName(fresh), "graph_joined"
    )
