"""Catalog tables: projected reads and the row-count report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "database string, table string, rows bigint"


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def read_table(
    spark: SparkSession, db: str, table: str, columns: str | Sequence[str] | None
) -> DataFrame:
    """Project a catalog table.

    ``columns`` is a SQL select list, as one text or one item per expression;
    expressions and aliases work. Without columns the result is the report of
    :func:`table_row_counts` instead of the table.
    """
    if not columns:
        return table_row_counts(spark)
    select_list = columns if isinstance(columns, str) else ", ".join(columns)
    return spark.sql(f"SELECT {select_list} FROM {_quoted(db, table)}")


def _table_names(spark: SparkSession, db: str) -> list[str]:
    # SHOW TABLES asks the metastore for names only; listTables would fetch
    # every table's details. Temporary views of the session show up in it too.
    shown = spark.sql(f"SHOW TABLES IN {_quoted(db)}").collect()
    return sorted(row["tableName"] for row in shown if not row["isTemporary"])


def _unquoted(name: str) -> str:
    # Spark quotes a database name in its lists where SQL needs it quoted.
    if len(name) > 1 and name[0] == name[-1] == "`":
        return name[1:-1].replace("``", "`")
    return name


def _chosen(names: list[str], wanted: Sequence[str] | None) -> list[str]:
    """Those of ``names`` that are wanted; a catalog's names ignore case."""
    if wanted is None:
        return names
    lower = {name.lower() for name in wanted}
    return [name for name in names if name.lower() in lower]


def table_row_counts(
    spark: SparkSession, databases: Sequence[str] | None = None, tables: Sequence[str] | None = None
) -> DataFrame:
    """Report ``database, table, rows`` for every table of the catalog.

    All tables are counted by one job; a filter on ``database`` or ``table`` removes
    the other tables from the plan before anything is read. Tables are looked up, and
    their files listed, on the driver before a filter can act; with ``databases`` or
    ``tables`` only those by these names are, and of other databases not even the names.
    """
    shown = spark.sql("SHOW DATABASES").collect()
    found = sorted(_unquoted(row["namespace"]) for row in shown)
    counts = [
        spark.table(_quoted(db, table))
        .agg(F.count("*").alias("rows"))
        .select(F.lit(db).alias("database"), F.lit(table).alias("table"), "rows")
        for db in _chosen(found, databases)
        for table in _chosen(_table_names(spark, db), tables)
    ]
    if not counts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    # Union in pairs: a chain over thousands of tables would nest as deep.
    while len(counts) > 1:
        paired = [a.unionByName(b) for a, b in zip(counts[::2], counts[1::2])]
        counts = paired + counts[2 * len(paired) :]
    return counts[0]
