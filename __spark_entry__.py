"""What the driver runs: the flagship query, all queries, and the SQL that checks them.

Every query runs over whole tables of the given folder. Queries of readers and
writers first write a table of that folder to a scratch path.
"""

from __future__ import annotations

import importlib
import json
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import rollbook as rb
from rollbook import fixtures
from rollbook.scratch import scratch_path

def _if_present(name: str):
    """A module of the training-data operators, which may be absent; their own needs may not."""
    try:
        return importlib.import_module(name)
    except ImportError as missing:
        if missing.name not in ("rollbook.llm", "rollbook.llm.queries", "corpus_pipeline"):
            raise
        return None


llm_queries = _if_present("rollbook.llm.queries")
corpus_pipeline = _if_present("corpus_pipeline")

FLAGSHIP_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

Query = Callable[[SparkSession, str], DataFrame]


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return rb.read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _consumer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.consumer(_load(spark, sf_dir, "orders"), _load(spark, sf_dir, "lineitem"))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.cells(_load(spark, sf_dir, "events"))


def _register(spark: SparkSession, sf_dir: str, database: str, tables: list[str]) -> str:
    """A database of external tables over the given files; no data is copied.

    Its comment says which folder it is for, so that it is made once per folder.
    """
    if spark.catalog.databaseExists(database):
        if spark.catalog.getDatabase(database).description == sf_dir:
            return database
        spark.sql(f"DROP DATABASE {database} CASCADE")
    location = scratch_path(spark, database)
    spark.sql(f"CREATE DATABASE {database} COMMENT '{sf_dir}' LOCATION '{location}'")
    for table in tables:
        spark.catalog.createTable(
            f"{database}.{table}", path=f"{sf_dir}/{table}.parquet", source="parquet"
        )
    return database


def _descriptor(db_type: str, db: str, table: str) -> str:
    fields = {"nodeId": 1, "datasetId": "d", "ip": "", "port": 0}
    return json.dumps({**fields, "dbName": db, "tableName": table, "dbType": db_type})


def _underscored(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.replace(":", "_") for name in df.columns])


# Sources


def read_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.read_parquet(spark, f"{sf_dir}/events.parquet")


def read_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "read_orc")
    _load(spark, sf_dir, "orders").write.orc(path)
    return rb.read_orc(spark, path)


def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "read_csv")
    _load(spark, sf_dir, "customer").write.csv(path, header=True)
    return rb.read_csv(spark, path)


def read_csv_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "read_csv_with_schema")
    part = _load(spark, sf_dir, "part")
    part.write.csv(path, header=True)
    return rb.read_csv(spark, path, part.schema)


def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _register(spark, sf_dir, "rollbook_read", ["customer"])
    return rb.read_table(
        spark, db, "customer", "c_custkey, upper(c_name) AS name, c_nationkey + 1 AS nation_no"
    )


def load_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = rb.load_source(spark, f"{sf_dir}/customer.parquet")
    return customers.groupBy("c_nationkey").agg(F.count("*").alias("customers"))


def load_source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _register(spark, sf_dir, "rollbook_load", ["orders"])
    return rb.load_source(
        spark, _descriptor("Hive", db, "orders"), ["o_orderkey", "lower(o_orderpriority) AS priority"]
    )


def load_source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _register(spark, sf_dir, "rollbook_load", ["orders"])
    report = rb.load_source(spark, _descriptor("Hive", db, "orders"))
    return report.filter((F.col("database") == db) & (F.col("table") == "orders"))


def load_source_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _descriptor("HBase", "shop", "events")
    cells = _cells(spark, sf_dir)
    return _underscored(rb.load_source(spark, source, "meta:type,flag:late", cells=cells))


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _register(spark, sf_dir, "rollbook_catalog", TABLES)
    return rb.table_row_counts(spark).filter(F.col("database") == db)


def read_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "read_text")
    rb.write_text(_one_line_documents(spark, sf_dir), path)
    return rb.read_text(spark, path)


def _one_line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.regexp_replace("text", r"[\r\n]", " ")
    return _load(spark, sf_dir, "documents").select(text.alias("value"))


# Sinks and file jobs


def write_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "write_parquet")
    part = _load(spark, sf_dir, "part")
    rb.write_parquet(part, path)
    rb.write_parquet(part, path)
    return rb.read_parquet(spark, path)


def write_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "write_text")
    rb.write_text(_one_line_documents(spark, sf_dir), path, "value")
    lines = rb.read_text(spark, path)
    return lines.groupBy(F.md5("value").alias("line_md5")).agg(F.count("*").alias("copies"))


def copy_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "copy_dataset")
    rb.copy_dataset(spark, f"{sf_dir}/supplier.parquet", path)
    return rb.read_parquet(spark, path)


def copy_dataset_descriptor(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _register(spark, sf_dir, "rollbook_copy", ["conversations"])
    folder = scratch_path(spark, "copy_dataset_descriptor")
    descriptor = spark.createDataFrame(
        [(_descriptor("Hive", db, "conversations"),)], "value string"
    ).coalesce(1)
    rb.write_text(descriptor, f"{folder}/descriptor")
    held_in = rb.file_inventory(spark, f"{folder}/descriptor").filter("length > 0").first()["path"]
    rb.copy_dataset(spark, held_in, f"{folder}/copy", "conv_id, turn, upper(role) AS role")
    return rb.read_parquet(spark, f"{folder}/copy")


def copy_dataset_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "copy_dataset_cells")
    descriptor = spark.createDataFrame(
        [(_descriptor("HBase", "shop", "events"),)], "value string"
    ).coalesce(1)
    rb.write_text(descriptor, f"{folder}/descriptor")
    held_in = rb.file_inventory(spark, f"{folder}/descriptor").filter("length > 0").first()["path"]
    request = "meta:type,flag:late"
    rb.copy_dataset(spark, held_in, f"{folder}/copy", request, cells=_cells(spark, sf_dir))
    return _underscored(rb.read_parquet(spark, f"{folder}/copy"))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "file_inventory")
    orders = _load(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    orders.write.partitionBy("o_orderstatus").text(path)
    files = rb.file_inventory(spark, path)
    folder = F.element_at(F.split("parent", "/"), -1)
    return files.groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"))


# Customer counts


def total_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.total_users(_consumer(spark, sf_dir), "1998-03-26 00:00:00")


def new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.new_users(_consumer(spark, sf_dir), "1998-02-26 00:00:00", "1998-03-26 00:00:00")


def new_users_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    _consumer(spark, sf_dir).createOrReplaceTempView("rollbook_consumer")
    output = scratch_path(spark, "new_users_between")
    return rb.new_users_between(spark, "rollbook_consumer", "1996-01-01", "1997-01-01", output)


# Wide-column cells


def cells_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _underscored(rb.cells_select(_cells(spark, sf_dir), "meta:type:user"))


def cells_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _underscored(rb.cells_pivot(_cells(spark, sf_dir)))


def cell_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.cell_columns(_cells(spark, sf_dir))


def cells_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    failed = F.col("event_type") == "error"
    targets = (
        _load(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("click", "signup", "error"))
        .select(
            F.col("event_id").cast("string").alias("row_key"),
            F.when(failed, "flag").otherwise("meta").alias("family"),
            F.when(failed, "late").otherwise("user").alias("qualifier"),
        )
    )
    return rb.cells_drop(cells, targets)


# Strings, times, schema, vectors


def _strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event columns as text; ``mixed`` holds nulls, empties, decimals and words."""
    kind = F.col("event_type")
    mixed = (
        F.when(kind == "error", F.lit(None))
        .when(kind == "signup", "")
        .when(kind == "click", F.concat("event_id", F.lit("."), "user_id"))
        .otherwise(kind)
    )
    return _load(spark, sf_dir, "events").select(
        "event_id", "props", F.col("event_id").cast("string").alias("id"), mixed.alias("mixed")
    )


def classify_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.classify_strings(_strings(spark, sf_dir), ["props", "id", "mixed"])


def classify_strings_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _load(spark, sf_dir, "documents").select("doc_id", "text")
    return rb.classify_strings(documents, ["text"]).drop("text")


def profile_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.profile_strings(_strings(spark, sf_dir), ["props", "id", "mixed"])


def replace_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.replace_nulls(_consumer(spark, sf_dir), ["sgstatus"])


def with_time_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    events = _load(spark, sf_dir, "events").select("event_id", millis.alias("millis"))
    return rb.with_time_string(events, "millis", "time").drop("millis")


def with_month_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    bounds = rb.with_month_bounds(orders, "o_orderdate")
    # As text, in the form yyyy-MM-dd.
    return bounds.select(
        "o_orderkey", *[F.col(c).cast("string").alias(c) for c in ("month_start", "month_end")]
    )


def set_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _load(spark, sf_dir, "customer")
    return rb.set_nullable(customer, "c_name", False)


def labeled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = rb.labeled_points(_load(spark, sf_dir, "embeddings"), "label", "embedding")
    return points.select("label", F.posexplode(vector_to_array("features")).alias("pos", "feature"))


def unlabeled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = rb.unlabeled_vectors(_load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return vectors.select("id", F.posexplode(vector_to_array("features")).alias("pos", "feature"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: customers active as of a date."""
    return total_users(spark, FLAGSHIP_DIR)


def own_queries() -> dict[str, Query]:
    """One entry per operator, and one more for each further branch of some."""
    return {
        query.__name__: query
        for query in (
            read_parquet,
            read_orc,
            read_csv,
            read_csv_with_schema,
            read_table,
            load_source,
            load_source_table,
            load_source_report,
            load_source_cells,
            table_row_counts,
            read_text,
            write_parquet,
            write_text,
            copy_dataset,
            copy_dataset_descriptor,
            copy_dataset_cells,
            file_inventory,
            total_users,
            new_users,
            new_users_between,
            cells_select,
            cells_pivot,
            cell_columns,
            cells_drop,
            classify_strings,
            classify_strings_documents,
            profile_strings,
            replace_nulls,
            with_time_string,
            with_month_bounds,
            set_nullable,
            labeled_points,
            unlabeled_vectors,
        )
    }


def queries() -> dict[str, Query]:
    """Those of the library, and those of training-data pipelines where they are present."""
    found = own_queries()
    if llm_queries:
        found |= llm_queries.queries()
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


CONSUMER_SQL = """
    consumer AS (
        SELECT o_orderkey AS consumer_id, o_orderdate AS builddate,
               CASE o_orderstatus WHEN 'F' THEN '9' WHEN 'O' THEN '1' END AS sgstatus,
               shipped.canceldate
        FROM orders
        LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS canceldate FROM lineitem GROUP BY ALL) shipped
          ON o_orderkey = l_orderkey
    )
"""

CELLS_SQL = """
    cells AS (
        SELECT CAST(event_id AS varchar) AS row_key, 'meta' AS family, 'type' AS qualifier,
               CAST(0 AS bigint) AS ts, event_type AS value
        FROM events
        UNION ALL
        SELECT CAST(event_id AS varchar), 'meta', 'user', 0, CAST(user_id AS varchar)
        FROM events WHERE event_type <> 'error'
        UNION ALL
        SELECT CAST(event_id AS varchar), 'meta', 'user', 1, CAST(user_id + 1000 AS varchar)
        FROM events WHERE event_type = 'click'
        UNION ALL
        SELECT CAST(event_id AS varchar), 'meta', 'user', NULL, CAST(user_id + 2000 AS varchar)
        FROM events WHERE event_type = 'click'
        UNION ALL
        SELECT CAST(event_id AS varchar), 'meta', 'user', 0, CAST(user_id + 500 AS varchar)
        FROM events WHERE event_type = 'signup'
        UNION ALL
        SELECT CAST(event_id AS varchar), 'flag', 'late', 0, '1'
        FROM events WHERE event_type = 'signup'
        UNION ALL
        SELECT CAST(event_id AS varchar), 'flag', 'late', NULL, '0'
        FROM events WHERE event_type = 'error'
    )
"""

STRINGS_SQL = """
    strings AS (
        SELECT event_id, props, CAST(event_id AS varchar) AS id,
               CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN ''
                    WHEN 'click' THEN event_id || '.' || user_id ELSE event_type END AS mixed
        FROM events
    )
"""


def _newest_sql(family: str, qualifier: str) -> str:
    where = f"family = '{family}' AND qualifier = '{qualifier}'"
    versions = "value ORDER BY ts DESC NULLS LAST, value DESC NULLS LAST"
    return f"(list({versions}) FILTER (WHERE {where}))[1] AS {family}_{qualifier}"


def _flags_sql(column: str) -> dict[str, str]:
    return {
        "is_empty": f"({column} IS NULL OR {column} = '')",
        "is_int": rf"coalesce(regexp_full_match({column}, '[0-9]+'), false)",
        "is_double": rf"coalesce(regexp_full_match({column}, '[-+]?[0-9]*[.][0-9]+'), false)",
        "is_json": f"coalesce(json_valid({column}), false)",
    }


def _classify_sql(columns: list[str]) -> str:
    return ", ".join(
        f"{sql} AS {column}_{flag}" for column in columns for flag, sql in _flags_sql(column).items()
    )


def _profile_sql(column: str) -> str:
    names = {"is_empty": "empties", "is_int": "ints", "is_double": "doubles", "is_json": "jsons"}
    counts = ", ".join(
        f"count(*) FILTER (WHERE {sql}) AS {names[flag]}" for flag, sql in _flags_sql(column).items()
    )
    return f"""SELECT '{column}' AS "column", count(*) AS "rows", {counts} FROM strings"""


def _active_sql(cutoff: str) -> str:
    return f"(sgstatus <> '9' OR (sgstatus = '9' AND canceldate >= TIMESTAMP '{cutoff}'))"


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB's SQL."""
    one_line = r"regexp_replace(text, '[\r\n]', ' ', 'g')"
    own = {
        "read_parquet": "SELECT * FROM events",
        "read_orc": "SELECT * FROM orders",
        # Inference gives the narrowest type that holds the keys.
        "read_csv": "SELECT * REPLACE (CAST(c_custkey AS integer) AS c_custkey) FROM customer",
        "read_csv_with_schema": "SELECT * FROM part",
        "read_table": """
            SELECT c_custkey, upper(c_name) AS name, c_nationkey + 1 AS nation_no FROM customer""",
        "load_source": "SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY ALL",
        "load_source_table": "SELECT o_orderkey, lower(o_orderpriority) AS priority FROM orders",
        "load_source_report": """
            SELECT 'rollbook_load' AS "database", 'orders' AS "table", count(*) AS "rows"
            FROM orders""",
        "load_source_cells": f"""
            WITH {CELLS_SQL}
            SELECT row_key, {_newest_sql("meta", "type")}, {_newest_sql("flag", "late")}
            FROM cells WHERE (family, qualifier) IN (('meta', 'type'), ('flag', 'late'))
            GROUP BY row_key""",
        "table_row_counts": " UNION ALL ".join(
            f"""SELECT 'rollbook_catalog' AS "database", '{table}' AS "table", count(*) AS "rows"
            FROM {table}"""
            for table in TABLES
        ),
        "read_text": f"SELECT {one_line} AS value FROM documents",
        "write_parquet": "SELECT * FROM part",
        "write_text": f"""
            SELECT md5({one_line}) AS line_md5, count(*) AS copies FROM documents GROUP BY ALL""",
        "copy_dataset": "SELECT * FROM supplier",
        "copy_dataset_descriptor": "SELECT conv_id, turn, upper(role) AS role FROM conversations",
        "copy_dataset_cells": f"""
            WITH {CELLS_SQL}
            SELECT row_key, {_newest_sql("meta", "type")}, {_newest_sql("flag", "late")}
            FROM cells WHERE (family, qualifier) IN (('meta', 'type'), ('flag', 'late'))
            GROUP BY row_key""",
        "file_inventory": """
            SELECT 'o_orderstatus=' || o_orderstatus AS folder,
                   CAST(sum(strlen(o_orderpriority) + 1) AS bigint) AS bytes
            FROM orders GROUP BY o_orderstatus""",
        "total_users": f"""
            WITH {CONSUMER_SQL}
            SELECT count(*) AS total_users FROM consumer
            WHERE builddate < TIMESTAMP '1998-03-26' AND {_active_sql("1998-03-26")}""",
        "new_users": f"""
            WITH {CONSUMER_SQL}
            SELECT count(*) AS new_users FROM consumer
            WHERE builddate >= TIMESTAMP '1998-02-26' AND builddate < TIMESTAMP '1998-03-26'
              AND {_active_sql("1998-03-26")}""",
        "new_users_between": f"""
            WITH {CONSUMER_SQL}
            SELECT count(*) AS xzyhs FROM consumer
            WHERE builddate >= TIMESTAMP '1996-01-01' AND builddate < TIMESTAMP '1997-01-01'
              AND {_active_sql("1997-01-01")}""",
        "cells_select": f"""
            WITH {CELLS_SQL}
            SELECT row_key, {_newest_sql("meta", "type")}, {_newest_sql("meta", "user")}
            FROM cells WHERE family = 'meta' AND qualifier IN ('type', 'user')
            GROUP BY row_key""",
        "cells_pivot": f"""
            WITH {CELLS_SQL}
            SELECT row_key, {_newest_sql("flag", "late")}, {_newest_sql("meta", "type")},
                   {_newest_sql("meta", "user")}
            FROM cells GROUP BY row_key""",
        "cell_columns": f"""
            WITH {CELLS_SQL}
            SELECT family, string_agg(DISTINCT qualifier, ':' ORDER BY qualifier) AS columns
            FROM cells GROUP BY family""",
        "cells_drop": f"""
            WITH {CELLS_SQL},
            ranked AS (
                SELECT *, row_number() OVER (
                    PARTITION BY row_key, family, qualifier
                    ORDER BY ts DESC NULLS LAST, value DESC NULLS LAST) AS age
                FROM cells
            ),
            targets AS (
                SELECT CAST(event_id AS varchar) AS row_key, 'meta' AS family,
                       'user' AS qualifier
                FROM events WHERE event_type IN ('click', 'signup')
                UNION ALL
                SELECT CAST(event_id AS varchar), 'flag', 'late'
                FROM events WHERE event_type = 'error'
            )
            SELECT row_key, family, qualifier, ts, value FROM ranked
            WHERE NOT (age = 1
                       AND (row_key, family, qualifier) IN (SELECT * FROM targets))""",
        "classify_strings": f"""
            WITH {STRINGS_SQL} SELECT *, {_classify_sql(["props", "id", "mixed"])} FROM strings""",
        "classify_strings_documents": f"SELECT doc_id, {_classify_sql(['text'])} FROM documents",
        "profile_strings": f"WITH {STRINGS_SQL} "
        + " UNION ALL ".join(_profile_sql(c) for c in ["props", "id", "mixed"]),
        "replace_nulls": f"""
            WITH {CONSUMER_SQL}
            SELECT * REPLACE (coalesce(sgstatus, '') AS sgstatus) FROM consumer""",
        "with_time_string": """
            SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events""",
        "with_month_bounds": """
            SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
                   strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end
            FROM orders""",
        "set_nullable": "SELECT * FROM customer",
        "labeled_points": """
            SELECT CAST(label AS double) AS label,
                   CAST(generate_subscripts(embedding, 1) - 1 AS integer) AS pos,
                   CAST(unnest(embedding) AS double) AS feature
            FROM embeddings""",
        "unlabeled_vectors": """
            SELECT CAST(vec_id AS double) AS id,
                   CAST(generate_subscripts(embedding, 1) - 1 AS integer) AS pos,
                   CAST(unnest(embedding) AS double) AS feature
            FROM embeddings""",
    }
    if llm_queries:
        own |= llm_queries.oracle_sql()
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own
