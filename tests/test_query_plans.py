"""What the plans must look like to hold up on large data."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import rollbook as rb
from rollbook import scratch
from rollbook.operators import cells as cells_module

SF_DIR = "/root/testdata/sf0.001"


def _plan(df, mode="simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def _exchanges(plan: str) -> int:
    return len(re.findall(r"\bExchange ", plan))


@pytest.fixture
def no_broadcast(spark):
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


@pytest.fixture
def stored_cells(spark, tmp_path):
    cells = driver._cells(spark, SF_DIR)
    cells.write.parquet(str(tmp_path / "cells"))
    return spark.read.parquet(str(tmp_path / "cells"))


@pytest.fixture
def stored_customers(spark, tmp_path):
    customers = driver._consumer(spark, SF_DIR)
    customers.withColumn("other", F.lit("x")).write.parquet(str(tmp_path / "customers"))
    return spark.read.parquet(str(tmp_path / "customers"))


def test_counts_prune_and_push_down(stored_customers):
    count = rb.new_users(stored_customers, "1998-02-26", "1998-03-26")
    plan, details = _plan(count), _plan(count, "formatted")
    read = "struct<builddate:timestamp_ntz,sgstatus:string,canceldate:timestamp_ntz>"
    assert f"ReadSchema: {read}" in details
    pushed = re.search(r"PushedFilters: (.*)", details).group(1)
    assert "GreaterThanOrEqual(builddate" in pushed and "LessThan(builddate" in pushed
    assert "Or(Not(EqualTo(sgstatus,9)),And(EqualTo(sgstatus,9),GreaterThanOrEqual(canceldate" in pushed
    assert _exchanges(plan) == 1 and "partial_count" in plan


def test_text_dates_are_pushed_down_too(spark, stored_customers, tmp_path):
    as_text = stored_customers.withColumn("builddate", F.date_format("builddate", "yyyy-MM-dd HH:mm:ss"))
    as_text.write.parquet(str(tmp_path / "text"))
    plan = _plan(rb.total_users(spark.read.parquet(str(tmp_path / "text")), "1998-03-26"))
    assert "LessThan(builddate,1998-03-26 00:00:00)" in plan


@pytest.mark.parametrize("request_", ["meta:user", "meta:type:user,flag:late"])
def test_select_pushes_the_request_and_moves_single_cells(stored_cells, request_):
    plan = _plan(rb.cells_select(stored_cells, request_))
    assert "EqualTo(family,meta)" in plan and "qualifier" in plan.split("PushedFilters")[1]
    assert _exchanges(plan) == 2 and "partial_max" in plan
    # A cell crosses as one cell: first by its key, then as a position and a value.
    assert re.search(r"hashpartitioning\(row_key#\d+, family#\d+, qualifier#\d+", plan)
    assert plan.index("collect_list") < plan.index("partial_max")


def test_column_names_read_two_columns(stored_cells):
    assert "ReadSchema: struct<family:string,qualifier:string>" in _plan(rb.cell_columns(stored_cells))


def _plans_run(spark, monkeypatch, make) -> list[str]:
    """The plans of what ``make`` writes on its way and of what it returns."""
    plans = []
    written = scratch.written

    def seen(df, label):
        plans.append(_plan(df))
        return written(df, label)

    monkeypatch.setattr(cells_module, "written", seen)
    made = make()
    monkeypatch.setattr(cells_module, "written", written)
    return [*plans, _plan(made)]


def test_drop_reads_cells_once_and_spreads_versions(spark, stored_cells, no_broadcast, monkeypatch):
    targets = stored_cells.filter("qualifier = 'user'").select("row_key", "family", "qualifier")
    targets = scratch.written(targets, "targets")
    found, left = _plans_run(spark, monkeypatch, lambda: rb.cells_drop(stored_cells, targets))
    # Cells are read once by each, and the rows that the first job wrote by the second.
    assert found.count("/cells]") == 1 and left.count("/cells]") == 1 and left.count("FileScan") == 2
    assert "_lot" in found and "partial_max" in found and "Window" not in found + left
    # The versions of a cell are dealt by their time and value as well.
    dealt = re.findall(r"hashpartitioning\((.*?), \d+\), ENSURE", left)
    assert len(dealt) == 2 and all("ts#" in keys and "value#" in keys for keys in dealt)


def test_few_targets_leave_all_cells_unshuffled(spark, tmp_path, monkeypatch):
    rows = spark.range(20_000).selectExpr(
        "cast(id as string) row_key", "'f' family", "'q' qualifier", "id ts", "'v' value"
    )
    rows.write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    targets = cells.filter("ts < 5").select("row_key", "family", "qualifier")
    targets = scratch.written(targets, "targets")
    found, left = _plans_run(spark, monkeypatch, lambda: rb.cells_drop(cells, targets))
    assert rb.cells_drop(cells, targets).count() == 19_995
    assert _exchanges(left) == 0 and "BroadcastHashJoin" in left and left.count("FileScan") == 2
    # Of the first job only what the targets hit crosses, and the targets themselves.
    assert "LeftSemi" in found.split("partial_max")[1]


def test_many_targets_in_small_files_are_not_broadcast(spark, tmp_path, monkeypatch):
    rows = spark.range(40_000).selectExpr(
        "cast(id div 2 as string) row_key", "'f' family", "'q' qualifier", "id ts", "'v' value"
    )
    rows.write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    targets = scratch.written(cells.select("row_key", "family", "qualifier").distinct(), "targets")
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # More than the files of targets and of newest versions, less than their rows in memory.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        for plan in _plans_run(spark, monkeypatch, lambda: rb.cells_drop(cells, targets)):
            assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 1
        left = rb.cells_drop(cells, targets)
        assert left.count() == 20_000 and left.filter("ts % 2 = 1").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


@pytest.mark.parametrize("width", [4, 900])
def test_cells_are_gathered_by_place(spark, width):
    rows = spark.range(4000).selectExpr(
        "cast(id % 7 as string) row_key", "'f' family", f"concat('q', id % {width}) qualifier", "id ts", "'v' value"
    )
    table = rb.cells_select(rows, [("f", f"q{n}") for n in range(width)])
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    # One pass fills the gaps; no map is searched for any column.
    assert plan.count("flatten(zip_with") == 1 and "map_from_entries" not in plan


def test_counting_tables_reads_no_columns(spark):
    plan = _plan(driver.table_row_counts(spark, SF_DIR))
    assert plan.count("ReadSchema: struct<>") == len(driver.TABLES)
    assert plan.count("FileScan") == len(driver.TABLES)


def test_filter_on_the_report_removes_the_other_tables(spark):
    driver.table_row_counts(spark, SF_DIR)
    report = rb.table_row_counts(spark).filter("database = 'rollbook_catalog' AND table = 'orders'")
    assert _plan(report).count("FileScan") == 1


def test_inventory_reads_no_content(spark):
    assert "content" not in _plan(rb.file_inventory(spark, SF_DIR))


def test_profile_is_one_pass(spark):
    plan = _plan(driver.profile_strings(spark, SF_DIR))
    assert plan.count("FileScan") == 1 and _exchanges(plan) == 1


ONE_PASS = """read_parquet read_table classify_strings with_time_string with_month_bounds
set_nullable labeled_points unlabeled_vectors""".split()


@pytest.mark.parametrize("name", ONE_PASS)
def test_row_wise_operators_do_not_shuffle(spark, name):
    plan = _plan(driver.queries()[name](spark, SF_DIR))
    assert _exchanges(plan) == 0 and plan.count("FileScan") == 1


@pytest.mark.parametrize("name", driver.own_queries())
def test_no_python_and_no_cartesian_product(spark, name):
    plan = _plan(driver.queries()[name](spark, SF_DIR))
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
