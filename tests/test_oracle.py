"""Every registered query against its SQL in DuckDB, over whole tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in driver.TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def _sorted(rows, order):
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert driver.own_queries().keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", driver.own_queries())
def test_matches_oracle(spark, duck, name):
    actual = driver.queries()[name](spark, SF_DIR)
    expected = duck.execute(driver.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(actual.columns) == sorted(names)
    rows = _sorted(actual.collect(), [actual.columns.index(c) for c in sorted(names)])
    assert rows == _sorted(expected.fetchall(), [names.index(c) for c in sorted(names)])
    assert rows


def test_known_counts(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert driver.total_users(spark, sf_dir).collect()[0][0] == 4522
    assert driver.new_users(spark, sf_dir).collect()[0][0] == 100
    assert driver.new_users_between(spark, sf_dir).collect()[0][0] == 1434


def test_entry(spark):
    assert driver.entry(spark).collect()[0].total_users == 457


def test_queries_follow_the_folder(spark):
    counts = [
        [row.rows for row in driver.load_source_report(spark, f"/root/testdata/{sf}").collect()]
        for sf in ("sf0.001", "sf0.01", "sf0.001")
    ]
    assert counts == [[1500], [15000], [1500]]
