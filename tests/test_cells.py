from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import rollbook as rb
from rollbook import fixtures

SCHEMA = "row_key string, family string, qualifier string, ts bigint, value string"


def _cells(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _random_cells(columns: int, rows: int, seed: int, hot: str = "r0"):
    """Cells with a third of all of them in one row, and many versions of some."""
    chance = random.Random(seed)
    seen = {}
    for _ in range(6000):
        row = hot if chance.random() < 0.33 else f"r{chance.randrange(rows)}"
        n = chance.randrange(columns)
        seen[(row, f"f{n % 3}", f"q{n}", chance.randrange(50))] = f"v{chance.randrange(10**6)}"
    return [(*key, value) for key, value in seen.items()]


def _newest(rows):
    newest = {}
    for row, family, qualifier, ts, value in rows:
        newest[(row, family, qualifier)] = max(newest.get((row, family, qualifier), (-1, "")), (ts, value))
    return {key: value for key, (_, value) in newest.items()}


def _expected(rows, columns):
    newest = _newest(rows)
    keys = sorted({key[0] for key in newest if key[1:] in columns})
    return [(key, *[newest.get((key, *column)) for column in columns]) for key in keys]


def test_ragged_rows_keep_their_columns(spark):
    cells = _cells(
        spark,
        [
            ("a", "f", "x", 1, "1"),
            ("a", "f", "y", 1, "2"),
            ("b", "f", "y", 1, "3"),
            ("c", "g", "x", 1, "4"),
            ("d", "g", "z", 1, "5"),
        ],
    )
    table = rb.cells_select(cells, "f:y:x,g:x")
    assert table.columns == ["row_key", "f:y", "f:x", "g:x"]
    assert _rows(table) == [("a", "2", "1", None), ("b", "3", None, None), ("c", None, None, "4")]


def test_newest_version_and_ties(spark):
    cells = _cells(
        spark,
        [
            ("a", "f", "x", 1, "old"),
            ("a", "f", "x", 9, "new"),
            ("a", "f", "x", 3, "mid"),
            ("b", "f", "x", 5, "m"),
            ("b", "f", "x", 5, "z"),
        ],
    )
    assert _rows(rb.cells_select(cells, "f:x")) == [("a", "new"), ("b", "z")]


@pytest.mark.parametrize("columns", [3, 40, 160])
def test_table_against_brute_force(spark, columns):
    rows = _random_cells(columns, 80, seed=columns)
    names = sorted({(family, qualifier) for _, family, qualifier, _, _ in rows})
    cells = _cells(spark, rows).repartition(8)
    pivoted = rb.cells_pivot(cells)
    assert pivoted.columns == ["row_key", *[f"{f}:{q}" for f, q in names]]
    assert sorted(map(tuple, pivoted.collect()), key=lambda r: r[0]) == _expected(rows, names)
    wanted = names[::2]
    request = ",".join(f"{f}:{q}" for f, q in wanted)
    selected = rb.cells_select(cells, request).collect()
    assert sorted(map(tuple, selected), key=lambda r: r[0]) == _expected(rows, wanted)


def test_select_of_all_columns_is_the_pivot(spark):
    cells = fixtures.cells(rb.read_parquet(spark, "/root/testdata/sf0.001/events.parquet"))
    selected, pivoted = rb.cells_select(cells, "flag:late,meta:type:user"), rb.cells_pivot(cells)
    assert selected.columns == pivoted.columns
    assert selected.exceptAll(pivoted).isEmpty() and pivoted.exceptAll(selected).isEmpty()


@pytest.mark.parametrize("request_", ["", "f", "f:", ":x", "f:x,", "f:x,g", "f::x"])
def test_request_must_name_columns(spark, request_):
    with pytest.raises(ValueError):
        rb.cells_select(_cells(spark, []), request_)


def test_repeated_request_gives_one_column(spark):
    cells = _cells(spark, [("a", "f", "x", 1, "1")])
    assert rb.cells_select(cells, "f:x:x,f:x").columns == ["row_key", "f:x"]


def test_pivot_without_cells(spark):
    assert rb.cells_pivot(_cells(spark, [])).columns == ["row_key"]


def test_cell_columns(spark):
    rows = [("a", "f", "y", 1, ""), ("b", "f", "x", 1, ""), ("b", "f", "y", 2, ""), ("a", "e", "z", 1, "")]
    assert _rows(rb.cell_columns(_cells(spark, rows))) == [("e", "z"), ("f", "x:y")]
    assert _rows(rb.cell_columns(_cells(spark, []))) == []


def test_very_many_columns(spark):
    cells = spark.range(12_000).selectExpr(
        "'r' row_key", "'f' family", "lpad(id, 5, '0') qualifier", "0L ts", "'' value"
    )
    names = rb.cell_columns(cells).collect()[0].columns.split(":")
    assert len(names) == 12_000 and names == sorted(names)


def test_null_and_odd_names(spark):
    rows = [
        ("a", None, "q", 1, "1"), ("a", None, "q", 2, "2"), ("a", "f", None, 1, "3"),
        ("a", "f", "x:y,z", 1, "4"), ("b", None, None, None, "5"),
    ]
    cells = _cells(spark, rows)
    pivoted = rb.cells_pivot(cells)
    assert pivoted.columns == ["row_key", ":", ":q", "f:", "f:x:y,z"]
    assert _rows(pivoted.filter("row_key = 'a'")) == [("a", None, "2", "3", "4")]
    assert _rows(pivoted.filter("row_key = 'b'")) == [("b", "5", None, None, None)]
    selected = rb.cells_select(cells, [("f", "x:y,z"), (None, "q")])
    assert _rows(selected) == [("a", "4", "2")]
    assert dict(tuple(r) for r in rb.cell_columns(cells).collect()) == {None: ":q", "f": ":x:y,z"}
    targets = spark.createDataFrame([("a", None, "q"), ("b", None, None)], SCHEMA.split(", ts")[0])
    assert sorted(map(tuple, rb.cells_drop(cells, targets).collect()), key=repr) == sorted(
        [rows[0], rows[2], rows[3]], key=repr
    )


def test_drop_and_select_agree_on_the_newest(spark):
    rows = [("r", "f", "q", 1, "a"), ("r", "f", "q", 1, "b"), ("r", "f", "q", 0, "z")]
    rows += [("s", "f", "q", None, "x"), ("s", "f", "q", None, None)]
    cells = _cells(spark, rows)
    targets = spark.createDataFrame([r[:3] for r in rows], SCHEMA.split(", ts")[0])
    assert _rows(rb.cells_select(cells, "f:q")) == [("r", "b"), ("s", "x")]
    left = sorted(map(tuple, rb.cells_drop(cells, targets).collect()), key=repr)
    assert left == sorted([rows[0], rows[2], rows[4]], key=repr)


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_drop_against_brute_force(spark, broadcast):
    rows = _random_cells(30, 80, seed=5)
    keys = sorted(_newest(rows))
    targets = keys[::3] + [("absent", "f0", "q0"), keys[0]]
    rows += [(*row[:4], row[4] + "x") for row in rows[::4]]
    gone = {(*key, *max(tuple(r[3:]) for r in rows if r[:3] == key)) for key in keys[::3]}
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        cells = _cells(spark, rows).repartition(8)
        left = rb.cells_drop(cells, spark.createDataFrame(targets, SCHEMA.split(", ts")[0]))
        assert left.columns == cells.columns
        assert _rows(left) == sorted(r for r in rows if r not in gone)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)


def test_fixture_counts(spark):
    cells = fixtures.cells(rb.read_parquet(spark, "/root/testdata/sf0.01/events.parquet"))
    counts = cells.groupBy("family", "qualifier").agg(F.count("*"))
    assert _rows(counts) == [
        ("flag", "late", 4031),
        ("meta", "type", 10000),
        ("meta", "user", 14015),
    ]
    assert rb.cells_pivot(cells).count() == 10000
    assert rb.cells_select(cells, "meta:user").count() == 7986


def test_names_that_a_sink_can_hold(spark, tmp_path):
    rows = [
        ("r", "F", "q", 1, "upper"), ("r", "f", "q", 1, "lower"), ("r", None, "x", 1, "null"), ("r", "", "x", 1, "empty"),
        ("r", "a:b", "c", 1, "left"), ("r", "a", "b:c", 1, "right"), ("r", "f", "q#2", 1, "numbered"),
    ]
    cells = _cells(spark, rows)
    pivoted = rb.cells_pivot(cells)
    assert pivoted.columns == ["row_key", ":x", ":x#2", "F:q", "a:b:c", "a:b:c#2", "f:q#2", "f:q#2#2"]
    for write in (pivoted.write.parquet, pivoted.write.orc, pivoted.write.json):
        write(str(tmp_path / write.__name__))
    held = spark.read.parquet(str(tmp_path / "parquet")).collect()
    assert [tuple(r) for r in held] == [("r", "null", "empty", "upper", "right", "left", "lower", "numbered")]
    selected = rb.cells_select(cells, [("f", "q"), ("F", "q")])
    assert selected.columns == ["row_key", "f:q", "F:q#2"] and _rows(selected) == [("r", "lower", "upper")]


def test_drop_keeps_other_columns(spark):
    rows = [("r", "f", "q", 1, "a"), ("r", "f", "q", 2, "b"), ("s", "f", "q", 2, "b")]
    cells = _cells(spark, rows).withColumns({"_newest_ts": F.lit(2), "extra": F.lit("e"), "_lot": F.lit(0)})
    targets = spark.createDataFrame([("r", "f", "q")], SCHEMA.split(", ts")[0])
    left = rb.cells_drop(cells, targets)
    assert left.columns == cells.columns
    assert _rows(left) == [(*rows[0], 2, "e", 0), (*rows[2], 2, "e", 0)]
