from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import rollbook as rb
from rollbook.scratch import scratch_path
from rollbook.sources import router, tables
from rollbook.sources.router import named_source, parse_descriptor, source_text
from rollbook.sources.tables import _unquoted

SF_DIR = "/root/testdata/sf0.01"
DESCRIPTOR = {
    "nodeId": 3,
    "datasetId": "d",
    "ip": "10.0.0.1",
    "port": 2181,
    "dbName": "shop",
    "tableName": "nation",
    "dbType": "Hive",
}


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """A database of three tables, an empty one, and a temporary view."""
    spark.sql(f"CREATE DATABASE shop LOCATION '{tmp_path_factory.mktemp('shop')}'")
    spark.sql(f"CREATE DATABASE shop_empty LOCATION '{tmp_path_factory.mktemp('empty')}'")
    for table in ("region", "nation", "supplier"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.saveAsTable(f"shop.{table}")
    spark.range(3).createOrReplaceTempView("not_reported")
    yield "shop"
    spark.sql("DROP DATABASE shop CASCADE")
    spark.sql("DROP DATABASE shop_empty CASCADE")
    spark.catalog.dropTempView("not_reported")


SHOP_ROWS = [("shop", "nation", 25), ("shop", "region", 5), ("shop", "supplier", 100)]


def _text(**changes):
    return json.dumps({**DESCRIPTOR, **changes})


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_read_table_takes_any_select_list(spark, shop):
    for columns in (
        "n_regionkey * 2 AS twice, upper(n_name) AS name",
        ["n_regionkey * 2 AS twice", "upper(n_name) AS name"],
    ):
        df = rb.read_table(spark, shop, "nation", columns)
        assert df.columns == ["twice", "name"] and df.count() == 25
    assert rb.read_table(spark, shop, "nation", "count(*) AS n").collect()[0].n == 25
    assert rb.read_table(spark, shop, "nation", "DISTINCT n_regionkey").count() == 5
    assert rb.read_table(spark, shop, "nation", "*").columns[0] == "n_nationkey"


@pytest.mark.parametrize("columns", [None, "", []])
def test_read_table_without_columns_is_the_report(spark, shop, columns):
    report = rb.read_table(spark, shop, "nation", columns)
    assert report.columns == ["database", "table", "rows"]
    assert _rows(report.filter("database = 'shop'")) == SHOP_ROWS


def test_report(spark, shop):
    report = rb.table_row_counts(spark)
    assert [f.dataType.simpleString() for f in report.schema] == ["string", "string", "bigint"]
    assert _rows(report.filter("database LIKE 'shop%'")) == SHOP_ROWS
    assert report.filter("table = 'not_reported'").isEmpty()


def test_report_leaves_the_current_database(spark, shop):
    before = spark.catalog.currentDatabase()
    rb.table_row_counts(spark).collect()
    assert spark.catalog.currentDatabase() == before


def test_quotes_of_database_names():
    # This Spark refuses to create such a name through SQL, but a metastore may hold one.
    names = {"shop": "shop", "`2020`": "2020", "`sh``op`": "sh`op", "```a`": "`a", "`": "`"}
    assert {shown: _unquoted(shown) for shown in names} == names


def test_odd_names(spark, tmp_path):
    spark.sql(f"CREATE DATABASE `2020` LOCATION '{tmp_path}'")
    try:
        spark.sql("CREATE TABLE `2020`.`select` USING parquet AS SELECT * FROM range(2)")
        report = rb.table_row_counts(spark).filter("database = '2020'")
        assert _rows(report) == [("2020", "select", 2)]
        assert rb.read_table(spark, "2020", "select", "id").count() == 2
    finally:
        spark.sql("DROP DATABASE `2020` CASCADE")


def test_report_over_many_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE many LOCATION '{tmp_path}'")
    try:
        for i in range(37):
            spark.sql(f"CREATE TABLE many.t{i:02} USING parquet AS SELECT * FROM range({i})")
        report = rb.table_row_counts(spark).filter("database = 'many'")
        assert _rows(report) == [("many", f"t{i:02}", i) for i in range(37)]
    finally:
        spark.sql("DROP DATABASE many CASCADE")


def test_parse_descriptor():
    assert parse_descriptor(_text()) == rb.SourceDescriptor(**DESCRIPTOR)
    assert parse_descriptor("{\n \"dbType\": \"Hive\"\n}").dbType == "Hive"
    assert parse_descriptor('{"dbType": "Hive", "other": 1}').tableName is None
    for text in ("/data/x", "x", "", "5", "[1]", '"x"', "null", '{"a":1', '{"a":1} x'):
        assert parse_descriptor(text) is None


def test_load_source_branches(spark, shop):
    assert rb.load_source(spark, f"{SF_DIR}/nation.parquet").count() == 25
    assert rb.load_source(spark, _text(), "n_name").columns == ["n_name"]
    assert _rows(rb.load_source(spark, _text()).filter("database = 'shop'")) == SHOP_ROWS
    spread = json.dumps(DESCRIPTOR, indent=2)
    assert rb.load_source(spark, spread, ["n_name"]).count() == 25


def test_a_table_descriptor_must_name_the_table(spark):
    with pytest.raises(ValueError, match="tableName"):
        rb.load_source(spark, _text(tableName=None), "n_name")


@pytest.mark.parametrize("db_type", ["hive", "HBase", None])
def test_other_types_need_cells(spark, db_type):
    with pytest.raises(ValueError, match="dbType"):
        rb.load_source(spark, _text(dbType=db_type), "f:x")
    schema = "row_key string, family string, qualifier string, ts bigint, value string"
    cells = spark.createDataFrame([("a", "f", "x", 1, "1"), ("a", "g", "y", 1, "2")], schema)
    loaded = rb.load_source(spark, _text(dbType=db_type), "f:x", cells=cells)
    assert loaded.columns == ["row_key", "f:x"]
    assert rb.load_source(spark, _text(dbType=db_type), ["f:x", "g:y"], cells=cells).count() == 1
    pivoted = rb.load_source(spark, _text(dbType=db_type), "*", cells=cells)
    assert _rows(pivoted) == [("a", "1", "2")]
    with pytest.raises(ValueError, match="columns"):
        rb.load_source(spark, _text(dbType=db_type), cells=cells)


def test_source_text(spark, tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    assert source_text(spark, str(folder)) == str(folder)
    assert source_text(spark, f"{SF_DIR}/nation.parquet") == f"{SF_DIR}/nation.parquet"
    descriptor = tmp_path / "descriptor.json"
    descriptor.write_bytes(b'{"dbName":\r\n "shop",\n"tableName":\r"nation"}\n')
    assert source_text(spark, str(descriptor)) == '{"dbName": "shop","tableName":"nation"}'
    descriptor.write_text(" " * 100_000 + '{"dbName": "shop"}')
    assert parse_descriptor(source_text(spark, str(descriptor))).dbName == "shop"


@pytest.mark.parametrize("head", ["plain prose ", "{not json ", '{"a": 1}\n{"a": 2}\n', "[1, 2, ", '{"a": 01', '{"a" "b"'])
def test_a_large_wrong_file_is_not_read_through(spark, tmp_path, monkeypatch, head):
    wrong = tmp_path / "wrong.txt"
    with open(wrong, "w") as file:
        file.write(head)
        for _ in range(2000):
            file.write("some words of a text that goes on and on, line by line\n" * 400)
    read = []
    lines = router._lines
    monkeypatch.setattr(
        router, "_lines", lambda spark, path: (read.append(len(piece)) or piece for piece in lines(spark, path))
    )
    with pytest.raises(ValueError, match="neither"):
        source_text(spark, str(wrong))
    assert wrong.stat().st_size > 40_000_000 and sum(read) < 20_000
    with pytest.raises(ValueError, match="neither"):
        rb.copy_dataset(spark, str(wrong), str(tmp_path / "out"))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 5000])
def test_a_descriptor_in_any_pieces(size):
    text = ' {"dbName": "a\\u00e9\\n\u4e2d", "port": -1.5e3, "more": [true, false, null, {"x": []}], "dbType": "Hive"} ' + " " * 40
    pieces = [text[n : n + size] for n in range(0, len(text), size)]
    assert named_source(iter(pieces), "here") == text
    assert parse_descriptor(text).dbName == "a\u00e9\n\u4e2d"
    for wrong in (text.strip() + "x" * 60, text.replace('"port":', '"port"') + " " * 60, text.strip()[:-1]):
        with pytest.raises(ValueError, match="neither"):
            named_source(iter(wrong[n : n + size] for n in range(0, len(wrong), size)), "here")
    for path in ("/data/x", "", "s3://bucket/" + "k" * 1000, "/a" * 4000):
        assert named_source(iter(path[n : n + size] for n in range(0, len(path), size)), "here") == path


def test_a_narrowed_report_looks_up_nothing_else(spark, shop, monkeypatch):
    looked_up = []
    table, names = type(spark).table, tables._table_names
    monkeypatch.setattr(type(spark), "table", lambda self, name: looked_up.append(name) or table(self, name))
    monkeypatch.setattr(tables, "_table_names", lambda s, db: looked_up.append(db) or names(s, db))
    report = rb.table_row_counts(spark, [shop], ["NATION"])
    assert _rows(report) == [("shop", "nation", 25)] and looked_up == ["shop", "`shop`.`nation`"]
    assert _rows(rb.table_row_counts(spark, databases=["shop"])) == SHOP_ROWS
    only = [row for row in _rows(rb.table_row_counts(spark, tables=["region"])) if row[0] == "shop"]
    assert only == [SHOP_ROWS[1]]
    assert rb.table_row_counts(spark, ["nowhere"]).isEmpty()


def test_csv_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,amount\n1,"x, y",1.5\n2,,2\n')
    df = rb.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("id", "int"), ("name", "string"), ("amount", "double")]
    assert _rows(df.na.fill("")) == [(1, "x, y", 1.5), (2, "", 2.0)]
    typed = rb.read_csv(spark, str(tmp_path / "a.csv"), "id bigint, name string, amount string")
    assert typed.dtypes == [("id", "bigint"), ("name", "string"), ("amount", "string")]


def test_inferred_types_come_from_all_rows(spark, tmp_path):
    lines = "\n".join(str(i) for i in range(50_000))
    (tmp_path / "late.csv").write_text(f"v\n{lines}\nlast\n")
    assert rb.read_csv(spark, str(tmp_path / "late.csv")).dtypes == [("v", "string")]


def test_read_text(spark, tmp_path):
    (tmp_path / "t").write_text("a\n\nb")
    assert [r.value for r in rb.read_text(spark, str(tmp_path / "t")).collect()] == ["a", "", "b"]
    whole = rb.read_text(spark, str(tmp_path / "t"), wholetext=True)
    assert [r.value for r in whole.collect()] == ["a\n\nb"]


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{shared}/rollbook-") and first != second


def test_scratch_is_in_the_warehouse_without_a_shared_folder(spark, monkeypatch):
    settings = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": spark.conf.get("spark.sql.warehouse.dir")}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: settings[key])
    assert scratch_path(spark, "x").startswith(settings["spark.sql.warehouse.dir"])

def test_orc_round_trip(spark, tmp_path):
    part = rb.read_parquet(spark, f"{SF_DIR}/part.parquet")
    part.write.orc(str(tmp_path / "part"))
    read = rb.read_orc(spark, str(tmp_path / "part"))
    assert read.dtypes == part.dtypes
    assert read.exceptAll(part).isEmpty() and read.count() == part.agg(F.count("*")).first()[0]
