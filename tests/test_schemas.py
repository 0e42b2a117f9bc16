from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from pyspark.sql import types as T

import rollbook as rb

SCHEMA = T.StructType(
    [
        T.StructField("k", T.IntegerType(), False),
        T.StructField("v", T.StringType(), True, {"m": 1}),
    ]
)


def test_relax_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], SCHEMA)
    relaxed = rb.set_nullable(df, "k", True)
    assert relaxed.schema == T.StructType([T.StructField("k", T.IntegerType(), True), SCHEMA["v"]])
    assert relaxed.collect() == df.collect()


def test_tighten_keeps_type_and_metadata(spark):
    df = spark.createDataFrame([(1, "a"), (2, "")], SCHEMA)
    tight = rb.set_nullable(df, "v", False)
    assert tight.schema["v"] == T.StructField("v", T.StringType(), False, {"m": 1})
    assert tight.schema["v"].metadata == {"m": 1}
    assert tight.collect() == df.collect()


def test_tighten_fails_on_a_null(spark):
    tight = rb.set_nullable(spark.createDataFrame([(1, "a"), (2, None)], SCHEMA), "v", False)
    with pytest.raises(Exception, match="null in column v"):
        tight.collect()
    # The column is pruned from a bare count, and the check with it.
    assert tight.count() == 2


@pytest.mark.parametrize("name", ["missing", "V", "K"])
def test_other_names_change_nothing(spark, name):
    df = spark.createDataFrame([(1, None)], SCHEMA)
    for nullable in (True, False):
        assert rb.set_nullable(df, name, nullable).schema == SCHEMA


VALUES = {
    "boolean": True,
    "tinyint": 1,
    "bigint": 2**40,
    "double": 1.5,
    "decimal(5,2)": Decimal("1.25"),
    "string": "x",
    "binary": bytearray(b"x"),
    "date": datetime.date(2020, 1, 2),
    "timestamp": datetime.datetime(2020, 1, 2, 3),
    "timestamp_ntz": datetime.datetime(2020, 1, 2, 3),
    "array<int>": [1, None],
    "map<string,int>": {"a": None},
    "struct<a:int,b:array<struct<c:string>>>": T.Row(a=None, b=[T.Row(c=None)]),
}


@pytest.mark.parametrize("data_type", VALUES)
def test_every_type_both_ways(spark, data_type):
    df = spark.createDataFrame([(VALUES[data_type],)], f"c {data_type}")
    tight = rb.set_nullable(df, "c", False)
    assert not tight.schema["c"].nullable
    assert tight.schema["c"].dataType == df.schema["c"].dataType
    relaxed = rb.set_nullable(tight, "c", True)
    assert relaxed.schema == df.schema
    assert relaxed.collect() == tight.collect() == df.collect()
    with pytest.raises(Exception, match="null in column c"):
        rb.set_nullable(df.select(F.lit(None).cast(data_type).alias("c")), "c", False).collect()


def test_odd_names(spark):
    df = spark.createDataFrame([("x",)], "`a.b ``c` string")
    assert not rb.set_nullable(df, "a.b `c", False).schema[0].nullable


@pytest.mark.parametrize("value", [
    "parse_json('{\"a\": 1}')", "INTERVAL '1 02:03:04' DAY TO SECOND", "INTERVAL '5' HOUR",
    "INTERVAL '1-2' YEAR TO MONTH", "INTERVAL '3' MONTH",
])
def test_variants_and_intervals_both_ways(spark, value):
    df = spark.range(1).selectExpr(f"if(id = 0, {value}, null) AS c")
    assert df.schema["c"].nullable
    tight = rb.set_nullable(df, "c", False)
    assert not tight.schema["c"].nullable
    assert tight.schema["c"].dataType == df.schema["c"].dataType
    same = tight.selectExpr("cast(c as string) c").collect()
    assert same == df.selectExpr("cast(c as string) c").collect()
    with pytest.raises(Exception, match="null in column c"):
        none = spark.range(1).selectExpr(f"if(id = 1, {value}, null) AS c")
        rb.set_nullable(none, "c", False).write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("shape", ["v", "struct(v, k) AS v", "array(v, null) AS v", "map(k, v) AS v"])
def test_vectors_are_tightened_without_python(spark, shape):
    arrays = spark.createDataFrame([(1, [1.0, 2.5]), (2, [])], "k int, a array<double>")
    vectors = arrays.select("k", F.when(F.col("k") < 9, array_to_vector("a")).alias("v"), F.lit("x").alias("z.z"))
    df = vectors.selectExpr("k", shape, "`z.z`").withColumn("v", F.when(F.col("k") > 0, F.col("v")))
    df = df.select("k", F.col("v").alias("v", metadata={"m": 1}), "`z.z`")
    assert df.schema["v"].nullable
    tight = rb.set_nullable(df, "v", False)
    assert tight.schema["v"] == T.StructField("v", df.schema["v"].dataType, False, {"m": 1})
    assert tight.schema["v"].metadata == {"m": 1} and tight.columns == df.columns
    assert tight.collect() == df.collect() and tight.filter("k = 2").count() == 1
    plan = tight._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert rb.set_nullable(tight, "v", True).schema["v"].nullable
    none = rb.set_nullable(df.withColumn("v", F.when(F.col("k") > 1, F.col("v"))), "v", False)
    for run in (none.collect, none.count):
        with pytest.raises(Exception, match="null in column v"):
            run()
