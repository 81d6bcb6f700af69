import datetime as dt
import json

from pyspark.sql.types import StructType

from fleetlake.operators.conform import conform, conform_to, empty_table, wire_schema


def test_coercion_rules(spark):
    schema = StructType.fromDDL("n INT, x DOUBLE, b BOOLEAN, t TIMESTAMP, s STRING")
    rows = [("7", "1.5", "True", "2024-01-02T03:04:05.1234567Z", "a"),
            ("1.5", "x", "nope", "2024-01-02T03:04:05+00:00", None),
            ("7.0", None, "false", None, "b")]
    df = spark.createDataFrame(rows, "n string, x string, b string, t string, s string")
    out = conform_to(df, schema).collect()
    assert out[0].n == 7 and out[0].x == 1.5 and out[0].b is True
    assert out[0].t == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert out[1].n is None and out[1].x is None and out[1].b is None
    assert out[1].t == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert out[2].n is None and out[2].b is False


def test_order_missing_unknown_and_nested(spark):
    schema = StructType.fromDDL("id STRING, tags ARRAY<STRING>, u STRUCT<a: INT, b: STRING>, missing BIGINT")
    df = spark.createDataFrame([("1", json.dumps(["x", "y"]), '{"a": "3", "c": 1}', "junk")],
                               "id string, tags string, u string, extra string")
    r = conform_to(df, schema).collect()[0]
    assert r.asDict(recursive=True) == {"id": "1", "tags": ["x", "y"], "u": {"a": 3, "b": None}, "missing": None}


def test_struct_to_json_text_and_wire_schema(spark):
    df = spark.createDataFrame([({"k": 1},)], "m struct<k:int>")
    out = conform_to(df, StructType.fromDDL("m STRING")).collect()[0]
    assert json.loads(out.m) == {"k": 1}
    w = wire_schema(StructType.fromDDL("a INT, l ARRAY<STRUCT<x: BIGINT>>"))
    assert w.simpleString() == "struct<a:string,l:array<struct<x:string>>>"


def test_contract_conform_and_empty_table(spark):
    df = spark.createDataFrame([("m1", "Active", "7")], "id string, healthStatus string, rbacGroupId string")
    out = conform(df, "machine")
    assert out.columns[0] == "id" and len(out.columns) == 30
    assert out.collect()[0].rbacGroupId == 7
    e = empty_table(spark, "alert")
    assert e.count() == 0 and len(e.columns) == 31
