import pytest
from pyspark.sql.types import StructType

from fleetlake.operators import quality as Q


def test_nested_types_merge_and_conflicts_carry_their_path(spark):
    a = StructType.fromDDL("type STRING, box STRUCT<x: INT, in: STRUCT<p: STRING>>, items ARRAY<STRUCT<k: STRING>>, n INT")
    b = StructType.fromDDL("type STRING, box STRUCT<in: STRUCT<q: STRING>>, items ARRAY<STRUCT<k: STRING, v: BIGINT>>")
    merged, conflicts = Q.merge_nested_types([a, b])
    assert conflicts == [] and merged.simpleString() == (
        "struct<type:string,box:struct<x:int,in:struct<p:string,q:string>>,items:array<struct<k:string,v:bigint>>,n:int>")
    c = StructType.fromDDL("box STRUCT<x: STRING>, items ARRAY<STRUCT<k: INT>>, n STRUCT<z: INT>")
    merged, conflicts = Q.merge_nested_types([a, c])
    assert conflicts == [("box.x", "int", "string"), ("items[].k", "string", "int"), ("n", "int", "struct<z:int>")]
    assert merged.simpleString() == a.simpleString()
    assert Q.merge_nested_types([]) == (StructType([]), [])


def test_union_of_nested_variants(spark):
    a = spark.createDataFrame([("w", (1,), [("k1",)]), (None, None, None)], "type string, box struct<x:int>, items array<struct<k:string>>")
    b = spark.createDataFrame([("l", ("q",), [("k2", 5), None])], "type string, box struct<y:string>, items array<struct<k:string,v:int>>")
    out = {r.type: r.asDict(True) for r in Q.union_nested_variants([a, b]).collect()}
    assert out["w"]["box"] == {"x": 1, "y": None} and out["w"]["items"] == [{"k": "k1", "v": None}]
    assert out["l"]["box"] == {"x": None, "y": "q"} and out["l"]["items"] == [{"k": "k2", "v": 5}, None]
    assert out[None]["box"] is None and out[None]["items"] is None
    with pytest.raises(TypeError, match="box.x"):
        Q.union_nested_variants([a, spark.createDataFrame([(("t",),)], "box struct<x:string>")])
