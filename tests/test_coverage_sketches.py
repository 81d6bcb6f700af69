import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlake.operators import coverage as C
from fleetlake.operators import sketches as S

KIND = ("id STRING, n INT, score DOUBLE, at TIMESTAMP, on_ BOOLEAN, tags ARRAY<STRING>, box STRUCT<a: INT, deep: STRUCT<b: STRING>>, "
                          "items ARRAY<STRUCT<k: STRING, v: INT>>, never STRUCT<x: INT>")


def table(spark, records):
    texts = [(r if r is None or isinstance(r, str) else json.dumps(r),) for r in records]
    return {(r.path, r.kind): (r.records, r.status) for r in C.path_coverage(spark.createDataFrame(texts, "value string"), StructType.fromDDL(KIND)).collect()}


def test_coverage_counts_records_by_path_and_kind(spark):
    out = table(spark, [
        {"id": "1", "n": 3, "score": 2, "at": "2024-01-01", "on_": True, "tags": ["a", "b"], "box": {"a": 1, "deep": {"b": "x", "more": {"z": 1}}},
         "items": [{"k": "p"}, {"k": "q", "v": 2}]},
        {"id": 7, "n": "3", "score": 2.5, "tags": [], "box": {"deep": None}, "items": [{"k": 1}, {"k": "s", "w": 1}, None], "new.name": [1], "box.a": "t"},
        {"id": None, "tags": [1, "x"], "box": [1]}])
    assert out["$", "object"] == (3, "ok")
    assert (out["$.id", "text"], out["$.id", "integer"], out["$.id", "null"]) == ((1, "ok"), (1, "type"), (1, "null"))
    assert (out["$.n", "integer"], out["$.n", "text"], out["$.n", "absent"]) == ((1, "ok"), (1, "type"), (1, "absent"))
    assert (out["$.score", "integer"], out["$.score", "fraction"]) == ((1, "ok"), (1, "ok"))
    assert out["$.at", "text"] == (1, "ok") and out["$.at", "absent"] == (2, "absent")
    assert out["$.tags[]", "text"] == (2, "ok") and out["$.tags[]", "integer"] == (1, "type")
    assert out["$.box", "array"] == (1, "type") and out["$.box.a", "absent"] == (1, "absent")
    assert out["$.box.deep.more", "object"] == (1, "extra") and not any(p.startswith("$.box.deep.more.") for p, _ in out)
    assert out["$.items[].k", "integer"] == (1, "type") and out["$.items[].w", "integer"] == (1, "extra") and out["$.items[]", "null"] == (1, "null")
    assert out["$.items[].v", "integer"] == (1, "ok") and out["$.items[].v", "absent"] == (1, "absent")
    assert out["$['new.name']", "array"] == (1, "extra") and out["$['box.a']", "text"] == (1, "extra")  # no field of box
    assert out["$.never", "absent"] == (3, "missing") and out["$.never.x", "absent"] == (0, "missing")
    assert len(out) == len(set(out))


def test_coverage_of_odd_records(spark):
    out = table(spark, ['{"id": "cut', '{"id": 1, "id": 2}', None, "", " \t", [1], "3", "null", {}])
    assert out["$", "malformed"] == (2, "malformed")
    assert (out["$", "array"], out["$", "integer"], out["$", "null"], out["$", "object"]) == ((1, "type"), (1, "type"), (1, "null"), (1, "ok"))
    assert out["$.id", "absent"] == (1, "missing")
    none = table(spark, [])
    assert set(v for v in none.values()) == {(0, "missing")} and ("$.box.deep.b", "absent") in none
    assert {r.status for r in C.drift_evidence(C.path_coverage(spark.createDataFrame([('{"id": 1, "zz": null}',)], "value string"), StructType.fromDDL(KIND))).collect()} == {"type", "extra", "missing"}


def test_coverage_of_landed_files(spark, tmp):
    spark.createDataFrame([('{"value": [{"id": "1", "zz": 1}, {"id": "2"}]}',)], "value string").write.text(f"{tmp}/pages")
    spark.createDataFrame([('{"id": "1", "zz": 1}',), ('{"id": "2"}',)], "value string").write.text(f"{tmp}/lines")
    for path, layout in ((f"{tmp}/pages", "file"), (f"{tmp}/lines", "export")):
        out = {(r.path, r.kind): (r.records, r.status) for r in C.landed_coverage(spark, path, "machine", layout=layout).collect()}
        assert out["$.id", "text"] == (2, "ok") and out["$.zz", "integer"] == (1, "extra")


def test_stored_sketches_merge_and_replace(spark, tmp):
    day = dt.datetime(2024, 1, 1)
    rows = [("a", str(i), day + dt.timedelta(days=i % 3)) for i in range(3000)] + [("a", str(i), day) for i in range(0, 3000, 2)] + \
           [("b", None, day), ("c", "1", None), (None, "9", day)]
    df = spark.createDataFrame(rows, "k string, m string, t timestamp")
    S.store_sketches(df, f"{tmp}/s", key="k", value="m", time="t")
    kept = S.stored_sketches(spark, f"{tmp}/s")
    all_days = {r.id: r.approxCount for r in S.merged_counts(kept, ["id"]).collect()}
    assert abs(all_days["a"] - 3000) <= 3000 * 4 * S.relative_error() and (all_days["b"], all_days["c"], all_days[None]) == (0, 1, 1)
    later = {r.id: r.approxCount for r in S.merged_counts(kept, ["id"], since="2024-01-02", until="2024-01-03").collect()}
    assert set(later) == {"a"} and abs(later["a"] - 2000) <= 2000 * 4 * S.relative_error()
    S.store_sketches(df.where("k = 'a' and t = timestamp'2024-01-02'").limit(5), f"{tmp}/s", key="k", value="m", time="t")
    again = {r.id: r.approxCount for r in S.merged_counts(S.stored_sketches(spark, f"{tmp}/s"), ["id"], since="2024-01-02", until="2024-01-02").collect()}
    assert again == {"a": 5}
    S.store_sketches(df.where("false"), f"{tmp}/s", key="k", value="m", time="t")
    assert S.merged_counts(S.stored_sketches(spark, f"{tmp}/s"), ["id"]).count() == 4


def test_approx_cve_rollup(spark):
    df = spark.range(20000).select(F.concat(F.lit("CVE-"), (F.col("id") % 2).cast("string")).alias("cveId"), (F.col("id") % 7001).cast("string").alias("deviceId"))
    exact = {r.cveId: r.n for r in df.groupBy("cveId").agg(F.count_distinct("deviceId").alias("n")).collect()}
    got = {r.id: r.exposedMachines for r in S.approx_cve_rollup(df).collect()}
    assert set(got) == set(exact) and all(abs(got[k] - n) <= 4 * S.relative_error() * n for k, n in exact.items())
    assert S.approx_cve_rollup(df.where("false")).count() == 0
