"""Remaining surface: streamed export ingest, page files, sinks, scan-definition and group updates."""
import datetime as dt
import gzip
import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlake.functions import predicates as P
from fleetlake.operators import quality as Q
from fleetlake.operators import updates as U
from fleetlake.operators.conform import conform
from fleetlake.operators.sinks import write_json, write_parquet
from fleetlake.operators.slicing import page_files
from fleetlake.streaming.changefeed import read_export_stream


def test_stream_ingest_exactly_once(spark, tmp):
    os.makedirs(f"{tmp}/in")
    for i in range(3):
        with gzip.open(f"{tmp}/in/b{i}.json.gz", "wt") as f:
            f.write(json.dumps({"id": f"m{i}", "rbacGroupId": str(i)}) + "\n")
    schema = StructType.fromDDL("id STRING, rbacGroupId INT")
    q = (read_export_stream(spark, f"{tmp}/in", schema, max_files_per_trigger=1).writeStream
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).format("parquet").start(f"{tmp}/out"))
    q.awaitTermination()
    with gzip.open(f"{tmp}/in/b3.json.gz", "wt") as f:
        f.write(json.dumps({"id": "m3", "rbacGroupId": "3"}) + "\n")
    q = (read_export_stream(spark, f"{tmp}/in", schema).writeStream
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).format("parquet").start(f"{tmp}/out"))
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp}/out")
    assert sorted((r.id, r.rbacGroupId) for r in out.collect()) == [("m0", 0), ("m1", 1), ("m2", 2), ("m3", 3)]


def test_page_files_and_sinks(spark, tmp):
    df = spark.range(25).withColumn("k", F.col("id") % 3)
    page_files(df.coalesce(1), f"{tmp}/pages", 10)
    files = [f for f in os.listdir(f"{tmp}/pages") if f.endswith(".json")]
    assert len(files) == 3 and spark.read.json(f"{tmp}/pages").count() == 25
    write_json(df, f"{tmp}/j", max_records_per_file=100)
    write_parquet(df, f"{tmp}/p", partition_by=["k"])
    assert spark.read.parquet(f"{tmp}/p").count() == 25 and spark.read.json(f"{tmp}/j").count() == 25


def test_since_day_and_by_id(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 2, 1))], "id string, t timestamp")
    assert [r.id for r in df.filter(P.since_day("t", "2024-01-15")).collect()] == ["b"]
    assert P.by_id(df, "a").count() == 1 and P.by_id(df, "zz").count() == 0


def test_landed_drift(spark, tmp):
    with open(f"{tmp}/m.json", "w") as f:
        f.write(json.dumps({"id": "m1", "healthStatus": "Active", "vendorExtra": 1}) + "\n")
    rows = {(r.path, r.kind) for r in Q.landed_drift(spark, [f"{tmp}/m.json"], "machine").collect()}
    assert ("vendorExtra", "extra") in rows and ("lastSeen", "missing") in rows


def test_scan_definitions_update(spark):
    auth = ("struct<keyVaultUri:string,keyVaultSecretName:string,type:string,username:string,password:string,"
            "domain:string,isgmsaUser:boolean,packetPrivacy:boolean,packetIntegrity:boolean,privateKey:string,"
            "communityString:string,authProtocol:string,authPassword:string,privProtocol:string,privPassword:string>")
    defs = conform(spark.createDataFrame([("d1", "Windows", "old", None)], f"id string, scanType string, scanName string, "
                                         f"scanAuthenticationParams {auth}"), "device_authenticated_scan_definition")
    ch = spark.createDataFrame([("d1", None, "renamed", None),
                                ("d2", "Linux", "new", (None, None, "PrivateKey", "u", None, None, None, None, None, "k",
                                                         None, None, None, None, None)),
                                ("d3", "Linux", "bad", (None, None, "PrivateKey", "u", None, "CORP", None, None, None,
                                                         None, None, None, None, None, None))],
                               f"id string, scanType string, scanName string, scanAuthenticationParams {auth}")
    out, rejected = U.update_scan_definitions(defs, conform(ch, "device_authenticated_scan_definition"))
    got = {r.id: (r.scanType, r.scanName) for r in out.collect()}
    assert got == {"d1": ("Windows", "renamed"), "d2": ("Linux", "new")}
    assert [r.id for r in rejected.collect()] == ["d3"]


def test_serialized_and_device_group_add_delete(spark):
    rows = spark.createDataFrame([('{"indicatorValue": "x", "action": "Block"}',)], "s string")
    parsed = U.parse_serialized(rows, "s", "indicatorValue string, action string")
    assert parsed.collect()[0].action == "Block"
    groups = conform(spark.createDataFrame([(1, 1, "a")], "id int, priority int, deviceGroupName string"), "device_group")
    new = conform(spark.createDataFrame([(1, 9, "dup"), (2, 2, "b")], "id int, priority int, deviceGroupName string"), "device_group")
    added = U.add_device_groups(groups, new)
    assert sorted((r.id, r.deviceGroupName) for r in added.collect()) == [(1, "a"), (2, "b")]
    assert [r.id for r in U.delete_device_groups(added, spark.createDataFrame([(1,)], ["x"])).collect()] == [2]
