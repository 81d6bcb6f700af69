import pytest
from pyspark.sql import functions as F

from fleetlake.operators import updates as U
from fleetlake.operators.conform import conform


def alerts(spark):
    df = spark.createDataFrame([("a1", "New", "High", "m1"), ("a2", "New", "Low", "m2")],
                               "id string, status string, severity string, machineId string")
    return conform(df, "alert")


def test_patch_alerts_and_comment(spark):
    ch = spark.createDataFrame([(["a1"], "InProgress", "soc", "look", "me", "2024-01-01 00:00:00")],
                               "alertIds array<string>, status string, assignedTo string, comment string, "
                               "createdBy string, createdTime string")
    out = {r.id: r for r in U.patch_alerts(alerts(spark), ch).collect()}
    assert out["a1"].status == "InProgress" and out["a1"].assignedTo == "soc" and out["a1"].comments[0].comment == "look"
    assert out["a2"].status == "New" and out["a2"].comments is None
    bad = spark.createDataFrame([("a1", "Sleeping")], "alertId string, status string")
    with pytest.raises(Exception, match="outside domain"):
        U.patch_alerts(alerts(spark), bad).collect()


def test_create_alerts(spark):
    m = conform(spark.createDataFrame([("m1", "host1")], "id string, computerDnsName string"), "machine")
    req = spark.createDataFrame([("m1", "High", "t", "d", "r", "2024-01-01T00:00:00Z", "rep1", "Malware"),
                                 ("m1", "High", "t", "d", "r", "2024-01-01T00:00:00Z", "rep2", "UnknownThing")],
                                "machineId string, severity string, title string, description string, "
                                "recommendedAction string, eventTime string, reportId string, category string")
    out, rejected = U.create_alerts(alerts(spark), req, m)
    assert out.count() == 3 and rejected.count() == 1
    assert out.filter("id = 'ref_rep1_m1'").collect()[0].computerDnsName == "host1"


def test_import_delete_upsert(spark):
    empty = spark.createDataFrame([], conform(spark.range(0).selectExpr("'x' AS id"), "indicator").schema)
    subs = spark.createDataFrame([("http://a", "Url", "Block", "t"), ("", "Url", "Block", "t"), ("1.2.3.4", "IpAddress", "Nope", "t")],
                                 "indicatorValue string, indicatorType string, action string, title string")
    table, results = U.import_indicators(empty, subs)
    assert table.count() == 1
    res = {r.indicator: (r.isFailed, r.failureReason) for r in results.collect()}
    assert res["http://a"] == (False, None) and res[""][0] and "action" in res["1.2.3.4"][1]
    remaining, found = U.delete_by_ids(alerts(spark), spark.createDataFrame([("a1",), ("zz",)], ["x"]))
    assert remaining.count() == 1 and {r.id: r.found for r in found.collect()} == {"a1": True, "zz": False}
    t = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    c = spark.createDataFrame([("k2", 20, 1), ("k2", 21, 2), ("k3", 3, 1)], "k string, v int, seq int")
    assert sorted(U.upsert(t, c, "k", order=["seq"]).collect()) == [("k1", 1), ("k2", 21), ("k3", 3)]


def test_tags_and_fields(spark):
    m = conform(spark.createDataFrame([("m1", ["a"]), ("m2", None), ("m3", ["b"])], "id string, machineTags array<string>"), "machine")
    ch = spark.createDataFrame([("x", "Add", ["m1", "m2"]), ("a", "Remove", ["m1"])], "Value string, Action string, MachineIds array<string>")
    out = {r.id: r.machineTags for r in U.tag_machines(m, ch).collect()}
    assert out == {"m1": ["x"], "m2": ["x"], "m3": ["b"]}
    ch2 = spark.createDataFrame([("m1", "High")], "id string, deviceValue string")
    out2 = {r.id: r.deviceValue for r in U.set_machine_fields(m, ch2, ("deviceValue",), {"deviceValue": "DEVICE_VALUE"}).collect()}
    assert out2["m1"] == "High" and out2["m2"] is None
    ch3 = spark.createDataFrame([("m1", "Low", 2), ("m1", "High", 1)], "id string, deviceValue string, n int")
    out3 = {r.id: r.deviceValue for r in U.set_machine_fields(m, ch3, ("deviceValue",), seq="n").collect()}
    assert out3["m1"] == "Low"


def test_device_groups(spark):
    m = conform(spark.createDataFrame([("m1", "web01.corp.local", ["prod"], "Windows10"),
                                       ("m2", "db01.lab.local", ["dev"], "Linux")],
                                      "id string, computerDnsName string, machineTags array<string>, osPlatform string"), "machine")
    g = spark.createDataFrame([
        (1, 10, "web", False, {"devicesNamesConditions": [{"condition": "StartsWith", "value": "web"}], "devicesDomainsConditions": None,
                               "devicesTagsConditions": [{"condition": "Equals", "value": "prod"}], "devicesOsConditions": None}),
        (2, 5, "linux", False, {"devicesNamesConditions": None, "devicesDomainsConditions": [{"condition": "EndsWith", "value": "local"}],
                                "devicesTagsConditions": None, "devicesOsConditions": [{"condition": "In", "valuesList": ["Linux"]}]}),
        (9, 99, "rest", True, None)],
        "id int, priority int, deviceGroupName string, isUnassignedDeviceGroup boolean, deviceGroupRules "
        "struct<devicesNamesConditions:array<struct<condition:string,value:string>>,"
        "devicesDomainsConditions:array<struct<condition:string,value:string>>,"
        "devicesTagsConditions:array<struct<condition:string,value:string>>,"
        "devicesOsConditions:array<struct<condition:string,valuesList:array<string>>>>")
    out = {r.id: r.deviceGroupId for r in U.assign_device_groups(spark, m, conform(g, "device_group")).collect()}
    assert out == {"m1": 1, "m2": 2}
