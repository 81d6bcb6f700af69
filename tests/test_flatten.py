import json

from fleetlake.operators.flatten import apply_record_transform, flatten_av_health, rename_fields, unwrap

SCANS = json.dumps({"Quick": {"ScanStatus": "Completed", "ErrorCode": 0, "Timestamp": "2024-05-01T10:00:00Z"},
                    "Full": {"ScanStatus": "", "ErrorCode": "E1"}})


def run(spark, recs):
    df = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
    return [{k: v for k, v in r.asDict().items() if v is not None} for r in flatten_av_health(df).collect()]


def test_string_blob_with_scans_windows(spark):
    r = run(spark, [{"DeviceId": "d1", "DeviceName": "h", "OsPlatform": "Windows11", "Timestamp": "2024-05-02T00:00:00Z",
                     "DeviceGatheredInfo": json.dumps({"AvMode": "Normal", "AvScanResults": SCANS, "AvIsSignatureUptoDate": True})}])[0]
    assert r["id"] == "d1" and r["machineId"] == "d1" and r["computerDnsName"] == "h" and r["osKind"] == "windows"
    assert (r["quickScanResult"], r["quickScanError"], r["fullScanResult"], r["fullScanError"]) == ("Completed", "", "", "E1")
    assert "fullScanTime" not in r and r["quickScanTime"].hour == 10
    assert r["avIsSignatureUpToDate"] == "True" and r["avMode"] == "Normal"


def test_scans_non_windows_placeholder(spark):
    r = run(spark, [{"DeviceId": "d", "OsPlatform": "macOS13", "DeviceGatheredInfo": json.dumps({"AvScanResults": SCANS})}])[0]
    assert (r["quickScanError"], r["fullScanResult"]) == ("-", "-") and r["osKind"] == "mac"


def test_no_scans(spark):
    lin, win = run(spark, [{"DeviceId": "l", "OsPlatform": "Linux", "DeviceGatheredInfo": "{}"},
                           {"DeviceId": "w", "OsPlatform": "Windows10", "DeviceGatheredInfo": "{}"}])
    assert [lin.get(k) for k in ("quickScanResult", "quickScanError", "fullScanResult", "fullScanError")] == ["-"] * 4
    assert "quickScanResult" not in win


def test_bad_scans_set_nothing_even_non_windows(spark):
    r = run(spark, [{"DeviceId": "d", "OsPlatform": "linux", "DeviceGatheredInfo": json.dumps({"AvScanResults": "{oops"})}])[0]
    assert "quickScanResult" not in r


def test_full_not_object_keeps_quick(spark):
    scans = json.dumps({"Quick": {"ScanStatus": "OK"}, "Full": "bad"})
    r = run(spark, [{"DeviceId": "d", "OsPlatform": "Windows", "DeviceGatheredInfo": json.dumps({"AvScanResults": scans})}])[0]
    assert r["quickScanResult"] == "OK" and r["quickScanError"] == "" and "fullScanResult" not in r


def test_quick_not_object_sets_nothing(spark):
    scans = json.dumps({"Quick": "bad", "Full": {"ScanStatus": "OK"}})
    r = run(spark, [{"DeviceId": "d", "OsPlatform": "Windows", "DeviceGatheredInfo": json.dumps({"AvScanResults": scans})}])[0]
    assert "quickScanResult" not in r and "fullScanResult" not in r


def test_blob_forms(spark):
    obj, garbage, number = run(spark, [
        {"DeviceId": "a", "OsPlatform": "Windows", "DeviceGatheredInfo": {"AvMode": "Passive"}},
        {"DeviceId": "b", "OsPlatform": "Windows", "DeviceGatheredInfo": "not json"},
        {"DeviceId": "c", "OsPlatform": "Windows", "DeviceGatheredInfo": 5}])
    assert obj["avMode"] == "Passive" and "avMode" not in garbage and "avMode" not in number


def test_top_level_wins_even_null_and_preset_nested(spark):
    r = run(spark, [{"DeviceId": "d", "OsPlatform": "Linux", "avMode": None,
                     "DeviceGatheredInfo": {"AvMode": "Normal", "quickScanResult": "Kept"}}])[0]
    assert "avMode" not in r and r["quickScanResult"] == "Kept" and r["quickScanError"] == "-"


def test_oskind_and_id_rules(spark):
    a, b, c = run(spark, [{"machineId": "m", "id": "given", "osKind": "custom", "OsPlatform": "windows"},
                          {"DeviceId": "", "machineId": "m2", "OsPlatform": "Solaris"},
                          {"DeviceId": "d3", "osPlatform": "LinuxUbuntu"}])
    assert a["id"] == "given" and a["osKind"] == "custom"
    assert b["id"] == "m2" and "osKind" not in b
    assert c["osKind"] == "linux" and c["id"] == "d3"


def test_boolean_flags_and_strings_untouched(spark):
    r = run(spark, [{"DeviceId": "d", "AvIsEngineUptodate": False, "avIsPlatformUpToDate": "yes"}])[0]
    assert r["avIsEngineUpToDate"] == "False" and r["avIsPlatformUpToDate"] == "yes"


def test_unwrap_and_rename(spark):
    df = spark.createDataFrame([(1, {"id": "a", "name": "dev-a"})], "rbacGroupId int, DeviceGatheredInfo struct<id:string,name:string>")
    assert unwrap(df, "DeviceGatheredInfo").collect()[0].asDict() == {"rbacGroupId": 1, "id": "a", "name": "dev-a"}
    df2 = spark.createDataFrame([("top", {"id": "1", "name": "inner"})], "name string, wrapper struct<id:string,name:string>")
    assert unwrap(df2, "wrapper").collect()[0].asDict() == {"name": "top", "id": "1"}
    assert rename_fields(spark.createDataFrame([("x",)], "DeviceId string")).columns == ["machineId"]


def test_record_transform_hook(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 2}',)], "value string")
    assert apply_record_transform(df, None) is df
    out = apply_record_transform(df, lambda r: {**r, "b": r["a"] * 10})
    assert sorted(json.loads(r.value)["b"] for r in out.collect()) == [10, 20]
