"""Updates with several rows per key, rejected rows, many device groups, nested nullability,
slices past a boundary, hunting views, whole-result JSON."""
import json

import pytest
from fleetlake.operators import hunt, updates as U
from fleetlake.operators.conform import conform, empty_table
from fleetlake.operators.quality import nullability_report
from fleetlake.operators.sinks import to_json
from fleetlake.operators.slicing import skip
from fleetlake.plans.contracts import contract_names, declared

GROUPS = ("id int, priority int, deviceGroupName string, isUnassignedDeviceGroup boolean, deviceGroupRules "
          "struct<devicesNamesConditions:array<struct<condition:string,value:string>>,"
          "devicesDomainsConditions:array<struct<condition:string,value:string>>,"
          "devicesTagsConditions:array<struct<condition:string,value:string>>,"
          "devicesOsConditions:array<struct<condition:string,valuesList:array<string>>>>")


def test_patches_of_one_alert_merge_in_order(spark):
    alerts = conform(spark.createDataFrame([("a", "New"), ("b", "New")], "id string, status string"), "alert")
    ch = spark.createDataFrame([("a", 2, None, "bob", "c2"), ("a", 1, "InProgress", None, "c1"), ("a", 3, None, None, None)],
                               "alertId string, seq int, status string, assignedTo string, comment string")
    out = {r.id: r for r in U.patch_alerts(alerts, ch, seq="seq").collect()}
    assert (out["a"].status, out["a"].assignedTo, [c.comment for c in out["a"].comments]) == ("InProgress", "bob", ["c1", "c2"])
    assert out["b"].status == "New" and out["b"].comments is None
    later = spark.createDataFrame([("a", 1, "Resolved"), ("a", 2, "InProgress")], "alertId string, seq int, status string")
    assert {r.id: r.status for r in U.patch_alerts(alerts, later, seq="seq").collect()}["a"] == "InProgress"
    with pytest.raises(Exception, match="need an order"):
        U.patch_alerts(alerts, later.drop("seq")).collect()


def test_machine_fields_merge_in_order(spark):
    m = conform(spark.createDataFrame([("m1",)], "id string"), "machine")
    ch = spark.createDataFrame([("m1", 1, "High", True), ("m1", 2, None, False)], "id string, seq int, deviceValue string, isExcluded boolean")
    r = U.set_machine_fields(m, ch, ("deviceValue", "isExcluded"), seq="seq").head()
    assert (r.deviceValue, r.isExcluded) == ("High", False)


def test_alert_creation_rules(spark):
    machines = conform(spark.createDataFrame([("m1", "h1")], "id string, computerDnsName string"), "machine")
    fields = "machineId string, severity string, title string, description string, recommendedAction string, category string, eventTime string, reportId string"
    good = ("m1", "High", "t", "d", "r", "Malware", "2024-01-01T00:00:00Z", "7")
    rows = [good, ("m9", *good[1:]), (*good[:5], "Nonsense", *good[6:]), (*good[:5], "Unknown", *good[6:]), (*good[:2], None, *good[3:])]
    out, rejected = U.create_alerts(empty_table(spark, "alert"), spark.createDataFrame(rows, fields), machines)
    assert [(r.id, r.computerDnsName) for r in out.collect()] == [("ref_7_m1", "h1")] and rejected.count() == 4
    out, rejected = U.create_alerts(empty_table(spark, "alert"), spark.createDataFrame([good], fields).drop("title", "description"), machines)
    assert out.count() == 0 and rejected.head().errors == ["title is required", "description is required"]


def test_import_takes_the_last_of_several(spark):
    subs = spark.createDataFrame([(1, "1.1.1.1", "IpAddress", "Block"), (2, "1.1.1.1", "IpAddress", "Audit")], "n int, indicatorValue string, indicatorType string, action string")
    table, results = U.import_indicators(empty_table(spark, "indicator"), subs, order=["n"])
    assert [r.action for r in table.collect()] == ["Audit"] and [r.isFailed for r in results.collect()] == [False, False]
    with pytest.raises(Exception, match="need an order"):
        U.import_indicators(empty_table(spark, "indicator"), subs)[0].collect()
    table, results = U.import_indicators(empty_table(spark, "indicator"), subs.drop("action"), order=["n"])
    assert table.count() == 0 and {r.failureReason for r in results.collect()} == {"action is required"}
    with pytest.raises(Exception, match="need an order"):
        U.upsert(table, conform(subs, "indicator"), ["indicatorType", "indicatorValue"]).collect()


def test_thousands_of_device_groups(spark):
    n = 5000
    none = {"devicesNamesConditions": None, "devicesDomainsConditions": None, "devicesTagsConditions": None, "devicesOsConditions": None}
    rows = [(i, n - i, f"g{i}", False, {**none, "devicesNamesConditions": [{"condition": ("Equals", "StartsWith", "EndsWith", "Contains")[i % 4], "value": f"Host-{i}-"}]}) for i in range(n)]
    rows += [(n, 0, "nothing", False, none), (n + 1, 0, "both", False, {**none, "devicesTagsConditions": [{"condition": "Equals", "value": "x"}],
              "devicesOsConditions": [{"condition": None, "valuesList": ["Linux", "BSD"]}]}), (n + 2, -1, "odd", False, {**none, "devicesTagsConditions": [{"condition": "Like", "value": "x"}]}),
             (n + 3, 9, "rest", True, None)]
    groups = spark.createDataFrame(rows, GROUPS)
    m = conform(spark.createDataFrame([("a", "host-4-", None, None), ("b", "HOST-5-zz", ["y"], None), ("c", "q-host-6-", None, None), ("d", "q-host-7-q", None, None),
                                       ("e", "host-4-x", ["X"], "linux"), ("f", "host-4-x", ["X"], "mac"), ("g", None, None, None)],
                                      "id string, computerDnsName string, machineTags array<string>, osPlatform string"), "machine")
    out = U.assign_device_groups(spark, m, groups)
    assert {r.id: r.deviceGroupId for r in out.collect()} == {"a": 4, "b": 5, "c": 6, "d": 7, "e": n + 1, "f": n + 3, "g": n + 3}


@pytest.mark.parametrize("name", contract_names())
def test_nullability_of_every_contract(spark, name):
    rows = {r["column"]: r.violations for r in nullability_report(empty_table(spark, name), name).collect()}
    assert {f.name for f in declared(name).fields if not f.nullable} <= set(rows) and not any(rows.values())


def test_skip_without_top_has_no_single_task(spark, capsys):
    df = spark.createDataFrame([(i // 3, i, None if i % 5 else i) for i in range(60)], "a int, b int, c int").repartition(4)
    for names in (["a", "b"], ["c", "b"]):
        for n in (1, 7, 60, 100):
            want = df.orderBy(*names).collect()[n:]
            assert skip(df, n, names).collect() == want
    assert len(skip(df, 4, "a").collect()) == 56 and skip(df.limit(0), 4, "a").count() == 0
    skip(df, 7, ["a", "b"]).explain()
    plan = capsys.readouterr().out
    assert "GlobalLimit" not in plan.split("Subquery")[0] and "CartesianProduct" not in plan


def test_hunting_leaves_views_alone(spark):
    mine = spark.createDataFrame([(1,)], "x int")
    mine.createOrReplaceTempView("HuntT")
    other = spark.createDataFrame([(5,), (6,)], "x int")
    res = hunt.hunting_result(spark, "SELECT sum(x) AS s FROM HuntT JOIN Extra USING (x)", {"HuntT": other, "Extra": other})
    assert json.loads(res.to_json(10)) == [{"s": 11}] and res.to_dicts(5) == [{"s": 11}] and res.refresh().to_arrow(5).num_rows == 1
    assert spark.table("HuntT").collect()[0].x == 1 and "Extra" not in {t.name for t in spark.catalog.listTables()}
    spark.catalog.dropTempView("HuntT")


def test_whole_result_json(spark):
    df = spark.createDataFrame([("é", None), ("b", [1])], "id string, xs array<int>").coalesce(1)
    assert to_json(df, 5) == '[{"id":"é","xs":null},{"id":"b","xs":[1]}]'
    assert to_json(df, 1, indent=2) == json.dumps([{"id": "é", "xs": None}], indent=2, ensure_ascii=False)
