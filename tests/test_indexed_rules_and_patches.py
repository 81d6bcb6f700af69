"""Device-group rules, dense numbering, ordered deep merges, serialized rows and inferred results on odd input."""
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import updates as U
from fleetlake.operators.conform import conform, empty_table
from fleetlake.operators.slicing import assign_batches, number_rows
from fleetlake.sources.pages import _struct_of, scan_inferred

TESTS = {"StartsWith": str.startswith, "EndsWith": str.endswith, "Contains": lambda v, p: p in v, "Equals": str.__eq__}
RULES = "struct<devicesNamesConditions:array<struct<condition:string,value:string>>,devicesTagsConditions:array<struct<condition:string,value:string>>>"


def brute_groups(machines, groups):
    out = {}
    for mid, name, tags in machines:
        best = None
        for gid, priority, names, labels in groups:
            lists = [(names, [name]), (labels, tags or [])]
            lists = [(rules, values) for rules, values in lists if rules]
            fits = lists and all(any(v is not None and p is not None and TESTS[c](v.lower(), p.lower()) for c, p in rules for v in values) for rules, values in lists)
            if fits and (best is None or (priority, gid) < best):
                best = (priority, gid)
        out[mid] = best and best[1]
    return out


def group_frame(spark, groups):
    rows = [(g, p, f"g{g}", False, (n, t)) for g, p, n, t in groups]
    return conform(spark.createDataFrame(rows, f"id int, priority int, deviceGroupName string, isUnassignedDeviceGroup boolean, deviceGroupRules {RULES}"), "device_group")


def machine_frame(spark, machines):
    return conform(spark.createDataFrame(machines, "id string, computerDnsName string, machineTags array<string>"), "machine")


def test_rules_against_all_pairs(spark):
    rng = random.Random(9)
    word = lambda most: "".join(rng.choice("abÉ1.") for _ in range(rng.randint(0, most)))
    machines = [(f"m{i}", rng.choice([None, word(6), word(50), word(6)]), rng.choice([None, [], [word(4)], [word(4), None, word(9)]])) for i in range(150)]
    rule = lambda: (rng.choice(list(TESTS)), rng.choice([None, word(2), word(4), word(6), word(40)]))
    long = [m[1] for m in machines if m[1] and len(m[1]) > 40]
    groups = [(g, rng.randint(1, 5), rng.choice([None, [], [rule() for _ in range(rng.randint(1, 3))]]), rng.choice([None, None, [rule()]])) for g in range(120)]
    groups += [(200, 1, [("StartsWith", long[0][:39].upper())], None), (201, 0, [("EndsWith", long[0][-38:])], None), (202, 9, [("Contains", "")], None)]
    out = U.assign_device_groups(spark, machine_frame(spark, machines), group_frame(spark, groups))
    assert {r.id: r.deviceGroupId for r in out.select("id", "deviceGroupId").collect()} == brute_groups(machines, groups)


def test_many_rules_meet_only_their_machines(spark):
    machines = [(f"m{i}", f"host{i:05d}.corp", None) for i in range(2000)]
    groups = [(g, g, [("Contains", f"t{g:05d}.")], None) for g in range(0, 10_000, 2)]
    out = U.assign_device_groups(spark, machine_frame(spark, machines), group_frame(spark, groups))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.deviceGroupId for r in out.collect()} == {f"m{i}": i if i % 2 == 0 else None for i in range(2000)}


def test_no_groups(spark):
    out = U.assign_device_groups(spark, machine_frame(spark, [("m", "a", None)]), empty_table(spark, "device_group"))
    assert [r.deviceGroupId for r in out.collect()] == [None]


@pytest.mark.parametrize("n,parts", [(0, 1), (1, 4), (500, 3), (1000, 4), (2345, 7)])
def test_batches_are_full(spark, n, parts):
    df = spark.range(n).select((F.col("id") % 7).alias("k"), "id", F.lit("x").alias("_row")).repartition(parts)
    sizes = sorted(r["count"] for r in assign_batches(df, 500).groupBy("batchId").count().collect())
    assert sizes == sorted([500] * (n // 500) + ([n % 500] if n % 500 else []))
    out = number_rows(df, order_by=["k", F.col("id").desc()]).collect()
    assert [r.id for r in sorted(out, key=lambda r: r.rowNumber)] == sorted(range(n), key=lambda i: (i % 7, -i))
    assert sorted(r.rowNumber for r in out) == list(range(n)) and (not out or out[0].__fields__ == ["k", "id", "_row", "rowNumber"])


def test_batch_size_is_checked(spark):
    with pytest.raises(ValueError, match="size"):
        assign_batches(spark.range(3), 0)


KIND = "id string, name string, auth struct<type:string,user:string,net:struct<zone:string,port:int>>, tags array<string>"
GROUPS = {"a1": "a", "a2": "a", "b1": "b"}


def one_by_one(table, changes):
    """Apply changes in order; another variant of ``auth`` clears it first."""
    state = {r[0]: json.loads(json.dumps(r)) for r in table}
    for _, change in sorted(changes, key=lambda c: c[0]):
        i, name, auth, tags = change
        if i is None:
            continue
        now = state.setdefault(i, [i, None, None, None])
        if auth is not None:
            old = now[2] or [None, None, None]
            if auth[0] is not None and old[0] is not None and GROUPS[auth[0]] != GROUPS[old[0]]:
                old = [None, None, None]
            net = [a if a is not None else b for a, b in zip(auth[2] or (None, None), old[2] or (None, None))]
            now[2] = [auth[0] or old[0], auth[1] if auth[1] is not None else old[1], net if any(x is not None for x in net) else None]
        now[1], now[3] = name if name is not None else now[1], tags if tags is not None else now[3]
    return {i: (r[1], r[2] and tuple(None if x is None else tuple(x) if isinstance(x, list) else x for x in r[2]), r[3]) for i, r in state.items()}


def test_deep_patch_equals_one_by_one(spark):
    rng = random.Random(4)
    maybe = lambda x: x if rng.random() < 0.5 else None

    def auth(tagged):
        tag = rng.choice(list(GROUPS)) if tagged else maybe(rng.choice(list(GROUPS)))
        return maybe((tag, maybe(f"u{rng.randint(0, 99)}"), rng.choice([None, ("z", None), ("y", 3), (None, rng.randint(1, 9))])))

    for _ in range(4):
        table = [(f"d{i}", f"n{i}", auth(True), maybe(["t"])) for i in range(30)]
        changes = [(k, (maybe(f"d{rng.randint(0, 40)}"), maybe(f"c{k}"), auth(False), maybe([str(k)]))) for k in range(200)]
        ch = spark.createDataFrame([(*c, k) for k, c in changes], KIND + ", seq int").repartition(3)
        out = U.deep_patch(spark.createDataFrame(table, KIND), ch, seq="seq", tags={"auth": ("type", GROUPS)}).collect()
        got = {r.id: (r.name, r.auth and (r.auth.type, r.auth.user, r.auth.net and tuple(r.auth.net)), r.tags) for r in out}
        want = one_by_one(table, changes)
        empty = (None, None, None)
        assert {i: (n, a if a != empty else None, t) for i, (n, a, t) in got.items()} == {i: (n, a if a != empty else None, t) for i, (n, a, t) in want.items()}


def test_several_changes_need_an_order(spark):
    table = spark.createDataFrame([("d", "n", None, None)], KIND)
    changes = spark.createDataFrame([("d", "a", None, None), ("d", "b", None, None)], KIND)
    with pytest.raises(Exception, match="need an order"):
        U.deep_patch(table, changes).collect()
    assert U.deep_patch(table, changes.limit(0)).collect() == table.collect()


def test_serialized_rows(spark):
    texts = ['{"a": 1, "b": {"c": "x"}}', '{"a": "one"}', "{cut", None, "", "[1]", "3", "null", '{"other": 1}', '{"a": null}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, s string")
    good, bad = U.split_serialized(df, "s", "a int, b struct<c:string>")
    assert sorted(map(str, good.collect())) == sorted(["Row(a=1, b=Row(c='x'))", "Row(a=None, b=None)", "Row(a=None, b=None)"])
    assert {r.n: r.reason for r in bad.collect()} == {1: "a value does not fit its type", 2: "not JSON", 3: "no text", 4: "not JSON", 5: "not a JSON object",
                                                     6: "not a JSON object", 7: "not a JSON object"}
    assert U.parse_serialized(df.where("n in (0, 8)"), "s", "a int").count() == 2
    with pytest.raises(Exception, match="not JSON"):
        U.parse_serialized(df.where("n in (0, 2)"), "s", "a int").collect()


def test_device_groups_of_one_id(spark):
    new = conform(spark.createDataFrame([(5, 1, "a", 1), (5, 1, "b", 2), (6, 1, "c", 1)], "id int, priority int, deviceGroupName string, n int"), "device_group", keep=["n"])
    none = empty_table(spark, "device_group")
    assert sorted((r.id, r.deviceGroupName) for r in U.add_device_groups(none, new, order=["n"]).collect()) == [(5, "b"), (6, "c")]
    with pytest.raises(Exception, match="need an order"):
        U.add_device_groups(none, new).collect()


def test_alert_requests_are_idempotent(spark):
    fields = "machineId string, severity string, title string, description string, recommendedAction string, category string, eventTime string, reportId string"
    row = lambda title, time: ("m1", "High", title, "d", "r", "Malware", time, "7")
    asked = spark.createDataFrame([row("first", "2024-01-01T00:00:00Z"), row("first", "2024-01-01T00:00:00Z"), row("later", "2024-01-02T00:00:00Z")], fields)
    machines = machine_frame(spark, [("m1", "host", None)])
    out, rejected = U.create_alerts(empty_table(spark, "alert"), asked, machines)
    assert [(r.id, r.title, r.computerDnsName) for r in out.collect()] == [("ref_7_m1", "later", "host")] and rejected.count() == 0
    again, _ = U.create_alerts(out, asked, machines)
    assert again.count() == 1


def responses(tmp, *bodies):
    os.makedirs(f"{tmp}/r")
    for k, body in enumerate(bodies):
        with open(f"{tmp}/r/{k}.json", "w") as f:
            f.write(body)
    return f"{tmp}/r"


def test_inferred_results(spark, tmp):
    path = responses(tmp, '{"Schema": [], "Results": []}', json.dumps({"Results": [
        {"a": 1, "b`c d": "x", "VOID": {"VARIANT": 1}, "n": None}, {"a": "m", "b`c d": None, "VOID": {"VARIANT": [1]}}, None, {"a": {"deep": 1.5}, "list": [1, "q"]}]}))
    df = scan_inferred(spark, path)
    assert sorted(df.columns) == ["VOID", "a", "b`c d", "list", "n"]
    assert Counter(map(str, df.select("a", F.col("VOID").getField("VARIANT").alias("v"), "list", "n", "`b``c d`").collect())) == Counter([
        "Row(a='1', v='1', list=None, n=None, b`c d='x')", "Row(a='m', v='[1]', list=None, n=None, b`c d=None)",
        "Row(a='{\"deep\":1.5}', v=None, list=['1', 'q'], n=None, b`c d=None)"])


def test_inferred_without_rows(spark, tmp):
    df = scan_inferred(spark, responses(tmp, '{"Schema":[],"Results":[]}'))
    assert df.columns == [] and df.count() == 0
    typed = scan_inferred(spark, responses(f"{tmp}/x", '{"Schema":[{"Name":"Timestamp","Type":"DateTime"},{"Name":"n","Type":"Int64"},{"Name":"d","Type":"Dynamic"}],"Results":[]}'))
    assert {f.name: f.dataType.simpleString() for f in typed.schema} == {"Timestamp": "timestamp", "n": "bigint", "d": "string"} and typed.count() == 0
    with pytest.raises(ValueError, match="objects"):
        scan_inferred(spark, responses(f"{tmp}/y", '{"Results":[1,2]}'))


def test_struct_text():
    assert _struct_of("OBJECT<VOID: BIGINT, `OBJECT<`: OBJECT<VARIANT: VARIANT>, z: ARRAY<VOID>>") == "STRUCT<VOID: BIGINT, `OBJECT<`: STRUCT<VARIANT: STRING>, z: ARRAY<STRING>>"
