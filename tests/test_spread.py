"""Work is dealt over tasks where few rows or bytes come in and many go out."""
import gzip
import json
import os
import random

from pyspark.sql import functions as F

from fleetlake import reports
from fleetlake.operators import relate, stats
from fleetlake.operators import updates as U
from fleetlake.operators.conform import conform
from fleetlake.plans.contracts import contract
from fleetlake.plans.joins import SPREAD_TASKS, spread
from fleetlake.streaming import changefeed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def by_number(df, *columns) -> int:
    """Shuffles by ``columns`` of a given number of partitions, which AQE neither merges nor drops."""
    return sum(all(f"{c}#" in line for c in columns) for line in plan(df).split("\n")
               if "Exchange hashpartitioning" in line and "REPARTITION_BY_NUM" in line)


def test_spread_keeps_its_tasks_whatever_the_bytes(spark):
    rows = spark.range(0, 4000, 1, 1).select((F.col("id") % 1000).alias("k"))
    for out in (spread(rows), spread(rows, "k")):
        assert out.rdd.getNumPartitions() == SPREAD_TASKS and out.count() == 4000
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > SPREAD_TASKS // 2


def groups_and_machines(spark):
    rule = F.struct(F.array(F.struct(F.col("test").alias("condition"), F.col("value"))).alias("devicesNamesConditions"))
    g = spark.createDataFrame([(1, 5, "StartsWith", "pc"), (2, 1, "EndsWith", "9"), (3, 0, "Contains", "-77")], "id int, priority int, test string, value string")
    g = conform(g.select("id", "priority", F.lit(False).alias("isUnassignedDeviceGroup"), rule.alias("deviceGroupRules")), "device_group")
    m = spark.range(0, 1000, 1, 1).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("pc-"), F.col("id")).alias("computerDnsName"))
    return g, conform(m.unionByName(spark.createDataFrame([(None, "pc-9")], "id string, computerDnsName string")), "machine")


def test_device_groups_spread_machines_before_their_keys(spark):
    g, m = groups_and_machines(spark)
    out = U.assign_device_groups(spark, m, g)
    assert by_number(out, "_mid") == 1
    want = {str(i): 3 if str(i).startswith("77") else 2 if i % 10 == 9 else 1 for i in range(1000)}
    assert {r.id: r.deviceGroupId for r in out.collect()} == {**want, None: None}


def test_many_rules_are_joined_in_parts(spark, monkeypatch):
    g, m = groups_and_machines(spark)
    few = {r.id: r.deviceGroupId for r in U.assign_device_groups(spark, m, g).collect()}
    monkeypatch.setattr(U, "BROADCAST_MAX_BYTES", 0)
    out = U.assign_device_groups(spark, m, g)
    assert "_part#" in plan(out) and "SortMergeJoin [kind" in plan(out) and {r.id: r.deviceGroupId for r in out.collect()} == few


def test_pattern_groups_spread_machines(spark):
    assert by_number(reports.device_group_patterns(spark, "/root/testdata/sf0.001"), "_mid") == 1


def test_remediation_progress_is_spread_by_pair(spark):
    rng = random.Random(5)
    ids, recs = [*map(str, range(30)), None], [*(f"r{i}" for i in range(6)), None]
    rows = [(rng.choice(ids), rng.choice(recs), rng.random() < 0.4) for _ in range(300)]
    inv = conform(spark.createDataFrame(rows, "deviceId string, recommendationReference string, securityUpdateAvailable boolean"), "asset_vulnerability")
    machines = conform(spark.createDataFrame([(i,) for i in ids if i != "7"], "id string"), "machine")
    tasks = conform(spark.createDataFrame([(f"t{i}", f"r{i % 4}") for i in range(6)] + [("none", None)], "id string, recommendationReference string"), "remediation_task")
    targets = relate.remediation_machines(tasks, inv, machines)
    out = stats.remediation_progress(targets, inv.where("securityUpdateAvailable"))
    assert by_number(out, "recommendationId", "id") >= 3  # pairs, targets, open ones
    want = {}
    for t in range(6):
        aimed = {d for d, r, _ in rows if r == f"r{t % 4}" and d not in (None, "7")}
        still = {d for d, r, o in rows if r == f"r{t % 4}" and o}
        want[f"t{t}"] = (len(aimed), len(aimed - still))
    assert {r.id: (r.targetDevices, r.fixedDevices) for r in out.collect()} == want


def test_lines_of_a_large_blob_are_parsed_by_several_tasks(spark, tmp, monkeypatch):
    monkeypatch.setattr(changefeed, "BLOB_BYTES_PER_TASK", 2000)
    folder, table, kind = f"{tmp}/landed", f"{tmp}/table", contract("machine")
    os.makedirs(folder)
    lines = "".join(json.dumps({"id": str(i), "healthStatus": "Active"}) + "\n" for i in range(4000)) + '{"id": "cut\n'
    with open(f"{folder}/a.json.gz", "wb") as f:
        f.write(gzip.compress(lines.encode()))
    changefeed.ingest_export(spark, folder, kind, table).awaitTermination()
    rows, bad, blobs = changefeed.read_ingested(spark, table, kind)
    assert sorted(int(r.id) for r in rows.collect()) == list(range(4000)) and bad.count() == 1
    assert [(r.n_rows, r.n_bad) for r in blobs.collect()] == [(4000, 1)]
    assert len(rows.inputFiles()) > 2  # one task wrote one before


def test_landed_blobs_are_bounded(spark, tmp, monkeypatch):
    monkeypatch.setattr(reports, "_BLOB_ROWS", 300)
    reports._land_blobs(spark, spark.range(0, 1000, 1, 1).select(F.col("id").cast("string").alias("value")), f"{tmp}/blobs", "even", "gzip", ".json")
    sizes = [len(gzip.open(f"{tmp}/blobs/{n}").read().split()) for n in os.listdir(f"{tmp}/blobs") if not n.startswith(".")]
    assert sorted(sizes) == [100, 300, 300, 300]


def test_sketched_prevalence_nests_the_evidence_once(spark):
    out = reports.domain_prevalence_sketched(spark, "/root/testdata/sf0.001")
    assert "collect_list" not in plan(out) and "Expand" not in plan(out)
    assert out.count() and all(r.withinError and r.machines1995 <= r.machines for r in out.collect())
