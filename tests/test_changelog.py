"""The change log that is merged on read, against the batch operator over all events."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.changes import apply_changes
from fleetlake.streaming import changelog as CL

T = dt.datetime
KIND = "id string, status string, eventTimestamp timestamp, cvssScore double, eventId bigint"
ORDER = ["eventTimestamp", "eventId"]


def _snapshot(spark, n=40):
    return spark.createDataFrame([(f"k{i}", "New", T(2024, 1, 1), float(i)) for i in range(n)], "id string, status string, eventTimestamp timestamp, cvssScore double")


def _batches(rng, n, size):
    out, event = [], 0
    for _ in range(n):
        rows = []
        for _ in range(size):
            event += 1
            hot = "k1" if rng.random() < 0.3 else f"k{rng.randrange(60)}"
            rows.append((hot, rng.choice(["New", "Updated", "Fixed"]), T(2023, 12, 25) + dt.timedelta(days=rng.randrange(30)), rng.random(), event))
        out.append(rows)
    return out


def _expected(spark, snap, batches):
    events = spark.createDataFrame([r for b in batches for r in b], KIND)
    return sorted(tuple(r) for r in apply_changes(snap.withColumn("eventId", F.lit(None).cast("bigint")), events, order=ORDER).collect())


def _read(spark, path, **how):
    return sorted(tuple(r) for r in CL.read_table(spark, path, **how).select("id", "status", "eventTimestamp", "cvssScore", "eventId").collect())


@pytest.mark.parametrize("share", [0.0, 0.5, 100.0])
def test_any_order_of_batches_and_compactions_leaves_the_state_of_the_batch_operator(spark, tmp, share):
    snap, rng = _snapshot(spark), random.Random(5)
    batches = _batches(rng, 5, 25)
    schema = spark.createDataFrame([], KIND).schema
    CL.create_table(snap, f"{tmp}/t", schema, order=ORDER, parts=5)
    for i, rows in enumerate(batches, 1):
        CL.append_changes(spark.createDataFrame(rows, KIND).repartition(3), f"{tmp}/t", i)
        if i in (2, 4):
            before = _read(spark, f"{tmp}/t", live_only=False)
            CL.compact(spark, f"{tmp}/t", share=share)
            assert _read(spark, f"{tmp}/t", live_only=False) == before
        assert _read(spark, f"{tmp}/t") == _expected(spark, snap, batches[:i])
    CL.append_changes(spark.createDataFrame(batches[4], KIND), f"{tmp}/t", 5)  # a replayed batch
    assert _read(spark, f"{tmp}/t") == _expected(spark, snap, batches)
    CL.drop_merged(spark, f"{tmp}/t")
    assert _read(spark, f"{tmp}/t") == _expected(spark, snap, batches)
    assert CL.compact(spark, f"{tmp}/t", share=0) or share == 0
    CL.drop_merged(spark, f"{tmp}/t")
    assert os.listdir(f"{tmp}/t/log") == ["batch=000000000005"]  # the last batch stays
    assert _read(spark, f"{tmp}/t") == _expected(spark, snap, batches)


def test_a_batch_writes_in_proportion_to_its_changes_and_compaction_touches_grown_or_old_parts(spark, tmp):
    snap = spark.range(20_000).selectExpr("concat('k', id) id", "'New' status", "timestamp'2024-01-01' eventTimestamp", "rand(1) cvssScore")
    CL.create_table(snap, f"{tmp}/t", spark.createDataFrame([], KIND).schema, order=ORDER, parts=10)
    one = [("k7", "Updated", T(2024, 2, 1), 1.0, 1)]
    CL.append_changes(spark.createDataFrame(one, KIND), f"{tmp}/t", 1)
    assert spark.read.parquet(f"{tmp}/t/log/batch=000000000001").count() == 1
    assert CL.compact(spark, f"{tmp}/t", share=0.1) == []  # one event in 2000 rows
    mine = spark.range(20_000).selectExpr("concat('k', id) id").withColumn("p", CL._part(["id"], 10)).where("p = 3")
    many = mine.selectExpr("id", "'Fixed' status", "timestamp'2024-03-01' eventTimestamp", "0.0d cvssScore", "2L eventId").limit(500)
    CL.append_changes(many, f"{tmp}/t", 2)
    assert CL.compact(spark, f"{tmp}/t", share=0.1) == [3]
    assert [x for x in os.listdir(f"{tmp}/t/base/v=000000000002.000001") if "=" in x] == ["part_no=3"]
    assert CL.read_table(spark, f"{tmp}/t").count() == 20_000 - 500
    part = spark.createDataFrame(one, KIND).select(CL._part(["id"], 10)).head()[0]
    assert CL.compact(spark, f"{tmp}/t", share=0.1, oldest=1) == ([part] if part != 3 else [])


def test_stream_with_restart_and_compaction(spark, tmp):
    snap, batches = _snapshot(spark), _batches(random.Random(8), 4, 20)
    schema = spark.createDataFrame([], KIND).schema
    CL.create_table(snap, f"{tmp}/t", schema, order=ORDER)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(f"{tmp}/delta")
        if i != 1:
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/delta")
            CL.append_changes_stream(stream, f"{tmp}/t", compact_every=3).awaitTermination()
    assert _read(spark, f"{tmp}/t") == _expected(spark, snap, batches)
    assert len([x for x in os.listdir(f"{tmp}/t/base") if x.startswith("v=")]) == 2


def test_empty_tables_null_keys_composite_keys_missing_and_extra_columns(spark, tmp):
    schema = spark.createDataFrame([], KIND).schema
    CL.create_table(_snapshot(spark).limit(0), f"{tmp}/e", schema, order=ORDER)
    assert _read(spark, f"{tmp}/e") == [] and CL.compact(spark, f"{tmp}/e") == [] and CL.drop_merged(spark, f"{tmp}/e") == 0
    CL.append_changes(spark.createDataFrame([], KIND), f"{tmp}/e", 1)
    CL.append_changes(spark.createDataFrame([(None, "New", T(2024, 1, 2), 1)], "id string, status string, eventTimestamp timestamp, eventId bigint").withColumn("x", F.lit(1)), f"{tmp}/e", 2)
    CL.compact(spark, f"{tmp}/e", share=0)
    CL.append_changes(spark.createDataFrame([(None, "Updated", T(2024, 1, 3), 2.0, 2)], KIND), f"{tmp}/e", 3)
    assert _read(spark, f"{tmp}/e") == [(None, "Updated", T(2024, 1, 3), 2.0, 2)]
    two = spark.createDataFrame([("a", 1, "New", T(2024, 1, 1)), ("a", 2, "New", T(2024, 1, 1))], "d string, s int, status string, eventTimestamp timestamp")
    CL.create_table(two, f"{tmp}/c", two.schema, key=["d", "s"], parts=3)
    CL.append_changes(two.where("s = 2").withColumn("status", F.lit("Fixed")).withColumn("eventTimestamp", F.lit(T(2024, 2, 1))), f"{tmp}/c", 1)
    assert [(r.d, r.s) for r in CL.read_table(spark, f"{tmp}/c").collect()] == [("a", 1)]
    with pytest.raises(ValueError, match="part_no"):
        CL.create_table(two.withColumn("part_no", F.lit(1)), f"{tmp}/x", two.schema, key="d")
    with pytest.raises(ValueError, match="from 1"):
        CL.append_changes(two, f"{tmp}/c", 0)


def test_the_base_is_not_shuffled_for_a_small_log(spark, tmp):
    schema = spark.createDataFrame([], KIND).schema
    CL.create_table(_snapshot(spark), f"{tmp}/t", schema, order=ORDER, parts=2)
    CL.append_changes(spark.createDataFrame(_batches(random.Random(1), 1, 20)[0], KIND), f"{tmp}/t", 1)
    plan = CL.read_table(spark, f"{tmp}/t")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
