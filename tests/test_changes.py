import datetime as dt

from pyspark.sql import functions as F

from fleetlake.operators.changes import apply_changes, changes_since, latest_per_key
from fleetlake.streaming import changefeed as CF

T = dt.datetime


def frames(spark):
    snap = spark.createDataFrame([("a", "New", T(2024, 1, 1), 1.0), ("b", "New", T(2024, 1, 1), 2.0),
                                  ("c", "New", T(2024, 1, 5), 3.0)],
                                 "id string, status string, eventTimestamp timestamp, cvssScore double")
    delta = spark.createDataFrame([("a", "Updated", T(2024, 1, 2), 5.0, 1), ("a", "Fixed", T(2024, 1, 3), 5.0, 2),
                                   ("b", "Updated", T(2024, 1, 2), 7.0, 3), ("b", "Updated", T(2024, 1, 2), 8.0, 4),
                                   ("c", "Fixed", T(2024, 1, 4), 0.0, 5), ("d", "New", T(2024, 1, 6), 9.0, 6)],
                                  "id string, status string, eventTimestamp timestamp, cvssScore double, eventId int")
    return snap, delta


def test_since_and_latest(spark):
    _, delta = frames(spark)
    assert changes_since(delta, T(2024, 1, 3)).count() == 3
    assert changes_since(delta, 3, now=T(2024, 1, 7)).count() == 2
    lat = {r.id: r.eventId for r in latest_per_key(delta, "id", ["eventTimestamp", "eventId"]).collect()}
    assert lat == {"a": 2, "b": 4, "c": 5, "d": 6}


def test_apply(spark):
    snap, delta = frames(spark)
    out = {r.id: (r.status, r.cvssScore) for r in apply_changes(snap, delta, order=["eventTimestamp", "eventId"]).collect()}
    # a fixed -> removed; b latest tie broken by eventId; c's Fixed is older than the snapshot row -> ignored; d added
    assert out == {"b": ("Updated", 8.0), "c": ("New", 3.0), "d": ("New", 9.0)}
    out2 = {r.id for r in apply_changes(snap, delta, order=["eventTimestamp", "eventId"], only_newer=False).collect()}
    assert out2 == {"b", "d"}


def test_stream_equals_batch(spark, tmp):
    snap, delta = frames(spark)
    delta.repartition(3).write.parquet(f"{tmp}/delta")
    CF.write_initial_snapshot(snap, f"{tmp}/snap")
    stream = spark.readStream.schema(delta.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/delta")
    q = CF.apply_changes_stream(stream, f"{tmp}/snap", order=["eventTimestamp", "eventId"], checkpoint=f"{tmp}/ckpt")
    q.awaitTermination()
    got = CF.latest_snapshot(spark, f"{tmp}/snap").select(*snap.columns)
    exp = apply_changes(snap, delta, order=["eventTimestamp", "eventId"])
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_late_events_in_later_triggers_empty_start_and_touched_parts(spark, tmp):
    """Three triggers, each older than the one before, onto an empty table: as X2 over all events."""
    snap, _ = frames(spark)
    kind = "id string, cveId string, status string, eventTimestamp timestamp, cvssScore double, eventId bigint"
    days = [[("k1", "c", "New", T(2024, 3, 9), 1.0, 9), ("k2", "c", "Fixed", T(2024, 3, 9), 1.0, 10)],
            [("k3", "c", "New", T(2024, 3, 2), 2.0, 3), ("k1", "c", "Fixed", T(2024, 3, 1), 1.0, 2)],
            [("k2", "c", "New", T(2024, 3, 1), 3.0, 1), ("k4", "c", "New", T(2023, 1, 1), 4.0, 0)]]
    CF.write_initial_snapshot(snap.limit(0), f"{tmp}/snap")
    assert CF.latest_snapshot(spark, f"{tmp}/snap").count() == 0
    for i, rows in enumerate(days):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp}/delta")
        stream = spark.readStream.schema(spark.read.parquet(f"{tmp}/delta").schema).parquet(f"{tmp}/delta")
        CF.apply_changes_stream(stream, f"{tmp}/snap", order=["eventTimestamp", "eventId"], checkpoint=f"{tmp}/ckpt").awaitTermination()
    everything = spark.createDataFrame([r for d in days for r in d], kind)
    exp = apply_changes(snap.limit(0), everything, order=["eventTimestamp", "eventId"])
    got = CF.latest_snapshot(spark, f"{tmp}/snap").select(*snap.columns)
    assert {r.id for r in got.collect()} == {"k1", "k3", "k4"}
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    parts = CF._listing(spark, f"{tmp}/snap")
    written = [f for v in sorted(__import__("os").listdir(f"{tmp}/snap")) if v > "v=000000000000" and v.startswith("v=") for f in __import__("os").listdir(f"{tmp}/snap/{v}") if "=" in f]
    assert len(parts) <= 4 and len(written) <= 6  # only what a batch touches is rewritten
    assert CF.drop_old_versions(spark, f"{tmp}/snap", keep=1) == len(written) - len(parts)
    assert CF.latest_snapshot(spark, f"{tmp}/snap").count() == 3


def test_window_counts(spark):
    _, delta = frames(spark)
    rows = {(r.windowStart.day, r.status): r.changes for r in CF.change_counts_batch(delta).collect()}
    assert rows[(2, "Updated")] == 3 and rows[(3, "Fixed")] == 1


def test_streamed_window_counts_match_batch_for_closed_windows(spark, tmp):
    _, delta = frames(spark)
    delta.write.parquet(f"{tmp}/d")
    stream = spark.readStream.schema(delta.schema).parquet(f"{tmp}/d")
    q = (CF.change_counts(stream, window="1 day", delay="1 hour").writeStream.outputMode("append")
         .format("memory").queryName("x4_counts").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.windowStart, r.status): r.changes for r in spark.table("x4_counts").collect()}
    batch = {(r.windowStart, r.status): r.changes for r in CF.change_counts_batch(delta, window="1 day").collect()}
    closed_before = max(r.eventTimestamp for r in delta.collect()) - dt.timedelta(hours=1)
    expected = {k: v for k, v in batch.items() if k[0] + dt.timedelta(days=1) <= closed_before}
    assert got == expected and len(expected) > 0
