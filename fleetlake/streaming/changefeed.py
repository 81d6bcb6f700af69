"""Change feed and export ingest as Structured Streaming.

* S12: landed export blobs are read incrementally (``maxFilesPerTrigger``
  bounds the work per micro-batch) and conformed. :func:`ingest_export` lands rows
  and malformed lines in two tables, a folder per micro-batch: a batch that is replayed
  after a loss overwrites its own folders, so with the checkpoint each blob counts once.
* X3: each micro-batch of vulnerability changes is applied to the snapshot
  table with the batch operator (X2), which takes repeats and late events in
  any order; no watermark stands before it. The snapshot lives in parts under a
  shared folder; a batch writes new versions of the parts it touches and the
  next batch reads them back, so lineage never grows across batches.
* X4: change counts per event-time window and status, append mode: a
  window is emitted once the watermark passes its end.

Checkpoint and table locations default to sub-folders of the session's
``spark.checkpoint.dir`` (shared storage on a cluster).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.scalars import redact_url
from ..operators.changes import DEFAULT_TERMINAL, apply_changes
from ..operators.conform import conform_to, wire_schema
from ..session import scratch_path
from ..sources.export import CORRUPT, SOURCE, Opener, decode_blobs, good_and_bad, opener_for, probe_lines


def read_export_stream(spark: SparkSession, directory: str, schema: StructType, *,
                       max_files_per_trigger: int = 100) -> DataFrame:
    """A streaming frame over NDJSON blobs landing in ``directory``, whose codec fits
    their name; a malformed line fails the query. :func:`ingest_export` has neither limit."""
    raw = (spark.readStream.schema(wire_schema(schema)).option("maxFilesPerTrigger", max_files_per_trigger)
                .option("mode", "FAILFAST").json(directory)
                .withColumn(SOURCE, redact_url(F.col("_metadata.file_path"))))
    return conform_to(raw, schema, keep=[SOURCE])


#: Bytes of blobs, packed as they may be, whose lines one task parses: gzip packs JSON lines ten times and more.
BLOB_BYTES_PER_TASK = 4 << 20

_BLOB = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_export(spark: SparkSession, directory: str, schema: StructType, table: str, *, checkpoint: str | None = None,
                  max_files_per_trigger: int = 100, opener: Opener | None = None, trigger: dict | None = None) -> StreamingQuery:
    """S12 with S2, S3, S10, S11: NDJSON blobs landing in ``directory`` -> rows and quarantined lines under ``table``.

    Every blob is taken once, by the codec that its first bytes tell, by tasks (:mod:`..sources.export`); ``_source``
    is redacted. A micro-batch holds at most ``max_files_per_trigger`` blobs and writes ``rows/batch=n``,
    ``quarantine/batch=n`` (malformed lines) and ``blobs/batch=n`` (``_source``, ``n_rows``, ``n_bad``: also
    of blank blobs; Spark passes over those of no bytes, which ``skipped_files`` finds from a manifest). ``checkpoint`` defaults to ``table/_checkpoint``: started again, the query goes on where it
    ended, and a batch that was cut off is written anew over its own folders.
    """
    opener = opener_for(spark, [directory], opener)
    blobs = (spark.readStream.format("binaryFile").schema(_BLOB).option("maxFilesPerTrigger", max_files_per_trigger)
                  .option("recursiveFileLookup", True).load(directory).select("path", "length", *([] if opener else ["content"])))

    def land(batch: DataFrame, batch_id: int) -> None:
        # a blob is decoded by one task; its lines, far larger than it, are parsed, kept and written by many
        tasks = 1 + (batch.agg(F.sum("length")).head()[0] or 0) // BLOB_BYTES_PER_TASK
        lines = decode_blobs(batch, opener)
        parsed = probe_lines(lines.repartition(tasks) if tasks > 1 else lines, schema).persist()
        try:
            good, bad = good_and_bad(parsed, schema)
            counts = good.select(SOURCE, F.lit(1).alias("g"), F.lit(0).alias("b")).unionByName(bad.select(SOURCE, F.lit(0).alias("g"), F.lit(1).alias("b")))
            counts = counts.unionByName(batch.select(redact_url("path").alias(SOURCE), F.lit(0).alias("g"), F.lit(0).alias("b")))
            counts = counts.groupBy(SOURCE).agg(F.sum("g").alias("n_rows"), F.sum("b").alias("n_bad"))
            for name, df in (("rows", good), ("quarantine", bad), ("blobs", counts)):
                df.write.mode("overwrite").parquet(os.path.join(table, name, f"batch={batch_id}"))
        finally:
            parsed.unpersist()

    query = blobs.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint or os.path.join(table, "_checkpoint"))
    return query.trigger(**(trigger or {"availableNow": True})).start()


def read_ingested(spark: SparkSession, table: str, schema: StructType) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, quarantined lines, blobs) that :func:`ingest_export` has landed so far, with the number of
    the ``batch``; empty where nothing has landed."""
    text = StructField(SOURCE, StringType())
    kinds = {"rows": StructType([*schema.fields, text]), "quarantine": StructType([text, StructField(CORRUPT, StringType())]),
             "blobs": StructType([text, StructField("n_rows", LongType()), StructField("n_bad", LongType())])}
    jvm = spark._jvm  # noqa: SLF001 - the file system that Spark itself uses
    out = []
    for name, kind in kinds.items():
        root = jvm.org.apache.hadoop.fs.Path(os.path.join(table, name))
        kind = StructType([*kind.fields, StructField("batch", LongType())])
        there = root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)  # noqa: SLF001
        out.append(spark.read.schema(kind).parquet(root.toString()) if there else spark.createDataFrame([], kind))
    return out[0], out[1], out[2]


def dedup_changes(changes: DataFrame, *, key: list[str] | None = None, event_time: str = "eventTimestamp",
                  delay: str = "1 hour") -> DataFrame:
    """Drop repeated change events (same key + event time) within the watermark."""
    return (changes.withWatermark(event_time, delay)
                   .dropDuplicatesWithinWatermark(key or ["id", event_time]))


def change_counts(changes: DataFrame, *, window: str = "1 day", event_time: str = "eventTimestamp",
                  status: str = "status", delay: str = "1 hour") -> DataFrame:
    """(window start, window end, status, changes) per event-time window."""
    return (changes.withWatermark(event_time, delay)
                   .groupBy(F.window(event_time, window), F.col(status))
                   .agg(F.count(F.lit(1)).alias("changes"))
                   .select(F.col("window.start").alias("windowStart"), F.col("window.end").alias("windowEnd"),
                           status, "changes"))


def change_counts_batch(changes: DataFrame, *, window: str = "1 day", event_time: str = "eventTimestamp",
                        status: str = "status") -> DataFrame:
    """X4 over a bounded delta export: the same windows without a watermark."""
    return (changes.groupBy(F.window(event_time, window), F.col(status))
                   .agg(F.count(F.lit(1)).alias("changes"))
                   .select(F.col("window.start").alias("windowStart"), F.col("window.end").alias("windowEnd"),
                           status, "changes"))


#: Parts of a stored snapshot; a batch rewrites only the parts that its keys fall into.
PARTS = 32


def _part(key: str, parts: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")


def _listing(spark: SparkSession, snapshot_path: str, before: int | None = None) -> dict[int, tuple[int, str]]:
    """part -> (version, folder) of the newest complete version of each part, from the folder
    listing (at most versions x parts names; :func:`drop_old_versions` keeps them few)."""
    jvm = spark._jvm  # noqa: SLF001 - the file system that Spark itself uses
    root = jvm.org.apache.hadoop.fs.Path(snapshot_path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    newest: dict[int, tuple[int, str]] = {}
    for v in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "v=*")) or []:
        version = int(v.getPath().getName()[2:])
        if (before is not None and version >= before) or not fs.exists(jvm.org.apache.hadoop.fs.Path(v.getPath(), "_SUCCESS")):
            continue
        for part in fs.listStatus(v.getPath()):
            name = part.getPath().getName()
            if name.startswith("part_no="):
                k = int(name[8:])
                if k not in newest or newest[k][0] < version:
                    newest[k] = (version, part.getPath().toString())
    return newest


def _read_parts(spark: SparkSession, snapshot_path: str, folders: list[tuple[int, str]]) -> DataFrame:
    """The rows of some parts; versions may differ in columns (order columns come with the first change)."""
    out = spark.read.parquet(os.path.join(snapshot_path, "schema"))
    by_version: dict[int, list[str]] = {}
    for version, folder in folders:
        by_version.setdefault(version, []).append(folder)
    for _, paths in sorted(by_version.items()):
        out = out.unionByName(spark.read.parquet(*paths), allowMissingColumns=True)
    return out


def _write_parts(df: DataFrame, snapshot_path: str, version: int, key: str, parts: int) -> None:
    (df.withColumn("part_no", _part(key, parts)).repartition("part_no").write.mode("overwrite")
       .partitionBy("part_no").parquet(os.path.join(snapshot_path, f"v={version:012d}")))


def apply_changes_stream(changes: DataFrame, snapshot_path: str, *, key: str = "id",
                         order: list[str] | None = None, terminal: tuple[str, ...] = DEFAULT_TERMINAL,
                         checkpoint: str | None = None, trigger: dict | None = None, parts: int = PARTS) -> StreamingQuery:
    """Apply each micro-batch of changes to the parquet snapshot at ``snapshot_path``.

    No event is late: applying changes is idempotent and takes only what is newer
    than the stored row, so repeated and older events, in any batch, leave the state
    that the batch operator (X2) gives over all of them. Keys removed by a terminal
    event stay as tombstones (an older event cannot bring them back) and are filtered
    out on read. The snapshot is kept in ``parts`` by a hash of the key; a batch reads
    and rewrites only the parts that it touches, as version ``batch + 1``. A replayed
    batch reads the versions before its own and rewrites the same one.
    """
    spark = changes.sparkSession
    ckpt = checkpoint or scratch_path(spark, "changefeed-checkpoint")

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            touched = sorted(r[0] for r in batch.select(_part(key, parts)).distinct().collect())  # at most `parts` numbers
            if not touched:
                return
            stored = _listing(spark, snapshot_path, before=batch_id + 1)
            current = _read_parts(spark, snapshot_path, [stored[k] for k in touched if k in stored])
            new = apply_changes(current, batch, key=key, order=order, terminal=terminal, keep_terminal=True)
            _write_parts(new, snapshot_path, batch_id + 1, key, parts)
        finally:
            batch.unpersist()

    w = changes.writeStream.foreachBatch(apply_batch).option("checkpointLocation", ckpt)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def latest_snapshot(spark: SparkSession, snapshot_path: str, *, live_only: bool = True, status: str = "status",
                    terminal: tuple[str, ...] = DEFAULT_TERMINAL) -> DataFrame:
    """The newest version of every part, found in the folder listing. Only versions that Spark's
    commit protocol has completed count."""
    snap = _read_parts(spark, snapshot_path, list(_listing(spark, snapshot_path).values()))
    if live_only:
        snap = snap.filter(~F.coalesce(F.col(status).isin(list(terminal)), F.lit(False)))
    return snap


def write_initial_snapshot(snapshot: DataFrame, snapshot_path: str, *, key: str = "id", parts: int = PARTS) -> None:
    """Version 0 of the snapshot table; it may be empty."""
    snapshot.limit(0).coalesce(1).write.mode("overwrite").parquet(os.path.join(snapshot_path, "schema"))
    _write_parts(snapshot, snapshot_path, 0, key, parts)


def drop_old_versions(spark: SparkSession, snapshot_path: str, *, keep: int = 2) -> int:
    """Remove parts that ``keep`` newer versions of the same part have replaced; the number of
    folders removed. To be called when no reader or batch is at work on those."""
    jvm = spark._jvm  # noqa: SLF001
    root = jvm.org.apache.hadoop.fs.Path(snapshot_path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    newest, dropped = _listing(spark, snapshot_path), 0
    versions: dict[int, list] = {}
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "v=*/part_no=*")) or []:
        versions.setdefault(int(st.getPath().getName()[8:]), []).append(st.getPath())
    for k, found in versions.items():
        complete = [p for p in found if k in newest and int(p.getParent().getName()[2:]) <= newest[k][0]]
        for p in sorted(complete, key=lambda p: int(p.getParent().getName()[2:]))[:-keep]:
            dropped += bool(fs.delete(p, True))
    return dropped
