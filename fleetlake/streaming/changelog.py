"""Change log over a snapshot, merged on read (X3 for tables too large to rewrite).

A table is a folder:

* ``layout``: one row of what readers need (key, order columns, terminal states, parts, columns).
* ``base/v=n.k/part_no=p``: rows of part ``p`` (a hash of the key) with all batches up to ``n`` applied;
  ``k`` numbers the compactions, so none touches what another one wrote.
* ``log/batch=n``: the latest event per key of micro-batch ``n``, sorted by part.

A batch writes as many rows as it has keys, whatever the size of the table. A read takes the newest base of
each part and the log beyond it: the base is looked up in the reduced log, which Spark
broadcasts while it is small, so the base is not shuffled. :func:`compact` folds the log into those parts
where it has grown to a share of the base, or got old; so a base row is rewritten once per that share of
changes. Spark's ``_SUCCESS`` file decides what counts; a batch that is replayed overwrites its own folder.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..operators.changes import DEFAULT_TERMINAL, latest_per_key

#: Rows of the first snapshot for which a part is made: what one compaction task rewrites.
ROWS_PER_PART = 4_000_000
_PART, _BATCH = "part_no", "batch"
_LAYOUT = "key array<string>, order array<string>, status string, terminal array<string>, parts int, columns string"


class _Table:
    """The layout of a table and the folders that count."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        row = spark.read.schema(_LAYOUT).parquet(os.path.join(path, "layout")).head()
        self.key, self.order, self.status, self.terminal, self.parts = row["key"], row["order"], row["status"], row["terminal"], row["parts"]
        self.schema = StructType.fromJson(json.loads(row["columns"]))
        self.stored = StructType([*self.schema.fields, StructField("_part", IntegerType())])

    def _complete(self, name: str, prefix: str) -> list[str]:
        """Names of the folders ``name/prefix*`` that Spark's commit protocol has completed."""
        jvm = self.spark._jvm  # noqa: SLF001 - the file system that Spark itself uses
        root = jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, name))
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())  # noqa: SLF001
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{prefix}*")) or []
        return [p.getPath().getName() for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p.getPath(), "_SUCCESS"))]

    def batches(self) -> list[int]:
        return sorted(int(x.split("=")[1]) for x in self._complete("log", f"{_BATCH}="))

    def versions(self) -> list[tuple[int, int]]:
        """(batch, number) of the base versions."""
        return sorted(tuple(int(n) for n in x.split("=")[1].split(".")) for x in self._complete("base", "v="))

    def folders(self) -> dict[int, list[tuple[int, int, str]]]:
        """part -> its base folders (batch, number, path), oldest first."""
        jvm = self.spark._jvm  # noqa: SLF001
        out: dict[int, list[tuple[int, int, str]]] = {}
        for batch, number in self.versions():
            root = jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, "base", _version(batch, number)))
            for p in root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root):  # noqa: SLF001
                name = p.getPath().getName()
                if name.startswith(f"{_PART}="):
                    out.setdefault(int(name.split("=")[1]), []).append((batch, number, p.getPath().toString()))
        return out

    def base(self, newest: dict[int, tuple[int, int, str]]) -> DataFrame:
        paths = [p for _, _, p in newest.values()]
        return self.spark.read.schema(self.stored).parquet(*paths) if paths else self.spark.createDataFrame([], self.stored)

    def log(self, newest: dict[int, tuple[int, int, str]]) -> DataFrame:
        """Events that the newest base of their part does not hold yet, with ``batch``."""
        kind = StructType([*self.stored.fields, StructField(_BATCH, LongType())])
        upto = [newest[p][0] if p in newest else 0 for p in range(self.parts)]
        batches = [b for b in self.batches() if b > min(upto)]
        if not batches:
            return self.spark.createDataFrame([], kind)
        root = os.path.join(self.path, "log")
        rows = self.spark.read.schema(kind).option("basePath", root).parquet(*[os.path.join(root, _folder(b)) for b in batches])
        if len(set(upto)) == 1:
            return rows
        marks = self.spark.createDataFrame([(p, b) for p, b in enumerate(upto) if b], "_of int, _upto long")  # one row per part at most
        held = rows.join(F.broadcast(marks), F.col("_part") == F.col("_of"), "left")
        return held.where(F.col(_BATCH) > F.coalesce("_upto", F.lit(0))).select(*kind.names)

    def merged(self, base: DataFrame, log: DataFrame) -> DataFrame:
        """The base rows with newer events in their place, and the events of other keys."""
        names = self.schema.names
        new = latest_per_key(log.select(*_cols(names)), self.key, self.order)
        new = new.select(F.struct(*_cols(names)).alias("_new"), *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(self.key)])

        def same(left: Column, right: Column) -> Column:
            out = F.lit(True)
            for i, k in enumerate(self.key):
                out = out & left[k].eqNullSafe(right[f"_k{i}"])
            return out

        old = base.select(F.struct(*_cols(names)).alias("_old"))
        pairs = old.join(new, same(F.col("_old"), new), "left")
        order = [F.struct(*[F.col(f"{side}.`{c}`") for c in self.order]) for side in ("_new", "_old")]
        row = F.when(F.col("_new").isNotNull() & (order[0] > order[1]), F.col("_new")).otherwise(F.col("_old"))
        # keys of the log that the base holds: no more rows than the log, so the rest is found without a shuffle of the base
        known = base.select(F.struct(*_cols(self.key)).alias("_held"))
        known = known.join(new.drop("_new"), same(F.col("_held"), new), "left_semi")
        added = new.join(known, same(F.col("_held"), new), "left_anti").select(F.col("_new").alias("_row"))
        return pairs.select(row.alias("_row")).unionByName(added).select("_row.*")


def _cols(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def _version(batch: int, number: int) -> str:
    return f"v={batch:012d}.{number:06d}"


def _folder(batch: int) -> str:
    return f"{_BATCH}={batch:012d}"


def _part(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(parts)).cast("int")


def _write_base(rows: DataFrame, path: str, batch: int, number: int, keys: list[str], parts: int, tasks: int) -> None:
    rows = rows.withColumn("_part", _part(keys, parts)).withColumn(_PART, F.col("_part"))
    rows.repartition(tasks, _PART).write.mode("overwrite").partitionBy(_PART).parquet(os.path.join(path, "base", _version(batch, number)))


def _newest(folders: dict[int, list[tuple[int, int, str]]]) -> dict[int, tuple[int, int, str]]:
    return {p: found[-1] for p, found in folders.items()}


def create_table(snapshot: DataFrame, path: str, changes: StructType, *, key: str | list[str] = "id", order: list[str] | None = None,
                 status: str = "status", terminal: tuple[str, ...] = DEFAULT_TERMINAL, parts: int | None = None) -> None:
    """A table at ``path`` with the rows of ``snapshot`` (one per key; it may be empty) as its base.

    Order and status columns that the snapshot lacks are taken from ``changes``, the schema of the events, and
    are null in the base, which is before any event. ``parts`` defaults to one per ``ROWS_PER_PART`` rows.
    """
    keys, order = [key] if isinstance(key, str) else list(key), order or ["eventTimestamp"]
    taken = {"_part", _PART, _BATCH} & set(snapshot.columns)
    if taken:
        raise ValueError(f"column names that the table keeps for itself: {sorted(taken)}")
    for c in [*order, status]:
        if c not in snapshot.columns:
            snapshot = snapshot.withColumn(c, F.lit(None).cast(changes[c].dataType))
    parts = parts or max(1, -(-snapshot.count() // ROWS_PER_PART))
    _write_base(snapshot, path, 0, 0, keys, parts, parts)
    columns = StructType([StructField(f.name, f.dataType) for f in snapshot.schema]).json()
    layout = snapshot.sparkSession.createDataFrame([(keys, order, status, list(terminal), parts, columns)], _LAYOUT)
    layout.coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "layout"))  # last: without it there is no table


def append_changes(changes: DataFrame, path: str, batch: int) -> None:
    """Events as batch ``batch`` (from 1) of the log: the latest one per key by the order columns. The same
    number again replaces the batch. Columns the events lack are null; others are left out. A null key is a
    key like any other. Events that tie in all order columns should be equal; the base's row stays on a tie."""
    t = _Table(changes.sparkSession, path)
    if batch < 1:
        raise ValueError("batches are numbered from 1")
    known = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in changes.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema]
    latest = latest_per_key(changes.select(*known), t.key, t.order).select(*_cols(t.schema.names))
    latest = latest.withColumn("_part", _part(t.key, t.parts)).sortWithinPartitions("_part")
    latest.write.mode("overwrite").parquet(os.path.join(path, "log", _folder(batch)))


def append_changes_stream(changes: DataFrame, path: str, *, checkpoint: str | None = None, trigger: dict | None = None,
                          compact_every: int | None = 16, share: float = 0.1) -> StreamingQuery:
    """Each micro-batch of changes appended to the log of the table at ``path``; after every ``compact_every``
    batches the parts are compacted whose log is at least ``share`` of their base. No event is late: what is
    older than the stored row loses whenever it comes, and removed keys stay as tombstones. ``checkpoint``
    defaults to a folder of the table."""

    def land(rows: DataFrame, batch_id: int) -> None:
        append_changes(rows, path, batch_id + 1)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(rows.sparkSession, path, share=share, oldest=4 * compact_every)

    w = changes.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint or os.path.join(path, "_checkpoint"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_table(spark: SparkSession, path: str, *, live_only: bool = True) -> DataFrame:
    """The rows of the table with every complete batch applied; ``live_only`` leaves out removed keys."""
    t = _Table(spark, path)
    newest = _newest(t.folders())
    out = t.merged(t.base(newest), t.log(newest))
    return out.where(~F.coalesce(F.col(f"`{t.status}`").isin(list(t.terminal)), F.lit(False))) if live_only else out


def compact(spark: SparkSession, path: str, *, share: float = 0.1, oldest: int | None = None) -> list[int]:
    """Fold the log into the parts where it has at least ``share`` times the rows of the base, or an event
    more than ``oldest`` batches old; the numbers of those parts. ``share=0`` folds all there is. Readers and
    the stream may go on meanwhile; one compaction at a time."""
    t = _Table(spark, path)
    batches = t.batches()
    if not batches:
        return []
    upto, newest = batches[-1], _newest(t.folders())
    log = t.log(newest).where(F.col(_BATCH) <= upto)
    pending = {r["_part"]: (r["n"], r["first"]) for r in log.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min(_BATCH).alias("first")).collect()}  # a row per part
    held = {r["_part"]: r["n"] for r in t.base({p: newest[p] for p in pending if p in newest}).groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = sorted(p for p, (n, first) in pending.items() if n >= share * held.get(p, 0) or (oldest is not None and first <= upto - oldest))
    if chosen:
        rows = t.merged(t.base({p: newest[p] for p in chosen if p in newest}), log.where(F.col("_part").isin(chosen)))
        number = 1 + max((k for _, k in t.versions()), default=0)
        _write_base(rows, path, upto, number, t.key, t.parts, len(chosen))
    return chosen


def drop_merged(spark: SparkSession, path: str, *, keep: int = 1) -> int:
    """Remove base folders that ``keep`` newer ones of the same part replace, and batches of the log (but the last one) of which
    every event is in the newest base, or before all bases kept; the number of folders removed. To be called
    when no reader or compaction is at work."""
    t = _Table(spark, path)
    folders = t.folders()
    old = [f for found in folders.values() for _, _, f in found[:-keep]]
    kept = {p: found[-keep:][0] for p, found in folders.items()}  # the oldest base that stays
    needed = {r[0] for r in t.log(kept).select(_BATCH).distinct().collect()}  # no more than there are batches
    old += [os.path.join(path, "log", _folder(b)) for b in t.batches()[:-1] if b not in needed]
    jvm = spark._jvm  # noqa: SLF001
    for f in old:
        p = jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001
    return len(old)
