"""Ordered slices and batching.

The upstream relies on service order for ``top`` / ``skip``; here an order key
is mandatory so a slice is deterministic. ``orderBy(...).limit(n)`` plans as
``TakeOrderedAndProject`` (per-partition top-n, then a merge of n rows per
partition) -- no full sort and no single-partition shuffle of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.query_models import TOP_MAX
from ..session import materialize

BATCH_SIZE = 500  # fixed value: upstream write-call batch size


def _keys(order_by) -> list[Column]:
    keys = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def top(df: DataFrame, n: int, order_by) -> DataFrame:
    """L1: first ``n`` rows (1..10000) in ``order_by`` order."""
    return take_slice(df, order_by, top=n)


def skip(df: DataFrame, n: int, order_by) -> DataFrame:
    """L2: all rows after the first ``n`` in ``order_by`` order."""
    return take_slice(df, order_by, skip=n)


def take_slice(df: DataFrame, order_by, *, top: int | None = None, skip: int | None = None) -> DataFrame:
    """L3: exactly one slice: ``offset(skip).limit(top)`` under a total order.

    ``order_by`` should be a total order (add a unique tie-break key) so the
    slice does not depend on partitioning.
    """
    if top is not None and not (1 <= top <= TOP_MAX):
        raise ValueError(f"top={top} outside [1, {TOP_MAX}]")
    if skip is not None and skip < 0:
        raise ValueError(f"skip={skip} must be >= 0")
    if skip and top is None:
        return _after(df, order_by, skip)
    out = df.orderBy(*_keys(order_by))
    if top is not None and skip:
        # limit(skip+top) keeps the plan a bounded top-n before the offset.
        return out.limit(skip + top).offset(skip)
    if top is not None:
        out = out.limit(top)
    return out


def _ties(df: DataFrame) -> Column:
    """Deals rows that tie in an order: a hash of the whole row (columns that have no hash left out).
    Only rows that are equal throughout still tie, and those may stand for each other."""
    def hashed(kind) -> bool:
        text = kind.simpleString()
        return "map<" not in text and "variant" not in text

    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if hashed(f.dataType)])


def _after(df: DataFrame, order_by, n: int) -> DataFrame:
    """Rows after the first ``n``. Up to ``TOP_MAX`` by ascending columns, the n-th row is found as a bounded top-n and the
    rest is a filter past it. Else the rows are sorted into ranges, whose bounds Spark samples, and
    numbered by the counts of the ranges before (:func:`number_rows`); a plain offset would send the
    whole sorted table through one task. Rows that tie are dealt by a hash, so they fill no one range."""
    names = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if n > TOP_MAX or not all(isinstance(k, str) for k in names):
        number = free_name(df, "_number")
        numbered = number_rows(df, order_by=[*_keys(names), _ties(df)], column=number)
        return numbered.where(F.col(number) >= n).orderBy(number).drop(number)
    key = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)], _ties(df).alias("tie"))
    edge = df.select(key.alias("k")).orderBy("k").limit(n).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    edge = edge.agg(F.max(F.struct("k", "n")).alias("e")).select("e")
    k, e, nth = free_name(df, "_k"), free_name(df, "_e"), free_name(df, "_nth")
    marked = df.withColumn(k, key).withColumn(e, edge.scalar())
    past = marked.where(F.col(k) > F.col(f"{e}.k"))
    ties = marked.where(F.col(k) == F.col(f"{e}.k"))  # rows equal to the n-th one
    ties = ties.withColumn(nth, F.row_number().over(Window.partitionBy(k).orderBy(k))).where(F.col(nth) > F.col(f"{e}.n")).drop(nth)
    return past.unionByName(ties).orderBy(*_keys(names)).drop(k, e)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``df`` has such a column."""
    while name in df.columns:
        name = f"_{name}"
    return name


def number_rows(df: DataFrame, *, order_by=None, column: str = "rowNumber") -> DataFrame:
    """``df`` with a dense row number from 0 (long), in ``order_by`` order if given, else in any order.

    Each task numbers its own rows; the counts per task are summed up to offsets, which are a few numbers
    per task, and joined back. So no window holds the table in one task and, without an order, no row is
    shuffled. The tasks' rows must be the same in both steps, so the frame is written to the
    shared folder first. An empty frame stays empty.
    """
    rows = df if order_by is None else df.orderBy(*_keys(order_by))
    task = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(task.cast("long"), 33)
    rows = materialize(rows.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), task.alias("_task"), place.alias("_place")), "numbered")
    counts = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))  # one row per task of the writing job
    offsets = counts.select(F.col("_task").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = rows.join(F.broadcast(offsets), F.col("_task") == F.col("_of"))
    return numbered.select("_row.*", (F.col("_before") + F.col("_place")).alias(column))


def assign_batches(df: DataFrame, size: int = BATCH_SIZE, *, column: str = "batchId", order_by=None) -> DataFrame:
    """Tag rows with a batch number from 0; every batch but the last holds exactly ``size`` rows,
    taken in ``order_by`` order if given (:func:`number_rows`)."""
    if size < 1:
        raise ValueError(f"size={size} must be at least 1")
    numbered = number_rows(df, order_by=order_by, column="_number")
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], F.expr(f"_number div {int(size)}").alias(column))


def page_files(df: DataFrame, path: str, page_size: int, *, fmt: str = "json", mode: str = "overwrite") -> None:
    """L4 as a sink: write ``df`` with at most ``page_size`` records per file."""
    df.write.mode(mode).option("maxRecordsPerFile", page_size).format(fmt).save(path)
