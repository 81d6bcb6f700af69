"""Linking members of the same cell in blocks (used by the near-duplicate operators).

A cell may hold any number of members. Members are dealt to blocks of bounded size
by a hash; each *pair of blocks* of a cell is one group of rows, so a large cell is
compared by many tasks, each of which holds one block and streams the other. What a
task gives out is chosen by the caller's function on two bounded arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members of a block, on the average.
BLOCK = 2048


def block_pairs(members: DataFrame, cell: list[str], by: str, block: int = BLOCK) -> DataFrame:
    """The members of cells with at least two, once for each pair of blocks (i <= j) that they
    take part in: columns ``_i``, ``_j`` and ``_side`` (0: held, 1: streamed) are added. A
    member of a cell of one block appears once; in a cell of b blocks, b times."""
    sizes = members.groupBy(*cell).agg(F.count("*").alias("_n")).where("_n > 1")
    sizes = sizes.select(*[F.col(c).alias(f"{c}__") for c in cell], F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    on = [F.col(c) == F.col(f"{c}__") for c in cell]
    m = members.join(sizes, on).drop(*[f"{c}__" for c in cell])
    m = m.withColumn("_own", F.pmod(F.xxhash64(by), F.col("_blocks")).cast("int"))
    m = m.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return m.select(*members.columns, F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"),
                    (F.col("_own") > F.col("_other")).cast("int").alias("_side"))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows of equal ``keys`` (sorted together) are never split over two;
    a batch may hold several groups. Keeps at most one group and one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(batch.schema.get_field_index(k))[batch.num_rows - 1].as_py() for k in keys]
        if held:
            first = held[0]
            before = [first.column(first.schema.get_field_index(k))[first.num_rows - 1].as_py() for k in keys]
            if before == last:
                held.append(batch)
                continue
        n = batch.num_rows  # rows of the last group, counted from the end
        while n and [batch.column(batch.schema.get_field_index(k))[n - 1].as_py() for k in keys] == last:
            n -= 1
        done = [*held, *([batch.slice(0, n)] if n else [])]
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        held = [batch.slice(n)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
