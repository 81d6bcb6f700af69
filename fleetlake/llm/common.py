"""Shared helpers of the corpus operators: shared-folder tables, connected
components, row streams for Arrow functions.

Nothing here gathers rows on the driver; iterations exchange one number.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import ensure_checkpoint_dir, ship_package


#: Rows and bytes of a batch that goes to an Arrow function: whole texts are large rows.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Make the package importable in the executors' Python workers, and keep the batches that
    go there small (a smaller setting of the session stays)."""
    ship_package(spark)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder of ``spark.checkpoint.dir``: computed
    once, kept when executors are lost, and the lineage ends there."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many leading underscores as it takes to be no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    column = column.cast(pa.binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``most_bytes`` of text (at least one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def connected_components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; component is the smallest
    node reachable.

    Alternates large-star and small-star steps: every round is two aggregations
    (the minimum per node is partial before the shuffle) and a join, so no
    neighbourhood is ever gathered. Each round is written to the shared folder; the
    driver sees only a count and a checksum, which tell when nothing changes.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("n"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("n"), F.col("a").alias("v")))
        least = both.groupBy("n").agg(F.min("v").alias("m")).select(
            F.col("n").alias("n_"), F.least("m", "n").alias("m"))
        joined = both.join(least, F.col("n") == F.col("n_"))
        if large:  # larger neighbours point at the smallest of the neighbourhood
            out = joined.where("v > n").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:  # e holds a > b: a and its smaller neighbours point at the smallest
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("n_").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    current = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if state == seen or not state[0]:
            break
        seen = state
        current = written(star(star(current, True), False), "edges")
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of ``schema`` from numpy arrays or lists, one for each field."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema)
