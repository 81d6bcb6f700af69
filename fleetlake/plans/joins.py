"""Join planning helpers: size-checked broadcast, key frames, semi / anti joins, rows spread over tasks.

Broadcast is only ever requested for a side whose row count has been proven
under a bound: a literal key list (its length is known on the driver), or a
catalog / dimension table checked with a bounded ``limit(n+1).count()`` probe
(a cheap scan that stops after n+1 rows). Broadcasting such a side up front
means the large side is never shuffled at all. Key sets derived from data are
left to AQE, which turns a join into a broadcast at run time only when the
materialised side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
and otherwise keeps a sort-merge join (with skew-join splitting of hot
partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

# Default bounds under which a side may be broadcast: rows for literal key
# lists, estimated bytes for tables (rows x estimated row width).
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Least number of tasks that rows are spread over; a session with more shuffle partitions sets more.
SPREAD_TASKS = 128


def rows_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def estimated_row_bytes(dtype: DataType) -> int:
    """A generous per-row size estimate from the schema (strings 32 B, arrays 4 elements)."""
    if isinstance(dtype, StructType):
        return 8 + sum(estimated_row_bytes(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return 16 + 4 * estimated_row_bytes(dtype.elementType)
    if isinstance(dtype, MapType):
        return 16 + 4 * (estimated_row_bytes(dtype.keyType) + estimated_row_bytes(dtype.valueType))
    if isinstance(dtype, (StringType, BinaryType)):
        return 32
    return 8


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint on ``df`` only if it is proven small.

    The bound is in bytes: at most ``max_bytes / estimated row width`` rows,
    checked with a ``limit(n+1).count()`` probe that stops after n+1 rows.
    """
    max_rows = max(1, max_bytes // estimated_row_bytes(df.schema))
    return F.broadcast(df) if rows_at_most(df, max_rows) else df


def key_frame(spark: SparkSession, values, column: str = "id") -> DataFrame:
    """A one-column frame of literal keys (its size is known on the driver)."""
    vals = list(values)
    frame = spark.createDataFrame([(v,) for v in vals], [column])
    return F.broadcast(frame) if len(vals) <= BROADCAST_MAX_ROWS else frame


def semi_join(df: DataFrame, keys: DataFrame, column: str, key_column: str | None = None,
              *, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` appears in ``keys`` (left semi join).

    Without ``max_broadcast_bytes`` no probe runs: a key frame derived from
    data is left to AQE, which broadcasts it at run time only if its
    materialised size is under the threshold (probing it here would re-run
    its upstream work). Pass a bound to probe and broadcast explicitly.
    """
    k = keys.select(F.col(key_column or column).alias(column))
    if max_broadcast_bytes is not None:
        k = bounded_broadcast(k, max_broadcast_bytes)
    return df.join(k, on=column, how="left_semi")


def anti_join(df: DataFrame, keys: DataFrame, column: str, key_column: str | None = None,
              *, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` does not appear in ``keys`` (left anti join)."""
    k = keys.select(F.col(key_column or column).alias(column))
    if max_broadcast_bytes is not None:
        k = bounded_broadcast(k, max_broadcast_bytes)
    return df.join(k, on=column, how="left_anti")


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt over tasks by a hash of ``columns`` (none: evenly, whatever the rows hold).

    For rows that grow in the step after (exploded, or gathered in a hash map): a small file is one task, and
    AQE merges small shuffle partitions by the bytes that come in. A number of partitions that is
    given is kept, so a task gets its share of the rows whatever their size.
    """
    most = max(SPREAD_TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(most, *[F.col(c) for c in columns])
