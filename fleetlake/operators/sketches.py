"""Approximate distinct counts from mergeable sketches (opt-in beside the exact G1-G3, G6).

Exact distinct counts have to shuffle every distinct (key, value) pair, for each period
that is asked for. A HyperLogLog sketch per key and period has a fixed size (about ``2**lg_k`` bytes at most,
fewer for few values), is built by a partial aggregate, so rows never cross the network, and sketches of any set of
periods merge into the sketch of their union. They are stored by period; one that is landed again replaces its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2**14 registers: a relative standard error of 1.04 / sqrt(2**14), about 0.8 %.
LG_K = 14


def relative_error(lg_k: int = LG_K) -> float:
    """Standard error of an estimate, relative to the count."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(rows: DataFrame, keys: list[str], value: str, *, lg_k: int = LG_K) -> DataFrame:
    """(keys, ``sketch``): a sketch of the distinct non-null ``value`` (text) per key.

    Null keys are a group like any other; a group without values has an empty sketch, an empty
    frame no row. ``lg_k`` is 4 to 21.
    """
    return rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.hll_sketch_agg(F.col(f"`{value}`").cast("string"), F.lit(lg_k)).alias("sketch"))


def store_sketches(rows: DataFrame, path: str, *, key: str, value: str, time: str, unit: str = "day", lg_k: int = LG_K) -> None:
    """Sketches per ``key`` and period (a day, or another ``unit`` of ``date_trunc``) of ``time`` under ``path``, one folder a
    period, named by its first day. The periods in ``rows`` replace those stored before, others stay: land a period
    whole. Rows without a time are under a null period. The write is rebalanced by period, so a period is a few files
    whatever the number of tasks, and a large one is split."""
    period = F.to_date(F.date_trunc(unit, F.col(f"`{time}`")))
    rows = rows.select(F.col(f"`{key}`").cast("string").alias("id"), period.alias("period"), F.col(f"`{value}`").alias("value"))
    kept = distinct_sketches(rows, ["id", "period"], "value", lg_k=lg_k).hint("rebalance", "period")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    """(id, sketch, period) as :func:`store_sketches` has stored them."""
    return spark.read.schema("id string, sketch binary, period date").parquet(path)


def merged_counts(sketches: DataFrame, keys: list[str], *, since: str | None = None, until: str | None = None, out: str = "approxCount") -> DataFrame:
    """Distinct values per key over the periods that begin from ``since`` to ``until`` (both included, text or none),
    estimated from merged sketches. Periods are pruned as folders; a null period counts only where neither bound is given."""
    if since is not None:
        sketches = sketches.where(F.col("period") >= F.lit(since).cast("date"))
    if until is not None:
        sketches = sketches.where(F.col("period") <= F.lit(until).cast("date"))
    return sketches.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias(out))


def approx_cve_rollup(vuln_inventory: DataFrame, *, lg_k: int = LG_K) -> DataFrame:
    """G6, approximate: per CVE, the estimated number of distinct exposed machines."""
    return distinct_sketches(vuln_inventory, ["cveId"], "deviceId", lg_k=lg_k).select(
        F.col("cveId").alias("id"), F.hll_sketch_estimate("sketch").alias("exposedMachines"))
