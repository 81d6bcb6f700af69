"""Free-form hunting queries (H1).

The upstream posts query text to the service and gets rows back with a
schema known only after the run. Here every loaded dataset is a temp view
and the text is Spark SQL; Catalyst plans it like any other query, so
filters and column pruning reach the scans. (A KQL front end is not built:
``DeviceInfo | take 10`` is ``SELECT * FROM DeviceInfo LIMIT 10``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .sinks import LazyResult


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """Register each frame as a temp view under its name; returns the names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def run_hunting(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run ``text`` (Spark SQL) over ``tables`` and the session's views; lazy until an action.

    The names of ``tables`` are views only while the text is analysed: a view of the
    session with the same name is put back afterwards.
    """
    if not tables:
        return spark.sql(text)
    local = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = {name: spark.table(name) for name in tables if name.lower() in {x.lower() for x in local}}
    register_views(tables)
    try:
        return spark.sql(text)
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        register_views(before)


def hunting_result(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None) -> LazyResult:
    """K1'-K5': the result of a hunting text as a cached handle with the in-memory terminals
    (dicts, JSON, Arrow, Polars) and ``refresh``; nothing runs before a terminal is called."""
    return LazyResult(lambda: run_hunting(spark, text, tables))
