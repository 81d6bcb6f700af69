"""Materialization (K1-K6) and the cached result handle.

The upstream materializes in memory (dicts, JSON, Arrow, Polars). At scale
the default sink is a file write; the in-memory forms are for bounded
results only and take an explicit row limit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_dicts(df: DataFrame, limit: int) -> list[dict]:
    """K1: rows as nested dicts, at most ``limit`` (streamed partition by partition)."""
    out = []
    for row in df.limit(limit).toLocalIterator():
        out.append(row.asDict(recursive=True))
    return out


def iter_dicts(df: DataFrame) -> Iterator[dict]:
    """K1 streaming form: one partition at a time on the driver."""
    for row in df.toLocalIterator():
        yield row.asDict(recursive=True)


def json_column(df: DataFrame, *, pretty: bool = False) -> Column:
    """K2: each row as JSON text (compact, or indented with ``pretty``)."""
    opts = {"pretty": "true"} if pretty else {}
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), opts)


def to_json(df: DataFrame, limit: int, *, indent: int | None = None) -> str:
    """K2: the whole (bounded) result as one JSON array, compact or indented; times as ISO text."""
    import json

    rows = [json.loads(r[0]) for r in df.limit(limit).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})).toLocalIterator()]
    return json.dumps(rows, indent=indent, ensure_ascii=False, separators=None if indent else (",", ":"))


def to_polars(df: DataFrame, limit: int):
    """K4: a Polars frame of the (bounded) result; needs the package ``polars``."""
    import polars

    return polars.from_arrow(to_arrow(df, limit))


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite", max_records_per_file: int | None = None) -> None:
    """K2 at scale: NDJSON files, optionally capped per file (L4)."""
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.json(path)


def to_arrow(df: DataFrame, limit: int):
    """K3: a pyarrow Table of at most ``limit`` rows (at scale, write files instead)."""
    return df.limit(limit).toArrow()


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """K3 at scale: Parquet files (the columnar form at rest)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


class LazyResult:
    """K5: a lazy handle that caches on first use and can be refreshed.

    ``build`` returns the DataFrame; nothing runs until ``frame()`` or a
    terminal is called. ``refresh()`` drops the cache and returns a new
    handle that rebuilds (re-reading the sources).
    """

    def __init__(self, build: Callable[[], DataFrame], level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
        self._build = build
        self._level = level
        self._df: DataFrame | None = None

    def frame(self) -> DataFrame:
        if self._df is None:
            self._df = self._build().persist(self._level)
        return self._df

    def refresh(self) -> LazyResult:
        if self._df is not None:
            self._df.unpersist()
            self._df = None
        return LazyResult(self._build, self._level)

    def to_dicts(self, limit: int) -> list[dict]:
        return to_dicts(self.frame(), limit)

    def to_json(self, limit: int, *, indent: int | None = None) -> str:
        return to_json(self.frame(), limit, indent=indent)

    def to_arrow(self, limit: int):
        return to_arrow(self.frame(), limit)

    def to_polars(self, limit: int):
        return to_polars(self.frame(), limit)

    def count(self) -> int:
        return self.frame().count()
