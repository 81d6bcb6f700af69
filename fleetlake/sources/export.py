"""Bulk export scans (S1-S3, S9-S11): NDJSON blobs, plain or gzip, many at once.

* S1 one table from many blobs: Spark's JSON line reader, one task per gzip
  file (gzip is not splittable) and split plain files; blank lines are
  skipped, a UTF-8 BOM is tolerated (S3).
* S2 gzip by magic bytes: each blob's first two bytes (``1f 8b``) decide, whatever
  its name. Spark lists the blobs, tasks open them and look; only the names of blobs whose
  name says otherwise reach the driver. Spark's reader takes all others; those are opened again
  by tasks and decoded as a stream. How a task opens a blob is the argument ``opener`` (a path
  to a binary stream, e.g. of a cloud client); local files need none. For other file systems
  without one, Spark hands tasks the blob's bytes (then at most 2 GB each, whole in memory).
* S9 empty blobs are not errors: :func:`skipped_files` lists them.
* S10 a malformed line fails the load (``FAILFAST``, the default); opt in to
  ``quarantine`` to get the bad lines back as a second table instead.
* S11 every row carries ``_source``, its blob location with any query string
  or fragment removed.

A path may be a folder of blobs (e.g. one export's landing folder) or a pattern.
"""

from __future__ import annotations

import codecs
import gzip
import zlib
import io
import re
from collections.abc import Callable, Iterator
from functools import partial, reduce
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.scalars import redact_url
from ..operators.conform import conform_to, wire_schema
from ..session import ship_package

OTHER_CODECS = (".bz2", ".deflate", ".lz4", ".snappy", ".zst")  # names by which Spark's reader would decompress
GZIP_MAGIC = b"\x1f\x8b"
SOURCE = "_source"
CORRUPT = "_corrupt_record"


def _lines_schema() -> StructType:
    return StructType([StructField("path", StringType()), StructField("value", StringType())])


LINES_PER_BATCH, PIECE = 10_000, 1 << 20
Opener = Callable[[str], BinaryIO]


def _lines_of(stream) -> Iterator[str]:
    """Non-blank lines of a blob, read, decompressed (all gzip members) and decoded piece by piece."""
    decoder, unzip, rest = codecs.getincrementaldecoder("utf-8-sig")(), zlib.decompressobj(31), ""
    piece = stream.read(PIECE)
    packed = piece[:2] == GZIP_MAGIC
    while piece:
        if packed:
            out = b""
            while piece:
                out += unzip.decompress(piece)
                piece = unzip.unused_data
                if unzip.eof:
                    unzip = zlib.decompressobj(31)
                    piece = piece.lstrip(b"\0")  # padding between members
            piece = out
        *lines, rest = (rest + decoder.decode(piece)).split("\n")
        yield from (x for line in lines if (x := line.strip()))
        piece = stream.read(PIECE)
    if packed and not _ended(unzip):
        raise EOFError("a gzip blob is cut off")
    if x := (rest + decoder.decode(b"", True)).strip():
        yield x


def _ended(unzip) -> bool:
    """Whether nothing of a further gzip member has been read."""
    return not unzip.unconsumed_tail and unzip.copy().flush() == b"" and not unzip.eof and _fresh(unzip)


def _fresh(unzip) -> bool:
    try:
        probe = unzip.copy()
        probe.decompress(gzip.compress(b""))
        return probe.eof
    except zlib.error:
        return False


def open_local(path: str) -> BinaryIO:
    """A stream over a local file, given as a path or a ``file:`` location."""
    return open(re.sub(r"^file:(//)?", "", path), "rb")  # noqa: SIM115 - closed by the caller


def _sniff_lines(batches, opener: Opener | None = None):
    """Executor side of S2: blobs (their paths for ``opener``, or their bytes; gzip or plain, told by content) as
    lines, a bounded number of them at a time."""
    import pandas as pd

    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["path"] if opener else pdf["content"]):
            lines: list[str] = []
            with opener(path) if opener else io.BytesIO(content or b"") as stream:
                for line in _lines_of(stream):
                    lines.append(line)
                    if len(lines) == LINES_PER_BATCH:
                        yield pd.DataFrame({"path": path, "value": lines})
                        lines = []
            if lines:
                yield pd.DataFrame({"path": path, "value": lines})


def decode_blobs(blobs: DataFrame, opener: Opener | None) -> DataFrame:
    """(path, value) lines of ``blobs``, a frame of ``path``, and ``content`` where there is no ``opener``."""
    ship_package(blobs.sparkSession)
    return blobs.select("path", *([] if opener else ["content"])).mapInPandas(partial(_sniff_lines, opener=opener), _lines_schema())


def _are_packed(batches, opener: Opener):
    """Executor side of the look at first bytes."""
    import pandas as pd

    for pdf in batches:
        heads = []
        for path in pdf["path"]:
            with opener(path) as stream:
                heads.append(stream.read(2) == GZIP_MAGIC)
        yield pd.DataFrame({"path": pdf["path"], "file_path": pdf["file_path"], "packed": heads})


def opener_for(spark: SparkSession, paths: list[str], opener: Opener | None) -> Opener | None:
    """The given opener, or the local one where every location is local."""
    if opener is not None:
        return opener
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()  # noqa: SLF001 - the file system that Spark itself uses
    schemes = {jvm.org.apache.hadoop.fs.Path(p).getFileSystem(conf).getUri().getScheme() for p in paths}  # opens nothing
    return open_local if schemes <= {"file"} else None


def _misnamed(spark: SparkSession, paths: list[str], opener: Opener | None) -> list[tuple[str, str]]:
    """(path, file_path) of blobs by whose name Spark's reader would take the wrong codec. Spark lists the
    folders; the first two bytes are read by tasks; only these names reach the driver."""
    listed = blob_listing(spark, paths)
    if opener is not None:
        ship_package(spark)
        heads = listed.select("path", F.col("_metadata.file_path").alias("file_path")).mapInPandas(
            partial(_are_packed, opener=opener), "path string, file_path string, packed boolean")
    else:
        heads = listed.select("path", F.col("_metadata.file_path").alias("file_path"), (F.substring("content", 1, 2) == F.lit(GZIP_MAGIC)).alias("packed"))
    name = F.lower("path")
    other = reduce(lambda a, b: a | b, [name.endswith(x) for x in OTHER_CODECS])
    return [tuple(r) for r in heads.where((F.col("packed") != name.endswith(".gz")) | other).select("path", "file_path").collect()]


def blob_listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The blobs under ``paths``, with their ``path`` and, only where it is selected, ``content``."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))


def raw_lines(spark: SparkSession, paths: list[str], *, detect: str = "content", opener: Opener | None = None) -> DataFrame:
    """(path, value) rows: the non-blank lines of the blobs, as text.

    ``detect="content"`` looks at every blob's first bytes: where the name agrees,
    Spark reads it (in splits, if it is plain); a gzip blob under another name, or a
    plain one named ``.gz``, is decoded by a task as a stream. ``"suffix"``
    trusts all names, ``"magic"`` decodes every blob that way.
    """
    if not paths:
        return spark.createDataFrame([], _lines_schema())
    native, other = _route(spark, paths, detect, opener)
    parts = []
    if native is not None:
        t = native(spark.read, "text").select(F.col("_metadata.file_path").alias("path"),
                                              F.regexp_replace("value", "^[\\s\ufeff]+|\\s+$", "").alias("value"))
        parts.append(t.filter(F.length("value") > 0))
    if other is not None:
        parts.append(other)
    return reduce(DataFrame.unionByName, parts)


def _route(spark: SparkSession, paths: list[str], detect: str, opener: Opener | None):
    """How Spark's reader takes the blobs whose name fits (a function of reader and format), and the decoded
    lines of the others; either may be None."""
    def native(excluded: list[str]):
        def load(reader, fmt: str) -> DataFrame:
            df = reader.format(fmt).option("recursiveFileLookup", True).load(list(paths))
            # a filter on a file's own name is applied to the listing, so those files are never opened
            return df.where(~F.col("_metadata.file_path").isin(excluded)) if excluded else df
        return load

    if detect == "suffix":
        return native([]), None
    opener = opener_for(spark, paths, opener)
    if detect == "magic":
        return None, decode_blobs(blob_listing(spark, paths), opener)
    wrong = _misnamed(spark, paths, opener)
    if not wrong:
        return native([]), None
    names = [f for _, f in wrong]
    return native(names), decode_blobs(blob_listing(spark, paths).where(F.col("_metadata.file_path").isin(names)), opener)


def parse_records(lines: DataFrame, schema: StructType, *, mode: str = "FAILFAST") -> DataFrame:
    """JSON text lines -> typed rows of ``schema`` (leaves read as text, then conformed)."""
    wire = wire_schema(schema)
    parsed = lines.select(F.col("path"), F.from_json("value", wire, {"mode": mode}).alias("r"), "value")
    out = parsed.select("r.*", redact_url("path").alias(SOURCE), "value")
    return out


def scan_export(spark: SparkSession, paths: list[str], schema: StructType, *, mode: str = "FAILFAST",
                detect: str = "content", opener: Opener | None = None) -> DataFrame:
    """Many NDJSON blobs -> one table conformed to ``schema`` plus ``_source``.

    An empty path list gives an empty typed table. Malformed lines fail the
    job (``FAILFAST``); use :func:`scan_export_quarantine` to keep going.
    """
    if not paths:
        return spark.createDataFrame([], StructType(schema.fields + [StructField(SOURCE, StringType())]))
    native, other = _route(spark, paths, detect, opener)
    parts = []
    if native is not None:
        df = native(spark.read.schema(wire_schema(schema)).option("mode", mode), "json")
        parts.append(conform_to(df.withColumn(SOURCE, redact_url(F.col("_metadata.file_path"))), schema, keep=[SOURCE]))
    if other is not None:
        parts.append(conform_to(parse_records(other, schema, mode=mode), schema, keep=[SOURCE]))
    return reduce(DataFrame.unionByName, parts)


def scan_export_quarantine(spark: SparkSession, paths: list[str], schema: StructType, *,
                           detect: str = "content", opener: Opener | None = None) -> tuple[DataFrame, DataFrame]:
    """S10 opt-in: (good rows, bad lines) instead of failing on a malformed line."""
    return good_and_bad(probe_lines(raw_lines(spark, paths, detect=detect, opener=opener), schema), schema)


def probe_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """``lines`` (path, value) with the record ``r`` parsed from each, ``_corrupt_record`` in it where that failed."""
    wire = wire_schema(schema)
    probe = StructType(list(wire.fields) + [StructField(CORRUPT, StringType())])  # type: ignore[attr-defined]
    return lines.select("path", "value", F.from_json("value", probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))


def good_and_bad(parsed: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Conformed rows and bad lines of :func:`probe_lines`, both with their ``_source``."""
    ok = F.col(f"r.{CORRUPT}").isNull() & F.col("r").isNotNull()
    good = parsed.filter(ok).select("r.*", redact_url("path").alias(SOURCE)).drop(CORRUPT)
    bad = parsed.filter(~ok).select(redact_url("path").alias(SOURCE), F.col("value").alias(CORRUPT))
    return conform_to(good, schema, keep=[SOURCE]), bad


def _norm_path(c):
    return F.regexp_replace(c, r"^file:(//)?", "")


def skipped_files(spark: SparkSession, paths: list[str], table: DataFrame) -> DataFrame:
    """Blobs that produced no rows (empty or blank-only), as ``_source`` values.

    Expected locations anti-joined with the distinct ``_source`` of the
    table; the distinct is one row per blob, so the join side stays small.
    """
    expected = spark.createDataFrame([(p,) for p in paths], ["p"]).select(
        redact_url(_norm_path(F.col("p"))).alias(SOURCE)).distinct()
    seen = table.select(redact_url(_norm_path(F.col(SOURCE))).alias(SOURCE)).distinct()
    return expected.join(seen, SOURCE, "left_anti")
