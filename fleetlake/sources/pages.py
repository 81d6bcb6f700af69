"""Landed API responses (S4-S8): page envelopes, single objects, manifests.

A landed response is one JSON document per file. Its records are found with
the envelope rule (S5) by Spark's JSON parser, no Python per row:

* a JSON array -> one record per element;
* an object with ``value``: an array -> its elements; an object -> one record;
  anything else (null, a scalar) -> no records;
* an object without ``value`` -> the object itself is the record;
* anything else -> no records.

Pages linked by ``@odata.nextLink`` are simply all files of a folder: page
order carries no meaning, so the set of files is the table (S6).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.conform import conform_to
from .export import SOURCE, parse_records

BLANK = " \t\n\r\f\x0b\ufeff"


def envelope_records(docs: DataFrame, column: str = "value", path: str = "path") -> DataFrame:
    """(path, value) documents -> (path, value) rows, one per record (JSON text).

    The text is read by Spark's JSON parser with records kept as raw text, so a
    response has no size limit below that of a row, and FAILFAST aborts the load on
    a response that is cut off or not JSON at all (S10). Blank responses hold nothing.
    """
    text = F.ltrim(F.col(column), F.lit(BLANK))  # bytes only: a pattern would make a second, wider copy of the page
    d = docs.select(F.col(path).alias("path"), text.alias("_t")).where("_t <> ''")
    strict, loose = {"mode": "FAILFAST"}, {"mode": "PERMISSIVE"}
    head = F.substring("_t", 1, 1)
    none = F.array().cast("array<string>")
    t = F.col("_t")
    # an object: the elements of `value` if that is a list (then the whole text is valid JSON);
    # else its validity and the raw text of `value`, and what kind of value that is
    as_list = F.from_json(t, "value array<string>", loose).getField("value")
    raw = F.from_json(t, "value string", strict).getField("value")
    as_object = F.from_json(t, "value map<string,string>", loose).getField("value")
    no_value = ~F.coalesce(F.array_contains(F.call_function("json_object_keys", t), F.lit("value")), F.lit(False))
    in_object = F.coalesce(as_list, F.when(raw.isNull(), F.when(no_value, F.array(t)).otherwise(none))
                           .when(as_object.isNotNull(), F.array(raw)).otherwise(none))
    # any other JSON value holds no records, but must be valid
    other = F.slice(F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>", strict), 1, 0)
    records = F.when(head == "[", F.from_json(t, "array<string>", strict)).when(head == "{", in_object).otherwise(other)
    return d.select("path", F.explode(records).alias("value"))


def read_documents(spark: SparkSession, paths: str | list[str], *, layout: str = "file") -> DataFrame:
    """(path, text) per landed response.

    ``layout="file"``: one response per file (a page file may be pretty
    printed over many lines); ``layout="lines"``: one response per line
    (NDJSON of envelopes). Either way each response is bounded by the page
    size, so whole-text rows stay small.
    """
    t = spark.read.text(paths, wholetext=(layout == "file"))
    return t.select(F.col("_metadata.file_path").alias("path"), "value").filter(F.ltrim("value", F.lit(BLANK)) != "")


def scan_pages(spark: SparkSession, paths: str | list[str], schema: StructType, *, layout: str = "file") -> DataFrame:
    """Landed page (or single-object) responses -> conformed rows + ``_source``."""
    recs = envelope_records(read_documents(spark, paths, layout=layout))
    return conform_to(parse_records(recs, schema, mode="FAILFAST"), schema, keep=[SOURCE])


def manifest_paths(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """Export manifests -> blob locations (``exportFiles``, nulls dropped).

    Only the location strings reach the driver -- one per blob, bounded by
    the number of files in the export, never the data.
    """
    recs = envelope_records(read_documents(spark, paths))
    files = recs.select(F.explode(F.from_json("value", "exportFiles array<string>").getField("exportFiles")).alias("f"))
    return [r.f for r in files.dropna().distinct().collect()]


def manifest_generated_time(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Manifest rows conformed to the manifest contract (exportFiles, generatedTime)."""
    from ..plans.contracts import contract
    return scan_pages(spark, paths, contract("export_files_response"))


#: Types that hunting responses declare in ``Schema`` (fixed values of the service), as SQL types; others are text.
HUNTING_TYPES = {"boolean": "boolean", "sbyte": "int", "byte": "int", "int16": "int", "int32": "int", "int": "int", "int64": "bigint", "long": "bigint",
                 "single": "double", "double": "double", "real": "double", "datetime": "timestamp"}


def scan_inferred(spark: SparkSession, paths: str | list[str], *, results_key: str = "Results") -> DataFrame:
    """Hunting-style responses ``{"Schema": [...], "Results": [...]}`` -> rows, the schema taken from
    the data (it is only known after the run).

    Rows are read as variants and their types merged by a partial aggregate; only the merged
    type reaches the driver. A field that is an integer in one row and text or a fraction in
    another, whatever its depth, is text (its JSON), as is one that is always null; an absent
    field is null. Where no response has a row, the columns are those that ``Schema`` declares
    (``Name``, ``Type``), and without any the frame has no column and no row. Results that are
    no array, or rows that are no object, are an error.
    """
    env = spark.read.option("singleVariantColumn", "v").option("multiLine", True).json(paths)
    rows = env.select(F.explode(F.expr(f"variant_get(v, '$[\"{results_key}\"]', 'array<variant>')")).alias("r"))
    rows = rows.where(F.expr("schema_of_variant(r) <> 'VOID'"))  # a null in place of a row
    merged = rows.agg(F.schema_of_variant_agg("r").alias("s")).head().s
    if merged == "VOID":
        declared = env.select(F.explode(F.expr("variant_get(v, '$.Schema', 'array<struct<Name: string, Type: string>>')")).alias("c")).select("c.*")
        columns = {r["Name"]: HUNTING_TYPES.get((r["Type"] or "").lower(), "string") for r in declared.where("Name is not null").distinct().collect()}
        return spark.createDataFrame([], ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in sorted(columns.items())) or StructType([]))
    if not merged.startswith("OBJECT<"):
        raise ValueError(f"{results_key} does not hold objects: {merged}")
    return rows.select(F.col("r").cast(_struct_of(merged)).alias("r")).select("r.*")


def _struct_of(merged: str) -> str:
    """The SQL type of a merged variant type; names in back quotes are left alone."""
    parts = re.split("(`(?:[^`]|``)*`)", merged)
    names = {"OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING"}
    plain = [re.sub(r"(?<![\w`])(OBJECT<|VARIANT\b|VOID\b)(?!\s*:)", lambda m: names[m[1]], x) if i % 2 == 0 else x for i, x in enumerate(parts)]
    return "".join(plain)


