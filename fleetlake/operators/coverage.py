"""Contract coverage of landed JSON with evidence: how many records show each path and kind.

A schema diff tells that a field was seen; it does not tell how often, and it reads the
merged schema on the driver. Here each record is read as a variant and walked level by level
inside one projection, guided by the contract: the walk goes down only into containers that the
contract declares, so its depth and width are those of the contract, whatever a record holds.
The records give distinct (path, kind) marks, a partial aggregate counts them, and the counts alone are
joined with the list of declared paths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, FractionalType, IntegralType, MapType, StringType, StructType, VariantType)

from ..plans.contracts import contract

ROOT = "$"
_ANY = "any"
#: JSON kind of a value by the head of its variant type.
_KINDS = {"OBJECT": "object", "ARRAY": "array", "VOID": "null", "STRING": "text", "BOOLEAN": "boolean", "BIGINT": "integer"}


def _expected(dtype: DataType) -> str:
    """The JSON kind that a declared type is carried as; dates and times are text."""
    if isinstance(dtype, StructType):
        return "object"
    if isinstance(dtype, ArrayType):
        return "array"
    if isinstance(dtype, BooleanType):
        return "boolean"
    if isinstance(dtype, IntegralType):
        return "integer"
    if isinstance(dtype, FractionalType):
        return "fraction"
    return _ANY if isinstance(dtype, (MapType, VariantType)) else "text"


def _step(name: str) -> str:
    """A field's part of a path; a name that could be read as a path is quoted."""
    return f"['{name}']" if any(c in name for c in ".[]") else f".{name}"


def declared_paths(schema: StructType) -> list[tuple[str, str, str]]:
    """(path, path of the container, JSON kind) of every field and array element of ``schema``; paths begin
    at ``$``, elements are ``[]``, a name with a dot or bracket is ``['name']``."""
    out: list[tuple[str, str, str]] = []

    def below(dtype: DataType, path: str) -> None:
        if isinstance(dtype, StructType):
            inner = [(path + _step(f.name), f.dataType) for f in dtype.fields]
        elif isinstance(dtype, ArrayType):
            inner = [(f"{path}[]", dtype.elementType)]
        else:
            return
        for name, kind in inner:
            out.append((name, path, _expected(kind)))
            below(kind, name)

    below(schema, ROOT)
    return out


def _step_of(name: Column) -> Column:
    return F.when(name.rlike("[.\\[\\]]"), F.concat(F.lit("['"), name, F.lit("']"))).otherwise(F.concat(F.lit("."), name))


_NODES = "array<struct<path:string,v:variant,kind:string>>"
_MARKS = "array<struct<path:string,kind:string>>"


def _node(path: Column, v: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    head = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)  # DECIMAL, DOUBLE and FLOAT are fractions
    return F.struct(path.alias("path"), v.alias("v"), F.coalesce(F.try_element_at(names, head), F.lit("fraction")).alias("kind"))


def _children(containers: list[str]) -> Callable[[Column], Column]:
    """Nodes directly below a node, if its path is a declared container."""
    def of(node: Column) -> Column:
        path, v, kind = node.getField("path"), node.getField("v"), node.getField("kind")
        fields = F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")),
                             lambda e: _node(F.concat(path, _step_of(e.getField("key"))), e.getField("value")))
        items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda e: _node(F.concat(path, F.lit("[]")), e))
        inside = path.isin(containers)
        return F.when(inside & (kind == "object"), fields).when(inside & (kind == "array"), items).otherwise(F.array().cast(_NODES))
    return of


def record_marks(records: DataFrame, schema: StructType, *, column: str = "value") -> DataFrame:
    """One row (``marks``: array of distinct (path, kind)) per record of JSON text.

    Kind is object, array, text, integer, fraction, boolean or null (a JSON null); ``absent``
    marks a declared field that a record lacks although it holds its container. A text
    that is no JSON (cut off, or with a name twice in one object) is (``$``, malformed); a null or
    blank text is no record.
    """
    paths = declared_paths(schema)
    containers = sorted({parent for _, parent, _ in paths} | {ROOT})
    level = {ROOT: 0}
    for path, parent, _ in paths:
        level[path] = level[parent] + 1
    depth = max(level.values())
    text = F.col(f"`{column}`")
    rows = records.where(F.trim(F.regexp_replace(text, "[\\t\\r\\n\\uFEFF]", " ")) != "").select(F.try_parse_json(text).alias("r"))
    rows = rows.select(F.when(F.col("r").isNull(), F.array().cast(_NODES)).otherwise(F.array(_node(F.lit(ROOT), F.col("r")))).alias("n0"))
    for k in range(depth):
        rows = rows.select("*", F.flatten(F.transform(f"n{k}", _children(containers))).alias(f"n{k + 1}"))
    levels = [F.array_distinct(F.transform(f"n{k}", lambda n: F.struct(n.getField("path").alias("path"), n.getField("kind").alias("kind")))) for k in range(depth + 1)]
    rows = rows.select(F.concat(*levels).alias("seen"))
    objects = F.transform(F.filter("seen", lambda m: m.getField("kind") == "object"), lambda m: m.getField("path"))
    rows = rows.select("seen", objects.alias("objects"), F.transform("seen", lambda m: m.getField("path")).alias("there"))
    wanted = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(parent).alias("parent")) for p, parent, _ in paths if p != parent + "[]"])
    lacking = F.filter(wanted, lambda w: F.array_contains(F.col("objects"), w.getField("parent")) & ~F.array_contains(F.col("there"), w.getField("path")))
    absent = F.transform(lacking, lambda w: F.struct(w.getField("path").alias("path"), F.lit("absent").alias("kind")))
    malformed = F.array(F.struct(F.lit(ROOT).alias("path"), F.lit("malformed").alias("kind")))
    return rows.select(F.when(F.size("seen") == 0, malformed).otherwise(F.concat("seen", absent)).cast(_MARKS).alias("marks"))


def path_coverage(records: DataFrame, schema: StructType, *, column: str = "value") -> DataFrame:
    """(path, kind, records, expected, status) of JSON records against a contract of at least one field.

    ``records`` counts the records that show the path as that kind (one record counts once, however many
    elements of an array show it). ``status``: ``ok``; ``null`` (a JSON null); ``type`` (another kind than
    declared; an integer fits a fraction); ``extra`` (declared nowhere; what lies below is not looked at); ``absent``
    (the container is there, the field is not; if no record shows it, ``missing``; within an array a field is absent
    if no element of the record has it); ``malformed``. A declared field whose container is never seen is ``missing``
    with 0 records, so every declared path comes up. Elements of an array that is always empty are left out.
    """
    # an outer explode: a plain one would have the marks computed once more, as a filter on their size below
    marks = record_marks(records, schema, column=column).select(F.explode_outer("marks").alias("m"))
    counted = marks.groupBy(F.col("m.path").alias("path"), F.col("m.kind").alias("kind")).agg(F.count(F.lit(1)).alias("records"))
    kinds = counted.groupBy("path").agg(F.collect_list(F.struct("kind", "records")).alias("kinds"))  # at most nine a path
    expected = records.sparkSession.createDataFrame(
        [(ROOT, "object", False), *[(p, e, p != parent + "[]") for p, parent, e in declared_paths(schema)]], "path string, expected string, field boolean")
    both = expected.join(kinds, "path", "full_outer").where("kinds is not null or field")
    unseen = F.array(F.struct(F.lit("absent").alias("kind"), F.lit(0).cast("long").alias("records")))
    both = both.select("path", "expected", F.coalesce("kinds", unseen).alias("kinds"))
    both = both.select("path", "expected", F.forall("kinds", lambda k: k.getField("kind") == "absent").alias("never"), F.explode_outer("kinds").alias("k"))
    kind, want = F.col("k.kind"), F.col("expected")
    status = (F.when(kind == "malformed", "malformed").when(want.isNull(), "extra").when(F.col("never"), "missing").when(kind.isin("null", "absent"), kind)
              .when((want == _ANY) | (kind == want) | ((kind == "integer") & (want == "fraction")), "ok").otherwise("type"))
    return both.select("path", kind.alias("kind"), F.col("k.records").alias("records"), "expected", status.alias("status"))


def landed_coverage(spark: SparkSession, paths: str | list[str], contract_name: str, *, layout: str = "export") -> DataFrame:
    """:func:`path_coverage` of a landed batch: ``layout`` is ``export`` (one record per line), or ``file`` / ``lines`` for page
    envelopes (:func:`..sources.pages.read_documents`)."""
    from ..sources.pages import envelope_records, read_documents

    if layout == "export":
        records = spark.read.text(paths)
    else:
        records = envelope_records(read_documents(spark, paths, layout=layout))
    return path_coverage(records, contract(contract_name))


def drift_evidence(coverage: DataFrame) -> DataFrame:
    """The rows of :func:`path_coverage` that are drift: all but ``ok``, ``null`` and ``absent`` ones."""
    return coverage.where(~F.col("status").isin("ok", "null", "absent"))
