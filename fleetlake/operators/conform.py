"""Contract conformance (C1): project any frame onto an entity contract.

Rule (a decision; the upstream coercion code is not public):

* columns come out in contract order; unknown columns are dropped;
* a contract column missing from the input is a typed null;
* values are coerced with ``try_cast`` (never fails a job: an uncastable value
  becomes null and is counted by ``quality.coercion_loss_report``);
* JSON text arriving where the contract has a struct / array is parsed;
  a struct / array / map arriving where the contract has a string is
  serialised to JSON text;
* nested structs and arrays are conformed field by field, recursively.

Everything is one SQL projection, so it stays inside whole-stage codegen
and Catalyst can still prune and push down through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    DataType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from ..plans.contracts import contract


def wire_schema(dtype: DataType) -> DataType:
    """Same nesting as ``dtype`` with every leaf read as STRING.

    Spark's JSON reader does not coerce ("7" into INT is null), so landed
    JSON is read with this schema and ``conform`` does the typing.
    """
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, wire_schema(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, ArrayType):
        return ArrayType(wire_schema(dtype.elementType), True)
    if isinstance(dtype, MapType):
        return MapType(StringType(), wire_schema(dtype.valueType), True)
    return StringType()


def contract_wire_schema(name: str) -> StructType:
    return wire_schema(contract(name))  # type: ignore[return-value]


def quote(name: str) -> str:
    """A SQL identifier in backticks."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_type(dtype: DataType) -> str:
    """SQL type text, with struct field names quoted."""
    if isinstance(dtype, StructType):
        return "STRUCT<" + ", ".join(f"{quote(f.name)}: {sql_type(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, ArrayType):
        return f"ARRAY<{sql_type(dtype.elementType)}>"
    if isinstance(dtype, MapType):
        return f"MAP<{sql_type(dtype.keyType)}, {sql_type(dtype.valueType)}>"
    return dtype.simpleString()


def same_shape(a: DataType, b: DataType) -> bool:
    """Equal types, ignoring nullability (no conversion needed between them)."""
    if isinstance(a, StructType) and isinstance(b, StructType):
        return len(a.fields) == len(b.fields) and all(
            x.name == y.name and same_shape(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields))
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return same_shape(a.elementType, b.elementType)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return same_shape(a.keyType, b.keyType) and same_shape(a.valueType, b.valueType)
    return a == b


def coerce_sql(expr: str, src: DataType, dst: DataType, depth: int = 0) -> str:
    """SQL expression turning ``expr`` (of type ``src``) into type ``dst``.

    Emitted as text so a whole projection is one ``selectExpr`` call, parsed
    once by the JVM, instead of one round trip per expression node.
    """
    if same_shape(src, dst):
        return expr
    null = f"CAST(NULL AS {sql_type(dst)})"
    if isinstance(dst, StructType):
        if isinstance(src, StringType):
            w = wire_schema(dst)
            return coerce_sql(f"from_json({expr}, {sql_string(sql_type(w))})", w, dst, depth)
        if not isinstance(src, StructType):
            return null
        have = {f.name: f.dataType for f in src.fields}
        parts = []
        for f in dst.fields:
            v = (coerce_sql(f"{expr}.{quote(f.name)}", have[f.name], f.dataType, depth) if f.name in have
                 else f"CAST(NULL AS {sql_type(f.dataType)})")
            parts.append(f"{sql_string(f.name)}, {v}")
        return f"CASE WHEN {expr} IS NULL THEN {null} ELSE named_struct({', '.join(parts)}) END"
    if isinstance(dst, ArrayType):
        if isinstance(src, StringType):
            w = wire_schema(dst)
            return coerce_sql(f"from_json({expr}, {sql_string(sql_type(w))})", w, dst, depth)
        if not isinstance(src, ArrayType):
            return null
        x = f"x{depth}"
        return f"transform({expr}, {x} -> {coerce_sql(x, src.elementType, dst.elementType, depth + 1)})"
    if isinstance(dst, StringType) and isinstance(src, (StructType, ArrayType, MapType)):
        return f"to_json({expr})"
    if isinstance(src, (StructType, ArrayType, MapType)):
        return null
    return f"try_cast({expr} AS {sql_type(dst)})"


def conform_to(df: DataFrame, schema: StructType, *, keep: list[str] | None = None) -> DataFrame:
    """Project ``df`` onto ``schema`` (order, drop unknown, null missing, coerce)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    exprs = [f"{coerce_sql(quote(f.name), have[f.name], f.dataType) if f.name in have else f'CAST(NULL AS {sql_type(f.dataType)})'}"
             f" AS {quote(f.name)}" for f in schema.fields]
    exprs += [quote(k) for k in (keep or []) if k not in schema.fieldNames()]
    return df.selectExpr(*exprs)


def conform(df: DataFrame, name: str, *, keep: list[str] | None = None) -> DataFrame:
    """Conform ``df`` to contract ``name``.

    ``keep`` names extra input columns to carry after the contract columns
    (lineage such as the source file); by default unknown columns are dropped.
    """
    return conform_to(df, contract(name), keep=keep)


def empty_table(spark, name: str) -> DataFrame:
    """An empty, fully typed table for contract ``name`` (K6)."""
    return spark.createDataFrame([], contract(name))
