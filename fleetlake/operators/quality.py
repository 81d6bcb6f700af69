"""Contract-quality checks (C3-C10), each a distributed job returning a table.

Checks that count (nullability, coercion loss, domains) run as ONE aggregate
pass over the data with one ``count_if`` per rule -- partial aggregation,
no shuffle of rows -- then the single result row is unpivoted to
(rule, violations). Schema-level checks (coverage / drift, polymorphic
merge) compare schemas, which are metadata; the schema of landed JSON is
inferred by a Spark job over the files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, DataType, StructField, StructType

from ..plans.contracts import contract, declared
from ..plans.domains import DOMAINS
from .conform import conform_to


def _unpivot_counts(df: DataFrame, rules: dict[str, Column], label: str = "rule") -> DataFrame:
    """One aggregate pass computing every rule's count, unpivoted to rows."""
    if not rules:
        spark = df.sparkSession
        return spark.createDataFrame([], f"`{label}` string, violations bigint")
    names = list(rules)
    one = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(rules.values())])
    pairs = [F.struct(F.lit(n).alias(label), F.col(f"c{i}").alias("violations")) for i, n in enumerate(names)]
    return one.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


# ------------------------------------------------------------ C3 / C5 ----

def _flatten_schema(dtype: DataType, prefix: str = "") -> dict[str, str]:
    out: dict[str, str] = {}
    if isinstance(dtype, StructType):
        for f in dtype.fields:
            p = f"{prefix}.{f.name}" if prefix else f.name
            out[p] = f.dataType.simpleString() if not isinstance(f.dataType, (StructType, ArrayType)) else _shape(f.dataType)
            out.update(_flatten_schema(f.dataType, p))
    elif isinstance(dtype, ArrayType):
        out.update(_flatten_schema(dtype.elementType, prefix + "[]"))
    return out


def _shape(dtype: DataType) -> str:
    if isinstance(dtype, StructType):
        return "struct"
    if isinstance(dtype, ArrayType):
        return "array<" + _shape(dtype.elementType) + ">"
    return dtype.simpleString()


def schema_drift(spark: SparkSession, observed: StructType, expected: StructType, *, wire: bool = False) -> DataFrame:
    """Differences between an observed schema and a contract.

    Rows (path, kind, expected, observed) with kind ``missing`` (declared,
    not seen), ``extra`` (seen, not declared) or ``type``. Nested fields are
    reported with dotted paths, array elements with ``[]``. With
    ``wire=True`` the observed side was read with every leaf as text, so
    only shape (struct / array nesting) is compared for leaves.
    """
    exp, obs = _flatten_schema(expected), _flatten_schema(observed)
    rows = []
    for p, t in exp.items():
        if p not in obs:
            rows.append((p, "missing", t, None))
        elif not wire and obs[p] != t and not (obs[p] in ("bigint", "double") and t in ("int", "bigint", "smallint", "float", "double")):
            rows.append((p, "type", t, obs[p]))
        elif wire and (obs[p].startswith(("struct", "array")) != t.startswith(("struct", "array"))):
            rows.append((p, "type", t, obs[p]))
    for p, t in obs.items():
        if p not in exp:
            rows.append((p, "extra", None, t))
    return spark.createDataFrame(rows, "path string, kind string, expected string, observed string")


def landed_drift(spark: SparkSession, paths: list[str], contract_name: str) -> DataFrame:
    """C3 over landed JSON: infer the files' schema (a Spark job) and diff it."""
    observed = spark.read.json(paths).schema
    return schema_drift(spark, observed, contract(contract_name))


def coercion_loss_report(wire_df: DataFrame, schema: StructType) -> DataFrame:
    """Per top-level scalar column, values present on the wire that did not
    survive the cast to the contract type (``try_cast`` gave null)."""
    have = set(wire_df.columns)
    rules = {}
    for f in schema.fields:
        if f.name in have and isinstance(f.dataType, AtomicType):
            c = F.col(f"`{f.name}`")
            rules[f.name] = c.isNotNull() & c.try_cast(f.dataType).isNull()
    return _unpivot_counts(wire_df, rules, "column")


# ------------------------------------------------------------------ C4 ----

def _in_any(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    def any_element(v: Column) -> Column:
        return F.coalesce(F.exists(v, lambda x: test(x)), F.lit(False))
    return any_element


def _at_field(name: str, test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda v: test(v.getField(name))


def _missing(name: str) -> Callable[[Column], Column]:
    return lambda v: v.isNotNull() & v.getField(name).isNull()


def _null_rules(dtype: DataType, have: DataType, path: str) -> list[tuple[str, Callable[[Column], Column]]]:
    """(path, violated-when) for every NOT NULL field below a value of the declared type
    ``dtype``, on all levels; fields that the data (``have``) lacks are left to the drift report."""
    out: list[tuple[str, Callable[[Column], Column]]] = []
    if isinstance(dtype, StructType) and isinstance(have, StructType):
        for f in dtype.fields:
            if f.name not in have.names:
                continue
            here = f"{path}.{f.name}"
            if not f.nullable:
                out.append((here, _missing(f.name)))
            out += [(p, _at_field(f.name, test)) for p, test in _null_rules(f.dataType, have[f.name].dataType, here)]
    elif isinstance(dtype, ArrayType) and isinstance(have, ArrayType):
        out += [(p, _in_any(test)) for p, test in _null_rules(dtype.elementType, have.elementType, f"{path}[]")]
    return out


def nullability_report(df: DataFrame, contract_name: str) -> DataFrame:
    """C4: per NOT NULL column (and NOT NULL field inside arrays / structs, on all levels), rows violating it."""
    rules: dict[str, Column] = {}
    for f in declared(contract_name).fields:
        if f.name not in df.columns:
            continue
        c = F.col(f"`{f.name}`")
        if not f.nullable:
            rules[f.name] = c.isNull()
        for path, test in _null_rules(f.dataType, df.schema[f.name].dataType, f.name):
            rules[path] = F.coalesce(test(c), F.lit(False))
    return _unpivot_counts(df, rules, "column")


# ------------------------------------------------------------------ C6 ----

def domain_report(df: DataFrame, columns: dict[str, str | list[str] | tuple[str, ...]]) -> DataFrame:
    """Per column, non-null values outside its domain.

    ``columns`` maps a column to an enum name from ``plans.domains`` or to an
    explicit list of allowed values. Short domains are literal ``IN`` lists
    inside the one aggregate pass.
    """
    rules = {}
    for c, dom in columns.items():
        values = list(DOMAINS[dom]) if isinstance(dom, str) else list(dom)
        col = F.col(f"`{c}`")
        rules[c] = col.isNotNull() & ~col.isin(values)
    return _unpivot_counts(df, rules, "column")


def domain_violations(df: DataFrame, column: str, domain: str | list[str]) -> DataFrame:
    """C6 row form: the rows whose ``column`` is outside the domain."""
    values = list(DOMAINS[domain]) if isinstance(domain, str) else list(domain)
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))


# ------------------------------------------------------------------ C7 ----

def merge_variant_schemas(base: StructType, children: list[StructType]) -> StructType:
    """One all-nullable struct: base fields first, then each child's own
    fields in order. Shared names must agree in type (else ``TypeError``)."""
    fields: dict[str, StructField] = {}
    for s in [base, *children]:
        for f in s.fields:
            if f.name in fields and fields[f.name].dataType != f.dataType:
                raise TypeError(f"field {f.name!r}: {fields[f.name].dataType.simpleString()} vs "
                                f"{f.dataType.simpleString()}")
            fields.setdefault(f.name, StructField(f.name, f.dataType, True))
    return StructType(list(fields.values()))


def union_variants(frames: list[DataFrame]) -> DataFrame:
    """C7 on data: union frames of sibling variants by name, missing columns null.

    Raises ``TypeError`` when a shared column has different types.
    """
    merge_variant_schemas(frames[0].schema, [f.schema for f in frames[1:]])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_nested_types(schemas: list[StructType]) -> tuple[StructType, list[tuple[str, str, str]]]:
    """C7 on all levels: (merged struct, conflicts).

    Structs merge field by field (order of first appearance, all nullable), arrays by their elements. Where
    two types can't meet, the first stays and (path, first type, other type) is reported; elements of an array are ``[]``.
    """
    conflicts: list[tuple[str, str, str]] = []

    def meet(a: DataType, b: DataType, path: str) -> DataType:
        if isinstance(a, StructType) and isinstance(b, StructType):
            fields = {f.name: f.dataType for f in a.fields}
            for f in b.fields:
                here = f"{path}.{f.name}" if path else f.name
                fields[f.name] = meet(fields[f.name], f.dataType, here) if f.name in fields else meet(f.dataType, f.dataType, here)
            return StructType([StructField(n, t, True) for n, t in fields.items()])
        if isinstance(a, ArrayType) and isinstance(b, ArrayType):
            return ArrayType(meet(a.elementType, b.elementType, path + "[]"), True)
        if a != b:
            conflicts.append((path, a.simpleString(), b.simpleString()))
        return a

    merged: DataType = StructType([])
    for s in schemas:
        merged = meet(merged, s, "")
    return merged, conflicts  # type: ignore[return-value]


def union_nested_variants(frames: list[DataFrame]) -> DataFrame:
    """C7 on data: sibling variants under the merged type of all levels, missing fields null, also in structs
    within arrays. ``TypeError`` names every field whose types conflict."""
    merged, conflicts = merge_nested_types([f.schema for f in frames])
    if conflicts:
        raise TypeError("; ".join(f"field {p!r}: {a} vs {b}" for p, a, b in conflicts))
    return reduce(lambda a, b: a.unionByName(b), [conform_to(f, merged) for f in frames])


# ------------------------------------------------------------------ C8 ----

# Fields each scan-authentication variant allows (shared base
# fields first), keyed by the ``type`` values of that variant.
AUTH_BASE_FIELDS = ("keyVaultUri", "keyVaultSecretName", "type")
AUTH_VARIANTS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "windows": (("None", "Ntlm", "Kerberos", "Negotiate"),
                ("username", "password", "domain", "isgmsaUser", "packetPrivacy", "packetIntegrity")),
    "linux": (("Password", "PrivateKey"), ("username", "password", "privateKey")),
    "snmp": (("CommunityString", "NoAuthNoPriv", "AuthNoPriv", "AuthPriv"),
             ("communityString", "username", "authProtocol", "authPassword", "privProtocol", "privPassword")),
}
# Boolean fields that default to false in a variant: a false value is not a violation.
AUTH_DEFAULT_FALSE = ("isgmsaUser", "packetPrivacy", "packetIntegrity")


def auth_variant_violations(df: DataFrame, column: str = "scanAuthenticationParams") -> DataFrame:
    """Per row, the fields set that its ``type`` variant does not allow.

    Adds ``authErrors`` (array of messages; empty = valid). An unknown
    ``type`` is itself an error.
    """
    s = F.col(column)
    fields = [f.name for f in df.schema[column].dataType.fields]  # type: ignore[attr-defined]
    t = s.getField("type")
    allowed_expr = F.lit(None).cast("array<string>")
    known_types: list[str] = []
    for types, own in reversed(list(AUTH_VARIANTS.values())):
        allowed_expr = F.when(t.isin(list(types)), F.array(*[F.lit(x) for x in (*AUTH_BASE_FIELDS, *own)])).otherwise(allowed_expr)
        known_types += list(types)
    checks = []
    for f in fields:
        if f in AUTH_BASE_FIELDS:
            continue
        v = s.getField(f)
        is_set = v.isNotNull() & (~F.lit(f in AUTH_DEFAULT_FALSE) | (v.cast("string") != "false"))
        checks.append(F.when(is_set & ~F.array_contains(allowed_expr, F.lit(f)),
                             F.concat(F.lit(f"field not allowed for type "), t, F.lit(f": {f}"))))
    unknown = F.when(s.isNotNull() & (t.isNull() | ~t.isin(known_types)), F.concat(F.lit("unknown auth type: "), F.coalesce(t, F.lit("null"))))
    errs = F.filter(F.array(unknown, *checks), lambda e: e.isNotNull())
    return df.withColumn("authErrors", F.when(s.isNull(), F.array().cast("array<string>")).otherwise(errs))


# ------------------------------------------------------------------ C9 ----

def validate_rows(df: DataFrame, rules: list[tuple[str, Column]], *, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Apply (message, violated-when) rules; return (valid, rejected).

    Every violated rule's message is collected into ``errors``; a row is
    valid when none fired. All rules are evaluated in one projection.
    """
    errs = F.filter(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(msg)) for msg, cond in rules]),
                    lambda e: e.isNotNull())
    tagged = df.withColumn(errors, errs)
    return tagged.filter(F.size(errors) == 0).drop(errors), tagged.filter(F.size(errors) > 0)


def required(col: str) -> tuple[str, Column]:
    return (f"{col} is required", F.col(col).isNull())


def min_length(col: str, n: int = 1) -> tuple[str, Column]:
    return (f"{col} must have at least {n} character(s)", F.col(col).isNotNull() & (F.length(col) < n))


def in_domain(col: str, domain: str) -> tuple[str, Column]:
    return (f"{col} must be one of {domain}", F.col(col).isNotNull() & ~F.col(col).isin(list(DOMAINS[domain])))


def in_range(col: str, lo: float | None = None, hi: float | None = None) -> tuple[str, Column]:
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    return (f"{col} must be in [{lo}, {hi}]", c.isNotNull() & bad)


def unknown_fields(df: DataFrame, allowed: list[str]) -> list[tuple[str, Column]]:
    """Columns not in the payload model (``extra="forbid"``) that carry a value."""
    return [(f"unknown field: {c}", F.col(f"`{c}`").isNotNull()) for c in df.columns if c not in allowed]


# ----------------------------------------------------------------- C10 ----

def reconcile(left: DataFrame, right: DataFrame, key: str | list[str], *,
              columns: list[str] | None = None, ignore: tuple[str, ...] = ("@odata.context",)) -> DataFrame:
    """(key, column, left, right) for every key/column where the tables differ.

    Full outer join on the key; a key present on one side only reports the
    ``_row`` pseudo-column. Timestamps are compared as UTC values (session
    TZ is UTC); values are shown as text. Null equals null.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = columns or [c for c in left.columns if c in right.columns and c not in keys and c not in ignore]
    l_ = left.select(*keys, *[F.col(c).alias(f"l_{c}") for c in cols], F.lit(True).alias("_l"))
    r_ = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in cols], F.lit(True).alias("_r"))
    j = l_.join(r_, keys, "full_outer")
    pairs = [F.struct(F.lit("_row").alias("column"),
                      F.when(F.col("_l").isNull(), F.lit("absent")).otherwise(F.lit("present")).alias("left"),
                      F.when(F.col("_r").isNull(), F.lit("absent")).otherwise(F.lit("present")).alias("right"),
                      (F.col("_l").isNull() | F.col("_r").isNull()).alias("differs"))]
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    for c in cols:
        lc, rc = F.col(f"l_{c}"), F.col(f"r_{c}")
        pairs.append(F.struct(F.lit(c).alias("column"), lc.cast("string").alias("left"), rc.cast("string").alias("right"),
                              (both & ~lc.eqNullSafe(rc)).alias("differs")))
    return (j.select(*keys, F.explode(F.array(*pairs)).alias("_d"))
             .filter("_d.differs").select(*keys, "_d.column", "_d.left", "_d.right"))
