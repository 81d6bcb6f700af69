"""Table updates from change-sets.

The upstream sends write calls with payload models; here a change-set is a
DataFrame of payload rows and every operation returns the new table version
(and, where the upstream reports one, a per-row outcome). Joins between a
table and its change-set are equi-joins on the key, left to AQE: a small
change-set is broadcast at run time, a large one is a sort-merge join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.joins import BROADCAST_MAX_BYTES, estimated_row_bytes, rows_at_most, spread
from . import quality as Q
from .changes import latest_per_key
from .conform import conform

ALERT_PATCH_FIELDS = ("status", "assignedTo", "classification", "determination")


def _merged_patches(changes: DataFrame, key: str, fields: list[str], seq: str | None, comment: Column | None = None) -> DataFrame:
    """One patch per key. A null field of a patch changes nothing, so each field takes its
    latest non-null value by ``seq``; comments are all kept, in order. Several patches
    for one key without ``seq`` have no defined result and fail the job."""
    order = F.col(seq) if seq else F.lit(0)
    # the value breaks ties of the order, so that the result is determined
    latest = [F.max(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v")))).getField("v").alias(c) for c in fields]
    said = [] if comment is None else [F.sort_array(F.collect_list(F.when(F.col("comment").isNotNull(), F.struct(order.alias("o"), comment.alias("c"))))).alias("_said")]
    out = changes.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *latest, *said)
    if not seq:
        several = F.raise_error(F.concat(F.lit(f"several patches for one {key} need an order column: "), F.col(key).cast("string")))
        out = out.withColumn(key, F.when(F.col("_n") > 1, several.cast(changes.schema[key].dataType)).otherwise(F.col(key)))
    return out.drop("_n")


def patch_alerts(alerts: DataFrame, changes: DataFrame, *, seq: str | None = None,
                 comment_author: str = "createdBy", comment_time: str = "createdTime") -> DataFrame:
    """Set the non-null fields of each patch on its alerts.

    ``changes`` rows carry ``alertIds`` (array) or ``alertId`` plus any of
    status / assignedTo / classification / determination / comment. Several
    patches of one alert apply in the order of ``seq`` (required then): each field
    ends with its last non-null value, and every ``comment`` is appended to the
    alert's ``comments``. Domains are checked inline (C6): a value outside its
    domain fails the job.
    """
    ids = F.explode("alertIds") if "alertIds" in changes.columns else F.col("alertId")
    cols = [c for c in (*ALERT_PATCH_FIELDS, "comment", comment_author, comment_time, seq) if c and c in changes.columns]
    flat = _check_domains(changes.select(ids.alias("id"), *cols),
                          {"status": "ALERT_STATUS", "classification": "ALERT_CLASSIFICATION",
                           "determination": "ALERT_DETERMINATION"})
    fields = [c for c in ALERT_PATCH_FIELDS if c in cols]
    comment = None
    if "comment" in cols:
        comment = F.struct(F.col("comment").alias("comment"),
                           (F.col(comment_author) if comment_author in cols else F.lit(None)).cast("string").alias("createdBy"),
                           (F.col(comment_time).cast("timestamp") if comment_time in cols else F.current_timestamp()).alias("createdTime"))
    p = _merged_patches(flat, "id", fields, seq, comment)
    j = alerts.join(p.select(F.col("id"), *[F.col(c).alias(f"_p_{c}") for c in fields], *(["_said"] if comment is not None else [])), "id", "left")
    out = []
    for c in alerts.columns:
        if c in fields:
            out.append(F.coalesce(F.col(f"_p_{c}"), F.col(c)).alias(c))
        elif c == "comments" and comment is not None:
            kind = alerts.schema["comments"].dataType
            appended = F.concat(F.coalesce(F.col("comments"), F.array().cast(kind)), F.transform("_said", lambda x: x.getField("c")).cast(kind))
            out.append(F.when(F.size("_said") > 0, appended).otherwise(F.col("comments")).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def _check_domains(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Fail the job on a value outside its enum domain (checked inline, lazily:
    no separate validation pass over the change-set)."""
    from ..plans.domains import DOMAINS

    for c, dom in columns.items():
        if c not in df.columns:
            continue
        col = F.col(c)
        bad = col.isNotNull() & ~col.isin(list(DOMAINS[dom]))
        df = df.withColumn(c, F.when(bad, F.raise_error(F.concat(F.lit(f"{c} outside domain {dom}: "), col)))
                              .otherwise(col))
    return df


def _required(df: DataFrame, column: str) -> tuple[str, Column]:
    """The rule that ``column`` is given; a frame without it violates the rule in every row."""
    return Q.required(column) if column in df.columns else (f"{column} is required", F.lit(True))


ALERT_REQUIRED = ("machineId", "severity", "title", "description", "recommendedAction", "category", "eventTime", "reportId")


def create_alerts(alerts: DataFrame, requests: DataFrame, machines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Create alerts from event references.

    Rules (C9): all fields are required (a column that is absent rejects every
    row); severity must be an alert severity, category an alert category that
    does not contain ``Unknown``; the machine must be known. Valid requests get the
    machine's name by join and are appended; returns (alerts, rejected).

    The alert's id follows from the report and the machine, so the operation is idempotent: a
    request whose alert the table already has changes nothing, and of several for one
    alert the one with the latest ``eventTime`` counts (then the greatest of the other fields).
    """
    m = machines.select(F.col("id").alias("_m"), "computerDnsName", "rbacGroupName")
    asked = requests.drop("computerDnsName", "rbacGroupName")
    if "machineId" in asked.columns:
        asked = asked.join(m, F.col("machineId") == F.col("_m"), "left")
    else:
        asked = asked.withColumn("_m", F.lit(None).cast("string"))
    rules = [_required(requests, c) for c in ALERT_REQUIRED]
    if "severity" in requests.columns:
        rules.append(Q.in_domain("severity", "ALERT_SEVERITY"))
    if "category" in requests.columns:
        rules += [Q.in_domain("category", "IOA_CATEGORY"), ("category cannot be Unknown", F.col("category").contains("Unknown"))]
    if "machineId" in requests.columns:
        rules.append(("machineId is not a known machine", F.col("machineId").isNotNull() & F.col("_m").isNull()))
    valid, rejected = Q.validate_rows(asked, rules)
    rejected = rejected.select(*requests.columns, "errors")
    if not set(ALERT_REQUIRED) <= set(requests.columns):
        return alerts, rejected
    new = (valid.withColumn("id", F.concat_ws("_", F.lit("ref"), F.col("reportId"), F.col("machineId")))
                .withColumn("status", F.lit("New"))
                .withColumn("alertCreationTime", F.col("eventTime").cast("timestamp"))
                .withColumn("lastEventTime", F.col("eventTime").cast("timestamp")).drop("_m"))
    rest = [c for c in new.columns if c not in ("id", "alertCreationTime", "lastEventTime")]
    last = F.max(F.struct("alertCreationTime", "lastEventTime", *rest)).alias("_r")
    new = new.groupBy("id").agg(last).select("id", "_r.*").join(alerts.select("id"), "id", "left_anti")
    return alerts.unionByName(conform(new, "alert")), rejected


def upsert(table: DataFrame, changes: DataFrame, key: str | list[str], *, order: list[str] | None = None) -> DataFrame:
    """Insert or replace rows by ``key`` (the latest change per key by ``order``; without
    it, several changes for one key fail the job, as no winner is defined).

    ``table`` is keyed (one row per key). One pass over the change-set
    (latest per key as a partial aggregate) and one full outer join with the
    table on the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ch = latest_per_key(changes, keys, order) if order else _only_one(changes, keys)
    values = [c for c in table.columns if c not in keys]
    new = ch.select(*keys, F.struct(*[F.col(f"`{c}`") if c in ch.columns else F.lit(None).cast(table.schema[c].dataType)
                                      for c in values]).alias("_new"))
    old = table.select(*keys, F.struct(*[F.col(f"`{c}`") for c in values]).alias("_old"))
    j = old.join(new, keys, "full_outer")
    take_new = F.col("_new").isNotNull()
    return j.select(*keys, *[F.when(take_new, F.col(f"_new.`{c}`")).otherwise(F.col(f"_old.`{c}`")).alias(c)
                             for c in values]).select(*table.columns)


def _only_one(changes: DataFrame, keys: list[str]) -> DataFrame:
    """``changes`` with one row per key; a key with several fails the job."""
    rest = [c for c in changes.columns if c not in keys]
    one = changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(1)).alias("_r"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"several changes for one {', '.join(keys)} need an order"))).otherwise(F.lit(True))
    return one.where(checked.cast("boolean")).select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in rest])


INDICATOR_KEY = ("indicatorType", "indicatorValue")


def indicator_rules(df: DataFrame) -> list[tuple[str, Column]]:
    """C9 rules for indicator submissions / imports."""
    rules = [_required(df, c) for c in ("indicatorValue", "indicatorType", "action")]
    if "indicatorValue" in df.columns:
        rules.append(Q.min_length("indicatorValue"))
    rules += [Q.in_domain(c, d) for c, d in (("indicatorType", "TI_INDICATOR_TYPE"), ("action", "TI_INDICATOR_ACTION")) if c in df.columns]
    if "severity" in df.columns:
        rules.append(Q.in_domain("severity", "SEVERITY"))
    if "title" in df.columns:
        rules.append(Q.required("title"))
    return rules


def import_indicators(indicators: DataFrame, submissions: DataFrame, *, order: list[str] | None = None, batch_size: int = 500) -> tuple[DataFrame, DataFrame]:
    """Batch import with a per-row outcome.

    Valid submissions of one indicator are imported in ``order``, so the last one
    stays; several without ``order`` fail the job.

    Returns (new indicator table, results) where results has the inline
    import-result contract ``id, indicator, isFailed, failureReason`` plus the
    write batch each row went in (L5: at most ``batch_size`` rows per batch).
    Valid rows are upserted on (indicatorType, indicatorValue).
    """
    from .slicing import assign_batches

    valid, rejected = Q.validate_rows(submissions, indicator_rules(submissions))
    if not {*INDICATOR_KEY, "action"} <= set(submissions.columns):
        value = F.col("indicatorValue") if "indicatorValue" in submissions.columns else F.lit(None)
        return indicators, assign_batches(rejected.select(
            F.lit(None).cast("string").alias("id"), value.cast("string").alias("indicator"), F.lit(True).alias("isFailed"),
            F.array_join("errors", "; ").alias("failureReason")), batch_size)
    valid = valid.withColumn("id", F.sha2(F.concat_ws("|", *INDICATOR_KEY), 256))
    last = latest_per_key(valid, list(INDICATOR_KEY), order) if order else _only_one(valid, list(INDICATOR_KEY))
    table = upsert(indicators, conform(last, "indicator"), list(INDICATOR_KEY))
    ok = valid.select("id", F.col("indicatorValue").alias("indicator"), F.lit(False).alias("isFailed"),
                      F.lit(None).cast("string").alias("failureReason"))
    bad = rejected.select(F.lit(None).cast("string").alias("id"), F.col("indicatorValue").alias("indicator"),
                          F.lit(True).alias("isFailed"), F.array_join("errors", "; ").alias("failureReason"))
    return table, assign_batches(ok.unionByName(bad), batch_size)


def delete_by_ids(table: DataFrame, ids: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Remove the ids; outcome rows (id, found) report ids that did not exist."""
    k = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
    remaining = table.join(k, key, "left_anti")
    found = k.join(table.select(key).distinct().withColumn("found", F.lit(True)), key, "left") \
             .select(key, F.coalesce("found", F.lit(False)).alias("found"))
    return remaining, found


def _leaves(kind: StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths of the fields of a struct type that are no structs themselves."""
    out: list[tuple[str, ...]] = []
    for f in kind.fields:
        out += _leaves(f.dataType, (*path, f.name)) if isinstance(f.dataType, StructType) else [(*path, f.name)]
    return out


def _at(column: Column, path: tuple[str, ...]) -> Column:
    return reduce(lambda c, name: c.getField(name), path, column)


def _group(tags: dict[str, str], tag: Column) -> Column:
    """The variant that a tag belongs to (null for none)."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in tags.items() for x in kv]), tag)


def deep_patch(table: DataFrame, changes: DataFrame, *, key: str = "id", seq: str | None = None, tags: dict[str, tuple[str, dict[str, str]]] | None = None) -> DataFrame:
    """``table`` with ``changes`` merged in by ``key``, keys that it lacks inserted.

    Structs are merged field by field, at any depth: every leaf takes its last non-null value in the order
    of ``seq`` (required where a key has several changes), else the table's; arrays and maps are leaves. ``tags``
    names the struct columns that are tagged unions: the field that holds the tag, and the variant of each tag value.
    As if the changes were made one by one, a change of variant clears what was set before it.

    Partial aggregates over the changes keep one value per leaf (and when each variant was named), so a key
    with any number of changes is never gathered, and one full outer join meets the table. Columns of ``changes`` that ``table``
    lacks are dropped; null keys match nothing and their changes are dropped.
    """
    tags = {c: t for c, t in (tags or {}).items() if c in table.columns and c in changes.columns}
    order = F.col(seq) if seq else F.lit(0)
    columns = [c for c in table.columns if c != key and c in changes.columns]
    paths = {c: _leaves(table.schema[c].dataType) if isinstance(table.schema[c].dataType, StructType) else [()] for c in columns}
    given = changes.where(F.col(key).isNotNull()).select(F.col(key), *([] if not seq else [F.col(seq)]), *[F.col(c).cast(table.schema[c].dataType) for c in columns])
    last = [F.max(F.when(_at(F.col(c), p).isNotNull(), F.struct(order.alias("o"), _at(F.col(c), p).alias("v")))).alias(f"_{c}_{k}")
            for c in columns for k, p in enumerate(paths[c])]
    new = given.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *last)
    if not seq:
        several = F.raise_error(F.concat(F.lit(f"several changes for one {key} need an order column: "), F.col(key).cast("string")))
        new = new.withColumn(key, F.when(F.col("_n") > 1, several.cast(table.schema[key].dataType)).otherwise(F.col(key)))
    for c, (field, groups) in tags.items():
        named = given.select(F.col(key).alias("_key"), order.alias("_o"), _group(groups, F.col(c).getField(field)).alias("_g")).where("_g is not null")
        new = new.join(_last_variant(named, sorted(set(groups.values())), c), F.col(key) == F.col(f"_{c}_key"), "left")
    joined = table.join(new, key, "full_outer")
    out = []
    for c in table.columns:
        if c not in columns:
            out.append(F.col(c))
            continue
        values = {}
        place = {path: k for k, path in enumerate(paths[c])}
        fresh_counts = old_counts = F.lit(True)
        if c in tags:
            field, groups = tags[c]
            old_group = _group(groups, _at(F.col(c), (field,)))
            changed = F.col(f"_{c}_other") | F.coalesce(old_group != F.col(f"_{c}_group"), F.lit(False))
            cleared = F.when(changed, F.col(f"_{c}_since"))  # null where the variant stays
            old_counts = cleared.isNull()
        for path, k in place.items():
            change = F.col(f"_{c}_{k}")
            if c in tags:
                fresh_counts = F.coalesce(change.getField("o") >= cleared, F.lit(True))
            values[path] = F.coalesce(F.when(fresh_counts, change.getField("v")), F.when(old_counts, _at(F.col(c), path)))
        merged = _rebuilt(table.schema[c].dataType, values)
        if paths[c] != [()]:  # no empty structs where neither side has one
            merged = F.when(F.col(c).isNotNull() | reduce(lambda a, b: a | b, [F.col(f"_{c}_{k}").isNotNull() for k in place.values()]), merged)
        out.append(merged.alias(c))
    return joined.select(*out)


def _last_variant(named: DataFrame, variants: list[str], c: str) -> DataFrame:
    """Per key of ``named(_key, _o, _g)``: the variant named last, since when no other was named, and
    whether another was named before."""
    per = named.groupBy("_key").agg(F.max(F.struct("_o", "_g")).getField("_g").alias("_last"),
                                    *[F.max(F.when(F.col("_g") == g, F.col("_o"))).alias(f"_at{i}") for i, g in enumerate(variants)])
    others = [F.when(F.col("_last") != g, F.col(f"_at{i}")) for i, g in enumerate(variants)]
    per = per.select(F.col("_key").alias(f"_{c}_key"), F.col("_last").alias(f"_{c}_group"), (F.greatest(*others) if len(others) > 1 else others[0]).alias("_m"))
    run = named.join(per, (F.col("_key") == F.col(f"_{c}_key")) & (F.col("_g") == F.col(f"_{c}_group")) & F.coalesce(F.col("_o") > F.col("_m"), F.lit(True)))
    return run.groupBy(f"_{c}_key", f"_{c}_group").agg(F.min("_o").alias(f"_{c}_since"), F.max(F.col("_m").isNotNull()).alias(f"_{c}_other"))


def _rebuilt(kind, values: dict[tuple[str, ...], Column], path: tuple[str, ...] = ()) -> Column:
    if not isinstance(kind, StructType):
        return values[path]
    fields = [_rebuilt(f.dataType, values, (*path, f.name)).alias(f.name) for f in kind.fields]
    inner = F.struct(*fields)
    if path:  # a nested struct without any value stays null
        under = [v for p, v in values.items() if p[: len(path)] == path]
        inner = F.when(reduce(lambda a, b: a | b, [v.isNotNull() for v in under]), inner)
    return inner


def update_scan_definitions(defs: DataFrame, changes: DataFrame, *, key: str = "id", seq: str | None = None) -> tuple[DataFrame, DataFrame]:
    """W7 add / update: C8-check the auth struct, then patch or insert (:func:`deep_patch`).

    Returns (definitions, rejected): rejected changes carry ``authErrors``; one without a key is
    rejected too. Fields null in a change keep their value, also inside structs; several changes of
    one definition apply in the order of ``seq`` (required then). When the authentication changes to a
    type of another kind, the settings of the old kind go.
    """
    checked = Q.auth_variant_violations(changes) if "scanAuthenticationParams" in changes.columns \
        else changes.withColumn("authErrors", F.array().cast("array<string>"))
    no_key = F.when(F.col(key).isNull(), F.array(F.lit(f"{key} is required"))).otherwise(F.array().cast("array<string>"))
    checked = checked.withColumn("authErrors", F.concat("authErrors", no_key))
    rejected = checked.filter(F.size("authErrors") > 0)
    ok = checked.filter(F.size("authErrors") == 0).drop("authErrors")
    kinds = {t: kind for kind, (types, _) in Q.AUTH_VARIANTS.items() for t in types}
    tags = {"scanAuthenticationParams": ("type", kinds)} if "scanAuthenticationParams" in ok.columns else {}
    return deep_patch(defs, ok, key=key, seq=seq, tags=tags), rejected


def tag_machines(machines: DataFrame, changes: DataFrame) -> DataFrame:
    """Add / remove tags on many machines.

    ``changes`` rows: Value, Action (Add / Remove), MachineIds. Per machine,
    all additions are applied, then all removals; a null tag list counts as
    empty.
    """
    changes = _check_domains(changes, {"Action": "TAG_ACTION"})
    ops = changes.select(F.explode("MachineIds").alias("id"), "Value", "Action")
    per = ops.groupBy("id").agg(
        F.collect_set(F.when(F.col("Action") == "Add", F.col("Value"))).alias("_add"),
        F.collect_set(F.when(F.col("Action") == "Remove", F.col("Value"))).alias("_rm"))
    j = machines.join(per, "id", "left")
    tags = F.array_except(F.array_union(F.coalesce("machineTags", F.array().cast("array<string>")),
                                        F.coalesce("_add", F.array().cast("array<string>"))),
                          F.coalesce("_rm", F.array().cast("array<string>")))
    new = F.when(F.col("_add").isNull(), F.col("machineTags")).otherwise(tags)
    return j.select(*[new.alias(c) if c == "machineTags" else F.col(c) for c in machines.columns])


def set_machine_fields(machines: DataFrame, changes: DataFrame, fields: tuple[str, ...],
                       domains: dict[str, str] | None = None, *, seq: str | None = None) -> DataFrame:
    """Set fields (e.g. deviceValue; isExcluded + exclusionReason) by machine id.

    Several changes for one machine apply in the order of ``seq`` (required
    then): each field ends with its last non-null value. Null fields in a change
    keep the machine's value.
    """
    changes = _check_domains(changes, domains or {})
    cols = ["id", *fields, *([seq] if seq else [])]
    p = _merged_patches(changes.select(*cols), "id", list(fields), seq).select("id", *[F.col(f).alias(f"_p_{f}") for f in fields])
    j = machines.join(p, "id", "left")
    return j.select(*[F.coalesce(F.col(f"_p_{c}"), F.col(c)).alias(c) if c in fields else F.col(c)
                      for c in machines.columns])


def parse_serialized(changes: DataFrame, column: str, schema) -> DataFrame:
    """Rows of serialized JSON text -> typed change-set rows. A text that is null or no JSON object of
    the schema fails the job; :func:`split_serialized` returns such rows instead."""
    good, bad = split_serialized(changes, column, schema)
    failed = bad.select(F.raise_error(F.concat(F.lit("serialized row: "), F.col("reason"))).cast("string").alias("_e"))
    checked = failed.where(F.col("_e").isNotNull()).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema])
    return good.unionByName(checked)


def split_serialized(changes: DataFrame, column: str, schema) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows): rejected rows keep all their columns and get ``reason``: the text is
    null, is no JSON object, or a value does not fit its field's type."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    probe = StructType([*kind.fields, StructField("_bad", StringType())])
    read = changes.withColumn("_r", F.from_json(F.col(column), probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    shape = F.expr(f"schema_of_variant(try_parse_json(`{column}`))")
    reason = (F.when(F.col(column).isNull(), F.lit("no text")).when(shape.isNull(), F.lit("not JSON"))
              .when(~shape.startswith("OBJECT"), F.lit("not a JSON object")).when(F.col("_r._bad").isNotNull(), F.lit("a value does not fit its type")))
    read = read.withColumn("_reason", reason)
    good = read.where("_reason is null").select(*[F.col(f"_r.`{f.name}`") for f in kind.fields])
    return good, read.where("_reason is not null").select(*[F.col(f"`{c}`") for c in changes.columns], F.col("_reason").alias("reason"))


def add_device_groups(groups: DataFrame, new: DataFrame, *, order: list[str] | None = None) -> DataFrame:
    """W12 add: append groups whose id is not taken yet. Several new groups of one id: the last by
    ``order`` counts; without it they fail the job."""
    one = latest_per_key(new, ["id"], order) if order else _only_one(new, ["id"])
    return groups.unionByName(one.join(groups.select("id"), "id", "left_anti").select(*groups.columns))


def delete_device_groups(groups: DataFrame, ids: DataFrame) -> DataFrame:
    """W12 delete."""
    return groups.join(ids.select(F.col(ids.columns[0]).alias("id")), "id", "left_anti")


#: Rule lists of a device group, and the machine value each is held against.
_RULE_LISTS = {"name": "devicesNamesConditions", "domain": "devicesDomainsConditions", "tag": "devicesTagsConditions", "os": "devicesOsConditions"}


#: Characters of a prefix or suffix pattern that are looked up, and of the piece of a Contains pattern.
EDGE, PIECE = 32, 8
#: Parts, by machine, in which a key is joined with many rules.
KEY_PARTS = 16
_PIECES = "if(size = 0, array(''), array_distinct(transform(sequence(1, length(value) - size + 1), i -> substring(value, i, size))))"
_KEYS = f"""CASE test WHEN 'in' THEN array(value) WHEN 'startswith' THEN array(left(value, size)) WHEN 'endswith' THEN array(right(value, size))
    ELSE {_PIECES} END"""


def _group_rules(groups: DataFrame) -> DataFrame:
    """(gid, priority, need, kind, test, value, size, at): one row per rule value of every group, lower-cased.
    ``need`` has a bit for each kind of which the group has rules; ``at`` is the key, ``size`` characters long,
    that the rule is found by: the whole value, the first or last characters of it, or a piece of it."""
    g = groups.where(~F.coalesce("isUnassignedDeviceGroup", F.lit(False)) & F.col("deviceGroupRules").isNotNull())
    lists, need = [], F.lit(0)
    for k, (kind, column) in enumerate(_RULE_LISTS.items()):
        rules = F.col(f"deviceGroupRules.{column}")
        test = "lower(coalesce(r.condition, 'In'))" if kind == "os" else "lower(coalesce(r.condition, ''))"
        # a list of values is OR; a rule without values still counts as a rule, and matches nothing
        values = "coalesce(r.valuesList, array())" if kind == "os" else "array(r.value)"
        lists.append(f"""flatten(transform(coalesce(deviceGroupRules.{column}, array()), r -> transform({values}, v ->
            named_struct('kind', {k}, 'test', if({test} = 'equals', 'in', {test}), 'value', lower(v)))))""")
        need = need + F.when(F.size(F.coalesce(rules, F.array().cast(groups.schema["deviceGroupRules"].dataType[column].dataType))) > 0, 1 << k).otherwise(0)
    rules = g.select(F.col("id").alias("gid"), "priority", need.alias("need"), F.explode(F.expr(f"concat({', '.join(lists)})")).alias("r"))
    rules = rules.select("gid", "priority", "need", "r.*").where("value is not null and test in ('in', 'startswith', 'endswith', 'contains')")
    rules = rules.withColumn("size", F.expr(f"CASE test WHEN 'in' THEN -1 WHEN 'contains' THEN least(length(value), {PIECE}) ELSE least(length(value), {EDGE}) END"))
    # of the pieces of a Contains pattern the one with the least hash, so that patterns spread over keys
    return rules.withColumn("at", F.expr(f"array_min(transform({_KEYS}, x -> named_struct('h', xxhash64(x), 'x', x))).x"))


def assign_device_groups(spark: SparkSession, machines: DataFrame, groups: DataFrame) -> DataFrame:
    """Evaluate device-group rules; each machine gets the matching group
    with the lowest ``priority`` (ties: lowest id), else the unassigned group.

    Rules: name conditions on ``computerDnsName``, domain conditions on the
    DNS suffix, tag conditions on any tag, OS conditions (``valuesList``) on
    ``osPlatform``. Inside one list any condition may match (OR); across
    lists all non-empty lists must match (AND) -- a stated choice. A group
    with no rules matches nothing.

    All conditions are looked up by one equi-join: ``Equals`` and ``In`` by the value, ``StartsWith`` and
    ``EndsWith`` by the first or last characters of the lengths that occur in rules (at most
    ``EDGE``), ``Contains`` by a piece of the pattern (at most ``PIECE`` characters) among the pieces of the
    value; what a key finds is then held against the whole pattern. So a machine meets the rules that
    share a key with it, not all rules; nothing is gathered, nothing runs on the driver. A group
    matches where all its lists do (a bit each); the best one is a minimum per machine. Machines are spread
    over tasks by id before their keys are made, as each makes many rows. Few rules are broadcast; many are repeated
    ``KEY_PARTS`` times, so that a key that most machines have (a piece of a common name) is joined in so many parts.
    """
    rules = _group_rules(groups)
    # at most 4 kinds x (2 x 33 edges + 9 pieces + 1) rows
    sizes = F.broadcast(rules.select("kind", "test", "size").distinct())
    name = F.lower("computerDnsName")
    tags = F.coalesce("machineTags", F.array().cast("array<string>"))
    values = F.array(F.array(name), F.array(F.regexp_extract(name, r"^[^.]*\.(.*)$", 1)), F.transform(tags, F.lower), F.array(F.lower("osPlatform")))
    held = spread(machines.where("id is not null").select(F.col("id").alias("_mid"), "computerDnsName", "machineTags", "osPlatform"), "_mid")
    each = held.select("_mid", F.posexplode(values).alias("kind", "vs")).select("_mid", "kind", F.explode("vs").alias("value"))
    keys = each.where("value is not null").join(sizes, "kind").where("size <= length(value)")
    keys = keys.select("_mid", "kind", "test", "size", F.col("value").alias("_value"), F.explode(F.expr(_KEYS)).alias("at"))
    whole = F.expr("CASE test WHEN 'in' THEN true WHEN 'startswith' THEN startswith(_value, value) WHEN 'endswith' THEN endswith(_value, value) ELSE contains(_value, value) END")
    on = ["kind", "test", "size", "at"]
    if rows_at_most(rules, BROADCAST_MAX_BYTES // estimated_row_bytes(rules.schema)):
        found = keys.join(F.broadcast(rules), on).where(whole)
    else:
        parts = F.explode(F.sequence(F.lit(0), F.lit(KEY_PARTS - 1)))
        # merged: repeated rules are small as shuffled bytes, but not as a broadcast table
        keys = keys.withColumn("_part", F.pmod(F.xxhash64("_mid"), F.lit(KEY_PARTS)).cast("int"))
        found = keys.join(rules.withColumn("_part", parts).hint("merge"), [*on, "_part"]).where(whole)
    matched = found.groupBy("_mid", "gid", "priority", "need").agg(F.bit_or(F.expr("shiftleft(1, kind)")).alias("_have")).where("_have = need")
    best = matched.groupBy("_mid").agg(F.min(F.struct("priority", "gid")).alias("_best"))
    rest = groups.where(F.coalesce("isUnassignedDeviceGroup", F.lit(False))).agg(F.min(F.struct("priority", "id")).alias("u")).select("u.id").scalar()
    return (machines.join(best, F.col("id") == F.col("_mid"), "left")
            .withColumn("deviceGroupId", F.coalesce(F.col("_best.gid"), rest)).drop("_mid", "_best"))
