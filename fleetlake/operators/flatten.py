"""Record transforms (A1-A4).

A1 flattens antivirus-health export records. The export wraps the health
fields in ``DeviceGatheredInfo`` -- a JSON object *encoded as a string* --
whose ``AvScanResults`` is again a JSON string, uses PascalCase names, and
relies on "set if absent" defaults. Absent and null keys therefore behave
differently, which a fixed-schema read cannot see; so each JSON level is
parsed once to a ``map<string, variant>`` (key present even when its value is
null) and every rule is a column expression on those maps. No Python runs
per row.

Rules, in order:

1. ``DeviceGatheredInfo``: a string is parsed (failure -> empty); an object is
   used; anything else -> empty.
2. non-Windows = top-level ``OsPlatform`` starts with macos / linux (any case);
   the scan placeholder is ``-`` there, else the empty string.
3. If the nested ``AvScanResults`` is a string: parse it; for Quick and Full
   set, only where the nested record lacks the key, ``*ScanResult`` <-
   ScanStatus, ``*ScanError`` <- ErrorCode (falsy -> placeholder) and
   ``*ScanTime`` <- Timestamp. A parse failure, or a non-object result, sets
   nothing; a truthy non-object Quick sets nothing; a truthy non-object Full
   leaves the Quick fields set.
4. Otherwise on non-Windows the four result / error fields default to ``-``.
5. Top-level keys win over nested ones, including a present-but-null key.
6. ``osKind`` if absent: windows* -> windows, linux* -> linux, macos* -> mac.
7. ``id`` if absent: ``machineId`` or ``DeviceId`` (first non-empty).
8. Boolean up-to-date flags become ``"True"`` / ``"False"``.
9. PascalCase names are renamed; then the record is conformed (C1).

Where a record holds a contract name *and* its PascalCase alias, the
top-level key wins over the nested one and, on one level, the contract name
wins over the alias (a stated choice; the upstream's outcome depends on key
order).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.contracts import contract
from .conform import conform
from .conform import quote as quote_ident

# --- fixed values: export -> contract field names for antivirus health ---
AV_FIELD_MAP: dict[str, str] = {
    "DeviceId": "machineId",
    "DeviceName": "computerDnsName",
    "OsPlatform": "osPlatform",
    "OsVersion": "osVersion",
    "LastSeenTime": "lastSeenTime",
    "RbacGroupId": "rbacGroupId",
    "RbacGroupName": "rbacGroupName",
    "AvMode": "avMode",
    "AvSignatureVersion": "avSignatureVersion",
    "AvEngineVersion": "avEngineVersion",
    "AvPlatformVersion": "avPlatformVersion",
    "AvEngineUpdateTime": "avEngineUpdateTime",
    "AvSignatureUpdateTime": "avSignatureUpdateTime",
    "AvPlatformUpdateTime": "avPlatformUpdateTime",
    "AvIsSignatureUptoDate": "avIsSignatureUpToDate",
    "AvIsEngineUptodate": "avIsEngineUpToDate",
    "AvIsPlatformUptodate": "avIsPlatformUpToDate",
    "AvSignaturePublishTime": "avSignaturePublishTime",
    "AvSignatureDataRefreshTime": "avSignatureDataRefreshTime",
    "AvModeDataRefreshTime": "avModeDataRefreshTime",
    "CloudProtectionState": "cloudProtectionState",
    "Timestamp": "dataRefreshTimestamp",
}
# --- fixed values: platform prefix -> osKind, checked in this order ---
OS_KIND_PREFIXES: tuple[tuple[str, str], ...] = (("windows", "windows"), ("linux", "linux"), ("macos", "mac"))
NON_WINDOWS_PREFIXES: tuple[str, ...] = ("macos", "linux")
SCAN_PLACEHOLDER = "-"
BOOL_FLAG_COLUMNS = ("avIsSignatureUpToDate", "avIsEngineUpToDate", "avIsPlatformUpToDate")


def _sql_text(v: str) -> str:
    return f"variant_get({v}, '$', 'string')"


def _sql_truthy(v: str) -> str:
    """Python truthiness of a JSON value: null, "", 0, false, {} and [] are falsy.

    Decided on the value's JSON text (one ``to_json``), which is cheaper than
    rendering its full type with ``schema_of_variant``.
    """
    t = f"to_json({v})"
    falsy = f"{v} IS NULL OR {t} IN ('null', '\"\"', 'false', '[]', '{{}}') OR try_cast({t} AS DOUBLE) = 0"
    return f"NOT coalesce({falsy}, false)"


def flatten_av_health(raw: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """A1: raw antivirus-health export lines (JSON text) -> device_av_info rows.

    Each JSON level (record, gathered-info blob, scan results, Quick / Full)
    is parsed once, in its own projection, into a ``map<string, variant>``.
    In such a map an absent key reads as SQL NULL while a key holding JSON
    null reads as a variant null, so "first present key wins" is a plain
    ``coalesce`` over the candidate lookups. Every rule is SQL text; no
    lambdas, no Python per row. The columns of ``raw`` named in ``keep`` go along.
    """
    keep = list(keep or [])
    along = [quote_ident(c) for c in keep]
    vmap = "map<string,variant>"
    empty = f"CAST(map() AS {vmap})"
    src = quote_ident(column)
    # Stage 1: the record (a line that is not a JSON object has no keys).
    s1 = raw.selectExpr(*along, f"coalesce(try_variant_get(try_parse_json({src}), '$', '{vmap}'), {empty}) AS _top")
    # Stage 2 (rules 1-2): the gathered-info blob -- a string is parsed, an object is
    # used (its JSON text parses to the same map); the platform from the top level.
    dgi = "_top['DeviceGatheredInfo']"
    dk = f"schema_of_variant({dgi})"
    os_platform = "_top['OsPlatform']"
    os_top = f"lower(coalesce({_sql_text(os_platform)}, ''))"
    s2 = s1.selectExpr(*along, "_top",
                       f"CASE WHEN {dk} = 'STRING' OR {dk} LIKE 'OBJECT%' THEN {_sql_text(dgi)} END AS _dgi",
                       " OR ".join(f"startswith({os_top}, '{p}')" for p in NON_WINDOWS_PREFIXES) + " AS _nonwin")
    s3 = s2.selectExpr(*along, "_top", "_nonwin", f"coalesce(try_variant_get(try_parse_json(_dgi), '$', '{vmap}'), {empty}) AS _nested")
    # Stage 3 (rule 3): AvScanResults -- a JSON string inside the nested record.
    av = "_nested['AvScanResults']"
    s4 = s3.selectExpr(*along, "_top", "_nested", "_nonwin", f"coalesce(schema_of_variant({av}) = 'STRING', false) AS _avstr")
    s5 = s4.selectExpr("*", f"try_variant_get(try_parse_json(CASE WHEN _avstr THEN {_sql_text(av)} END), '$', '{vmap}') AS _scans")
    s6 = s5.selectExpr(*along, "_top", "_nested", "_nonwin", "_avstr",
                       "_scans IS NOT NULL AS _scans_ok", "_scans['Quick'] AS _qv", "_scans['Full'] AS _fv",
                       f"try_variant_get(_scans['Quick'], '$', '{vmap}') AS _quick",
                       f"try_variant_get(_scans['Full'], '$', '{vmap}') AS _full")
    # A truthy non-object Quick sets nothing; a truthy non-object Full keeps Quick's three.
    s7 = s6.selectExpr("*", f"_scans_ok AND (NOT ({_sql_truthy('_qv')}) OR _quick IS NOT NULL) AS _quick_ok")
    s7 = s7.selectExpr("*", f"_quick_ok AND (NOT ({_sql_truthy('_fv')}) OR _full IS NOT NULL) AS _full_ok")

    placeholder = f"CASE WHEN _nonwin THEN '{SCAN_PLACEHOLDER}' ELSE '' END"

    def scan(part: str, key: str, ok: str, with_placeholder: bool) -> str:
        v = f"{part}['{key}']"
        if not with_placeholder:
            return f"CASE WHEN {ok} THEN {_sql_text(v)} END"
        val = f"coalesce(CASE WHEN {_sql_truthy(v)} THEN {_sql_text(v)} END, {placeholder})"
        # Rule 4: non-Windows without a string AvScanResults -> '-'.
        return f"CASE WHEN {ok} THEN {val} WHEN NOT _avstr AND _nonwin THEN '{SCAN_PLACEHOLDER}' END"

    def level(k: str) -> str:
        """Pre-rename merged value: the top-level key if present, else the nested one."""
        return _sql_text(f"coalesce(_top['{k}'], _nested['{k}'])")

    derived = {
        "quickScanResult": scan("_quick", "ScanStatus", "_quick_ok", True),
        "quickScanError": scan("_quick", "ErrorCode", "_quick_ok", True),
        "quickScanTime": scan("_quick", "Timestamp", "_quick_ok", False),
        "fullScanResult": scan("_full", "ScanStatus", "_full_ok", True),
        "fullScanError": scan("_full", "ErrorCode", "_full_ok", True),
        "fullScanTime": scan("_full", "Timestamp", "_full_ok", False),
        # Rule 6: osKind from the platform prefix; rule 7: id from machineId / DeviceId.
        "osKind": "CASE " + " ".join(f"WHEN startswith(_plat, '{p}') THEN '{k}'" for p, k in OS_KIND_PREFIXES) + " END",
        "id": f"coalesce(nullif({level('machineId')}, ''), nullif({level('DeviceId')}, ''))",
    }
    plat = f"lower(coalesce(nullif({level('OsPlatform')}, ''), nullif({level('osPlatform')}, ''), ''))"
    s8 = s7.selectExpr(*along, "_top", "_nested", "_quick", "_full", "_quick_ok", "_full_ok", "_avstr", "_nonwin", f"{plat} AS _plat")
    s9 = s8.selectExpr(*along, "_top", "_nested", *[f"{e} AS _d_{n}" for n, e in derived.items()])

    aliases: dict[str, list[str]] = {}
    for src_name, dst in AV_FIELD_MAP.items():
        aliases.setdefault(dst, []).append(src_name)
    popped = {"DeviceGatheredInfo", "AvScanResults"}
    exprs = []
    for f in contract("device_av_info").fields:
        keys = [k for k in (f.name, *aliases.get(f.name, [])) if k not in popped]
        # Rules 5 + 9: top level before nested; on one level the contract name before its alias.
        v = "coalesce(" + ", ".join([f"_top['{k}']" for k in keys] + [f"_nested['{k}']" for k in keys]) + ")"
        txt = _sql_text(v)
        if f.name in BOOL_FLAG_COLUMNS:  # rule 8: JSON booleans -> Python's True / False
            txt = f"CASE WHEN schema_of_variant({v}) = 'BOOLEAN' THEN initcap({txt}) ELSE {txt} END"
        if f.name in derived:  # set-if-absent defaults (rules 3, 4, 6, 7)
            txt = f"CASE WHEN {v} IS NULL THEN _d_{f.name} ELSE {txt} END"
        exprs.append(f"{txt} AS {quote_ident(f.name)}")
    return conform(s9.selectExpr(*exprs, *along), "device_av_info", keep=keep or None)


def apply_record_transform(df: DataFrame, transform: Callable | None, *, column: str = "value") -> DataFrame:
    """A2: user hook. ``None`` = identity.

    A DataFrame -> DataFrame function is applied with ``df.transform`` (stays
    in the JVM). A dict -> dict function is run per record on the executors
    over Arrow batches of the raw JSON lines (``mapInPandas``); its output is
    JSON text again, ready for a schema read.
    """
    if transform is None:
        return df
    if getattr(transform, "_frame_transform", False):
        return df.transform(transform)

    import json

    from ..session import ship_package

    ship_package(df.sparkSession)

    def run(batches):
        for pdf in batches:
            out = []
            for line in pdf[column]:
                if line is None:
                    out.append(None)
                    continue
                out.append(json.dumps(transform(json.loads(line))))
            yield pdf.assign(**{column: out})

    return df.mapInPandas(run, df.schema)


def frame_transform(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Mark ``fn`` as a DataFrame-level hook for :func:`apply_record_transform`."""
    fn._frame_transform = True  # type: ignore[attr-defined]
    return fn


def unwrap(df: DataFrame, wrapper: str) -> DataFrame:
    """A3: lift the fields of struct column ``wrapper`` to the top level.

    Outer columns win over inner fields of the same name (an outer column that
    exists keeps its value, null included); the wrapper column is dropped.
    """
    outer = [c for c in df.columns if c != wrapper]
    inner = [f.name for f in df.schema[wrapper].dataType.fields if f.name not in outer]  # type: ignore[attr-defined]
    return df.select(*[F.col(f"`{c}`") for c in outer], *[F.col(f"`{wrapper}`").getField(f).alias(f) for f in inner])


def rename_fields(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """A4: rename columns present in ``mapping`` (absent ones are ignored)."""
    m = {k: v for k, v in (mapping or AV_FIELD_MAP).items() if k in df.columns}
    return df.withColumnsRenamed(m) if m else df
