"""Stand-in entity tables built from the driver's star-schema test tables.

These builders only reshape rows into the contract columns the operators
expect (SURVEY 7.3); they do none of an operator's work. Operators never
assume anything about how these rows were made -- they take column names and
run the same on landed exports.

Mapping (all deterministic per row):

* machine   <- customer   (id = c_custkey, rbacGroupId = c_nationkey, ...)
* alert     <- orders     (id = o_orderkey, machineId = o_custkey, ...)
* evidence  <- lineitem   (nested under its alert; sha1 = l_partkey, ...)
* asset_software / asset_vulnerability <- orders JOIN lineitem
* software catalog <- part, vulnerability catalog <- supplier
* logon rows, delta feed <- events
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import conform

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_TABLES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, resolved once per session (file listing + footer schema)
    and reused like a catalog table; every action still reads the files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark._jsparkSession), path)  # noqa: SLF001 - one entry per live session
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


# --- SQL expressions per stand-in column (kept as text so tests can mirror them) ---

MACHINE_COLUMNS = {
    "id": "CAST(c_custkey AS STRING)",
    "computerDnsName": "c_name",
    "rbacGroupId": "c_nationkey",
    "rbacGroupName": "'group-' || CAST(c_nationkey AS STRING)",
    "healthStatus": ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Active' WHEN 'BUILDING' THEN 'Inactive' "
                     "WHEN 'FURNITURE' THEN 'ImpairedCommunication' WHEN 'HOUSEHOLD' THEN 'NoSensorData' "
                     "ELSE 'Unknown' END"),
    "riskScore": ("CASE WHEN c_acctbal < 0 THEN 'None' WHEN c_acctbal < 2000 THEN 'Informational' "
                  "WHEN c_acctbal < 5000 THEN 'Low' WHEN c_acctbal < 8000 THEN 'Medium' ELSE 'High' END"),
    "exposureLevel": ("CASE c_nationkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' "
                      "ELSE 'High' END"),
    "osPlatform": ("CASE c_nationkey % 5 WHEN 0 THEN 'Windows10' WHEN 1 THEN 'Windows11' "
                   "WHEN 2 THEN 'WindowsServer2019' WHEN 3 THEN 'Linux' ELSE 'macOS' END"),
    "lastSeen": "TIMESTAMP '2001-01-01 00:00:00' + make_dt_interval(0, CAST(c_custkey AS INT), 0, 0)",
    "lastIpAddress": ("'10.' || CAST((c_custkey DIV 65536) % 256 AS STRING) || '.' || "
                      "CAST((c_custkey DIV 256) % 256 AS STRING) || '.' || CAST(c_custkey % 256 AS STRING)"),
    "machineTags": "array(lower(c_mktsegment), 'nation-' || CAST(c_nationkey AS STRING))",
    "deviceValue": "'Normal'",
    "onboardingStatus": "'Onboarded'",
    "isExcluded": "false",
    "isPotentialDuplication": "false",
    "ipAddresses": ("array("
                    "named_struct('ipAddress', '10.' || CAST((c_custkey DIV 65536) % 256 AS STRING) || '.' || "
                    "CAST((c_custkey DIV 256) % 256 AS STRING) || '.' || CAST(c_custkey % 256 AS STRING), "
                    "'macAddress', CAST(NULL AS STRING), 'type', 'Ethernet', 'operationalStatus', 'Up'), "
                    "named_struct('ipAddress', 'fe80::' || CAST(c_custkey AS STRING), "
                    "'macAddress', CAST(NULL AS STRING), 'type', 'Ethernet', 'operationalStatus', 'Up'), "
                    "named_struct('ipAddress', '192.168.' || CAST(c_nationkey AS STRING) || '.1', "
                    "'macAddress', CAST(NULL AS STRING), 'type', 'Wireless', 'operationalStatus', 'Down'))"),
}


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """machine contract rows, one per customer."""
    c = table(spark, sf_dir, "customer")
    return conform(c.selectExpr(*[f"{e} AS `{k}`" for k, e in MACHINE_COLUMNS.items()]), "machine")


ALERT_COLUMNS = {
    "id": "CAST(o_orderkey AS STRING)",
    "machineId": "CAST(o_custkey AS STRING)",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'New' ELSE 'InProgress' END",
    "severity": ("CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN 'Medium' "
                 "WHEN '3-MEDIUM' THEN 'Low' WHEN '4-NOT SPECIFIED' THEN 'UnSpecified' ELSE 'Informational' END"),
    "alertCreationTime": "CAST(o_orderdate AS TIMESTAMP)",
    "title": "'alert ' || CAST(o_orderkey AS STRING)",
    "relatedUser": "named_struct('userName', 'user' || CAST(o_custkey % 29 AS STRING), 'domainName', 'CORP')",
    "loggedOnUsers": ("array(named_struct('accountName', 'user' || CAST(o_orderkey % 150 AS STRING), "
                      "'domainName', 'CORP'))"),
}

EVIDENCE_COLUMNS = {
    "alertId": "CAST(l_orderkey AS STRING)",
    "entityType": "'File'",
    "evidenceCreationTime": "CAST(l_shipdate AS TIMESTAMP)",
    "sha1": "CAST(l_partkey AS STRING)",
    "fileName": "'f' || CAST(l_linenumber AS STRING) || '.exe'",
    "ipAddress": "'172.16.' || CAST(l_suppkey DIV 256 AS STRING) || '.' || CAST(l_suppkey % 256 AS STRING)",
    "url": ("'https://h' || CAST(l_suppkey % 37 AS STRING) || '.example.com/p/' || CAST(l_partkey AS STRING) "
            "|| '?sig=' || CAST(l_orderkey AS STRING)"),
    "accountName": "'user' || CAST(l_suppkey % 29 AS STRING)",
    "domainName": "'CORP'",
}


def alerts(spark: SparkSession, sf_dir: str, *, with_evidence: bool = True) -> DataFrame:
    """alert contract rows, one per order; evidence nested from its line items.

    The nesting is a group on ``l_orderkey`` (bounded: a handful of lines per
    order) joined back on the same key, so the aggregate's hash partitioning
    is reused by the join and only ``orders`` is shuffled for it.
    """
    o = table(spark, sf_dir, "orders")
    if not with_evidence:
        return conform(o.selectExpr(*[f"{e} AS `{k}`" for k, e in ALERT_COLUMNS.items()]), "alert")
    li = table(spark, sf_dir, "lineitem")
    ev_fields = [F.expr(e).alias(k) for k, e in EVIDENCE_COLUMNS.items() if k != "alertId"]
    ev = (li.select(F.col("l_orderkey").alias("o_orderkey"), F.struct(*ev_fields).alias("e"))
            .groupBy("o_orderkey").agg(F.collect_list("e").alias("evidence")))
    joined = o.join(ev, "o_orderkey", "left")
    a = joined.selectExpr(*[f"{e} AS `{k}`" for k, e in ALERT_COLUMNS.items()], "evidence")
    return conform(a, "alert")


SOFTWARE_ROW_COLUMNS = {
    "deviceId": "CAST(o_custkey AS STRING)",
    "deviceName": "'Customer#' || CAST(o_custkey AS STRING)",
    "softwareVendor": "'vendor' || CAST(l_partkey % 25 AS STRING)",
    "softwareName": "'sw' || CAST(l_partkey AS STRING)",
    "softwareVersion": "l_returnflag || '.' || l_linestatus",
    "numberOfWeaknesses": "CAST(l_quantity AS INT) % 5",
}

VULN_ROW_COLUMNS = {
    **SOFTWARE_ROW_COLUMNS,
    "cveId": "'CVE-' || CAST(l_suppkey AS STRING)",
    "cvssScore": "l_discount * 100",
    "vulnerabilitySeverityLevel": "CASE WHEN l_discount >= 0.07 THEN 'High' WHEN l_discount >= 0.03 THEN 'Medium' ELSE 'Low' END",
    "recommendedSecurityUpdateId": "CASE WHEN l_linestatus = 'O' THEN 'KB' || CAST(5000000 + l_suppkey % 40 AS STRING) END",
    "recommendedSecurityUpdate": "CASE WHEN l_linestatus = 'O' THEN 'Update ' || CAST(5000000 + l_suppkey % 40 AS STRING) END",
    "recommendationReference": "'sca-' || CAST(l_partkey AS STRING)",
    "securityUpdateAvailable": "l_linestatus = 'O'",
    "lastSeenTimestamp": "CAST(l_shipdate AS STRING)",
}


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def asset_software(spark: SparkSession, sf_dir: str) -> DataFrame:
    """asset_software rows (device x software x version), one per line item."""
    df = _order_lines(spark, sf_dir).selectExpr(*[f"{e} AS `{k}`" for k, e in SOFTWARE_ROW_COLUMNS.items()])
    return conform(df, "asset_software")


def asset_vulnerabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """asset_vulnerability rows (device x software x version x CVE), one per line item."""
    df = _order_lines(spark, sf_dir).selectExpr(*[f"{e} AS `{k}`" for k, e in VULN_ROW_COLUMNS.items()])
    df = df.withColumn("id", F.concat_ws("-", "deviceId", "softwareName", "softwareVersion", "cveId"))
    return conform(df, "asset_vulnerability")


SOFTWARE_CATALOG_COLUMNS = {
    "id": "'vendor' || CAST(p_partkey % 25 AS STRING) || '-_-sw' || CAST(p_partkey AS STRING)",
    "name": "'sw' || CAST(p_partkey AS STRING)",
    "vendor": "'vendor' || CAST(p_partkey % 25 AS STRING)",
    "category": "p_type",
}


def software_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").selectExpr(*[f"{e} AS `{k}`" for k, e in SOFTWARE_CATALOG_COLUMNS.items()])
    return conform(df, "software")


FILE_CATALOG_COLUMNS = {
    "sha1": "CAST(p_partkey AS STRING)",
    "size": "CAST(p_size AS BIGINT) * 1024",
    "fileType": "p_type",
    "filePublisher": "p_brand",
    "globalPrevalence": "CAST(p_retailprice AS BIGINT)",
    "determinationType": "'Unknown'",
}


def file_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").selectExpr(*[f"{e} AS `{k}`" for k, e in FILE_CATALOG_COLUMNS.items()])
    return conform(df, "file")


VULN_CATALOG_COLUMNS = {
    "id": "'CVE-' || CAST(s_suppkey AS STRING)",
    "name": "s_name",
    "cvssV3": "s_acctbal / 1000",
    "severity": "CASE WHEN s_acctbal >= 7000 THEN 'High' WHEN s_acctbal >= 3000 THEN 'Medium' ELSE 'Low' END",
    "publishedOn": "TIMESTAMP '2020-01-01 00:00:00' + make_dt_interval(CAST(s_suppkey AS INT), 0, 0, 0)",
    "status": "'Active'",
}


def vulnerability_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "supplier").selectExpr(*[f"{e} AS `{k}`" for k, e in VULN_CATALOG_COLUMNS.items()])
    return conform(df, "vulnerability")


LOGON_COLUMNS = {
    "accountName": "'user' || CAST(user_id AS STRING)",
    "accountDomain": "'CORP'",
    "machineId": "CAST(CAST(floor(value) AS BIGINT) AS STRING)",
    "logonTime": "CAST(ts AS TIMESTAMP)",
    "logonType": "event_type",
    "eventId": "event_id",
}


def logons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logon bridge rows (account, machine, time), one per event."""
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} AS `{k}`" for k, e in LOGON_COLUMNS.items()])


DELTA_COLUMNS = {
    "id": "CAST(user_id AS STRING)",
    "deviceId": "CAST(user_id AS STRING)",
    "cveId": "'CVE-' || CAST(user_id % 100 AS STRING)",
    "status": ("CASE event_type WHEN 'signup' THEN 'New' WHEN 'purchase' THEN 'Fixed' "
               "WHEN 'error' THEN 'Fixed' ELSE 'Updated' END"),
    "eventTimestamp": "CAST(ts AS TIMESTAMP)",
    "cvssScore": "value",
    "eventId": "event_id",
}


def vulnerability_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """delta_asset_vulnerability rows, one per event (plus the event id as tie-break)."""
    df = table(spark, sf_dir, "events").selectExpr(*[f"{e} AS `{k}`" for k, e in DELTA_COLUMNS.items()])
    return conform(df, "delta_asset_vulnerability", keep=["eventId"])


def vulnerability_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot keyed like the delta feed: one open row per customer."""
    df = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS id", "CAST(c_custkey AS STRING) AS deviceId",
        "'CVE-' || CAST(c_custkey % 100 AS STRING) AS cveId", "'New' AS status",
        "TIMESTAMP '2023-12-31 00:00:00' AS eventTimestamp", "c_acctbal / 1000 AS cvssScore")
    return conform(df, "delta_asset_vulnerability")


RECOMMENDATION_COLUMNS = {
    "id": "'sca-' || CAST(p_partkey AS STRING)",
    "productName": "'sw' || CAST(p_partkey AS STRING)",
    "vendor": "'vendor' || CAST(p_partkey % 25 AS STRING)",
    "recommendationName": "'Update sw' || CAST(p_partkey AS STRING)",
    "severityScore": "p_retailprice / 100",
    "status": "CASE WHEN p_size > 25 THEN 'Active' ELSE 'Exception' END",
}


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recommendation catalog rows, one per part."""
    df = table(spark, sf_dir, "part").selectExpr(*[f"{e} AS `{k}`" for k, e in RECOMMENDATION_COLUMNS.items()])
    return conform(df, "recommendation")


BASELINE_COLUMNS = {
    "id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "profileId": "'profile-' || CAST(l_suppkey % 10 AS STRING)",
    "deviceId": "CAST(o_custkey AS STRING)",
    "configurationId": "'scid-' || CAST(l_partkey AS STRING)",
    "isApplicable": "l_linenumber <> 7",
    "isCompliant": "l_returnflag <> 'R'",
    "isExempt": "l_tax = 0",
}


def baseline_assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """asset_baseline_assessment rows (device x profile x setting), one per line item."""
    df = _order_lines(spark, sf_dir).selectExpr(*[f"{e} AS `{k}`" for k, e in BASELINE_COLUMNS.items()])
    return conform(df, "asset_baseline_assessment")


def scan_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """auth_scan_history rows, one per order; scanned targets nested from its line items."""
    li = table(spark, sf_dir, "lineitem")
    targets = li.select(
        F.expr("CAST(l_orderkey AS STRING)").alias("sessionId"),
        F.struct(F.lit("00:00:05").alias("scanDuration"),
                 F.expr("'10.1.' || CAST(l_suppkey DIV 256 AS STRING) || '.' || CAST(l_suppkey % 256 AS STRING)").alias("ip"),
                 F.expr("CASE l_returnflag WHEN 'N' THEN 'Success' WHEN 'A' THEN 'Failure' ELSE 'PartialSuccess' END").alias("scanStatus"),
                 ).alias("t")).groupBy("sessionId").agg(F.collect_list("t").alias("scannedTargets"))
    o = table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS STRING) AS sessionId",
                                                  "'def-' || CAST(o_custkey % 50 AS STRING) AS scanDefinitionId")
    return conform(o.join(targets, "sessionId", "left"), "auth_scan_history_contract")


SCORE_COLUMNS = {
    "time": "CAST(ts AS TIMESTAMP)",
    "score": "value",
    "rbacGroupId": "CAST(user_id AS BIGINT)",
    "rbacGroupName": "'group-' || CAST(user_id AS STRING)",
    "eventId": "event_id",
}


def exposure_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """configuration_score rows (time, group, score), one per event (+ event id tie-break)."""
    df = table(spark, sf_dir, "events").selectExpr(*[f"{e} AS `{k}`" for k, e in SCORE_COLUMNS.items()])
    return conform(df, "configuration_score", keep=["eventId"])


def indicator_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator change-set rows from page URLs (some deliberately invalid)."""
    p = table(spark, sf_dir, "pages")
    return p.selectExpr(
        "CAST(page_id AS STRING) AS requestId",
        "CASE WHEN page_id % 11 = 0 THEN '' ELSE url END AS indicatorValue",
        "CASE WHEN page_id % 13 = 0 THEN 'Host' ELSE 'Url' END AS indicatorType",
        "CASE page_id % 3 WHEN 0 THEN 'Block' WHEN 1 THEN 'Audit' ELSE 'Warn' END AS action",
        "CASE WHEN page_id % 17 = 0 THEN NULL ELSE 'page ' || CAST(page_id AS STRING) END AS title",
        "'Medium' AS severity")


def device_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """device_group rows from nations (name + tag rules), plus an unassigned group."""
    n = table(spark, sf_dir, "nation")
    cond = "struct<condition:string,value:string>"
    tag_conds = F.when(F.col("n_nationkey") < 5, F.array(
        F.struct(F.lit("Equals").alias("condition"), F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("value")),
        F.struct(F.lit("StartsWith").alias("condition"), F.lit("nation-1").alias("value")))).otherwise(F.array(
        F.struct(F.lit("Equals").alias("condition"), F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("value"))))
    rules = F.struct(
        F.array(F.struct(F.lit("StartsWith").alias("condition"), F.lit("Customer#").alias("value"))).alias("devicesNamesConditions"),
        F.lit(None).cast(f"array<{cond}>").alias("devicesDomainsConditions"),
        tag_conds.alias("devicesTagsConditions"),
        F.lit(None).cast("array<struct<condition:string,valuesList:array<string>>>").alias("devicesOsConditions"))
    g = n.select(F.col("n_nationkey").alias("id"), (F.col("n_regionkey") * 100 + F.col("n_nationkey")).alias("priority"),
                 F.col("n_name").alias("deviceGroupName"), F.lit(False).alias("isUnassignedDeviceGroup"),
                 rules.alias("deviceGroupRules"))
    spark_ = n.sparkSession
    unassigned = spark_.createDataFrame([(999, 100000, "Unassigned", True)],
                                        "id int, priority int, deviceGroupName string, isUnassignedDeviceGroup boolean")
    return conform(g.unionByName(unassigned, allowMissingColumns=True), "device_group")


def av_export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw antivirus-health export lines (JSON text), one per customer, in six shapes.

    Shapes cycle with the customer key: a string-encoded gathered-info blob with
    string-encoded scan results; without scan results; with unparseable scan
    results; an unparseable blob; an object blob with a preset scan field; no
    blob and a null top-level avMode.
    """
    c = table(spark, sf_dir, "customer")
    os_ = F.expr(MACHINE_COLUMNS["osPlatform"])
    mode = F.expr("CASE c_custkey % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Passive' ELSE 'SideBySidePassive' END")
    scans = F.to_json(F.struct(
        F.struct(F.lit("Completed").alias("ScanStatus"), F.lit(0).alias("ErrorCode"),
                 F.lit("2024-01-15T08:00:00Z").alias("Timestamp")).alias("Quick"),
        F.struct(F.lit("").alias("ScanStatus"), F.lit("0x80").alias("ErrorCode")).alias("Full")))
    up_to_date = F.col("c_acctbal") > 5000
    info0 = F.to_json(F.struct(mode.alias("AvMode"), F.concat(F.lit("1.2."), F.col("c_custkey").cast("string")).alias("AvSignatureVersion"),
                               up_to_date.alias("AvIsSignatureUptoDate"), scans.alias("AvScanResults")))
    info1 = F.to_json(F.struct(mode.alias("AvMode")))
    info2 = F.to_json(F.struct(mode.alias("AvMode"), F.lit("not json").alias("AvScanResults")))
    info4 = F.struct(mode.alias("AvMode"), F.lit("Preset").alias("quickScanResult"))
    base = [F.col("c_custkey").cast("string").alias("DeviceId"), F.col("c_name").alias("DeviceName"),
            os_.alias("OsPlatform"), F.col("c_nationkey").alias("RbacGroupId"),
            F.lit("2024-02-01T00:00:00Z").alias("Timestamp")]
    k = F.col("c_custkey") % 6
    line = (F.when(k == 0, F.to_json(F.struct(*base, info0.alias("DeviceGatheredInfo"))))
             .when(k == 1, F.to_json(F.struct(*base, info1.alias("DeviceGatheredInfo"))))
             .when(k == 2, F.to_json(F.struct(*base, info2.alias("DeviceGatheredInfo"))))
             .when(k == 3, F.to_json(F.struct(*base, F.lit("garbage").alias("DeviceGatheredInfo"))))
             .when(k == 4, F.to_json(F.struct(*base, info4.alias("DeviceGatheredInfo"))))
             .otherwise(F.to_json(F.struct(*base, F.lit(None).cast("string").alias("avMode")),
                                  {"ignoreNullFields": "false"})))
    return c.select(line.alias("value"))


def contract_schema(name: str):
    from ..plans.contracts import contract
    return contract(name)


REMEDIATION_COLUMNS = {
    "id": "'task-' || CAST(p_partkey AS STRING)",
    "title": "'Update sw' || CAST(p_partkey AS STRING)",
    "recommendationReference": "'sca-' || CAST(p_partkey AS STRING)",
    "status": "CASE p_size % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Completed' ELSE 'Active' END",
    "createdOn": "TIMESTAMP '2024-01-01 00:00:00'",
}


def remediation_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """remediation_task rows, one per part (each targets that part's recommendation)."""
    df = table(spark, sf_dir, "part").selectExpr(*[f"{e} AS `{k}`" for k, e in REMEDIATION_COLUMNS.items()])
    return conform(df, "remediation_task")


def alert_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create-alert-by-reference requests, one per event (some invalid by category / severity)."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS machineId",
        "CASE event_type WHEN 'purchase' THEN 'High' WHEN 'view' THEN 'Low' WHEN 'click' THEN 'Medium' "
        "WHEN 'error' THEN 'Severe' ELSE 'Informational' END AS severity",
        "'event ' || CAST(event_id AS STRING) AS title", "event_type AS description",
        "'investigate' AS recommendedAction",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS eventTime",
        "CAST(event_id AS STRING) AS reportId",
        "CASE WHEN event_type = 'signup' THEN 'UnknownCategory' ELSE 'Malware' END AS category")


def machine_wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine records as an export would carry them: numbers as text, ISO-8601 times
    with seven fractional digits and a Z, one unknown field."""
    m = machines(spark, sf_dir)
    return m.select(
        "id", "computerDnsName", "healthStatus", F.col("rbacGroupId").cast("string").alias("rbacGroupId"),
        F.date_format("lastSeen", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS'Z'").alias("lastSeen"),
        "machineTags", "ipAddresses", F.lit("x").alias("unknownVendorField"))
