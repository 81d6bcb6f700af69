"""DuckDB oracle SQL for the registered reports (same tables, same output names).

The stand-in views are written again here in DuckDB's dialect, independently
of the Spark code, so the oracle checks both the view mapping and the
operator. Timestamps are rendered as text, lists joined in a fixed order.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"
HOST_RE = r"'^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)'"

M = """m AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS computerDnsName, c_nationkey AS rbacGroupId,
    'group-' || CAST(c_nationkey AS VARCHAR) AS rbacGroupName,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Active' WHEN 'BUILDING' THEN 'Inactive'
      WHEN 'FURNITURE' THEN 'ImpairedCommunication' WHEN 'HOUSEHOLD' THEN 'NoSensorData' ELSE 'Unknown' END AS healthStatus,
    CASE WHEN c_acctbal < 0 THEN 'None' WHEN c_acctbal < 2000 THEN 'Informational' WHEN c_acctbal < 5000 THEN 'Low'
      WHEN c_acctbal < 8000 THEN 'Medium' ELSE 'High' END AS riskScore,
    CASE c_nationkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' ELSE 'High' END AS exposureLevel,
    CASE c_nationkey % 5 WHEN 0 THEN 'Windows10' WHEN 1 THEN 'Windows11' WHEN 2 THEN 'WindowsServer2019'
      WHEN 3 THEN 'Linux' ELSE 'macOS' END AS osPlatform,
    TIMESTAMP '2001-01-01 00:00:00' + to_hours(CAST(c_custkey AS BIGINT)) AS lastSeen,
    '10.' || CAST((c_custkey // 65536) % 256 AS VARCHAR) || '.' || CAST((c_custkey // 256) % 256 AS VARCHAR)
      || '.' || CAST(c_custkey % 256 AS VARCHAR) AS lastIpAddress,
    [lower(c_mktsegment), 'nation-' || CAST(c_nationkey AS VARCHAR)] AS machineTags,
    ['10.' || CAST((c_custkey // 65536) % 256 AS VARCHAR) || '.' || CAST((c_custkey // 256) % 256 AS VARCHAR)
      || '.' || CAST(c_custkey % 256 AS VARCHAR),
     'fe80::' || CAST(c_custkey AS VARCHAR),
     '192.168.' || CAST(c_nationkey AS VARCHAR) || '.1'] AS ips
  FROM customer)"""

A = """a AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS machineId,
    CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'New' ELSE 'InProgress' END AS status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN 'Medium' WHEN '3-MEDIUM' THEN 'Low'
      WHEN '4-NOT SPECIFIED' THEN 'UnSpecified' ELSE 'Informational' END AS severity,
    o_orderdate AS alertCreationTime,
    'user' || CAST(o_custkey % 29 AS VARCHAR) AS relatedUserName,
    'user' || CAST(o_orderkey % 150 AS VARCHAR) AS loggedOnUser
  FROM orders)"""

EV = f"""ev AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS alertId, CAST(o_custkey AS VARCHAR) AS machineId,
    l_shipdate AS evidenceCreationTime, CAST(l_partkey AS VARCHAR) AS sha1,
    'f' || CAST(l_linenumber AS VARCHAR) || '.exe' AS fileName,
    '172.16.' || CAST(l_suppkey // 256 AS VARCHAR) || '.' || CAST(l_suppkey % 256 AS VARCHAR) AS ipAddress,
    'https://h' || CAST(l_suppkey % 37 AS VARCHAR) || '.example.com/p/' || CAST(l_partkey AS VARCHAR)
      || '?sig=' || CAST(l_orderkey AS VARCHAR) AS url,
    'user' || CAST(l_suppkey % 29 AS VARCHAR) AS accountName
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
evh AS (SELECT *, nullif(lower(regexp_extract(url, {HOST_RE}, 1)), '') AS host FROM ev)"""

AV = """av AS (
  SELECT CAST(o_custkey AS VARCHAR) AS deviceId,
    'vendor' || CAST(l_partkey % 25 AS VARCHAR) AS softwareVendor, 'sw' || CAST(l_partkey AS VARCHAR) AS softwareName,
    l_returnflag || '.' || l_linestatus AS softwareVersion,
    CAST(trunc(l_quantity) AS INTEGER) % 5 AS numberOfWeaknesses,
    'CVE-' || CAST(l_suppkey AS VARCHAR) AS cveId, l_discount * 100 AS cvssScore,
    CASE WHEN l_linestatus = 'O' THEN 'KB' || CAST(5000000 + l_suppkey % 40 AS VARCHAR) END AS recommendedSecurityUpdateId,
    CASE WHEN l_linestatus = 'O' THEN 'Update ' || CAST(5000000 + l_suppkey % 40 AS VARCHAR) END AS recommendedSecurityUpdate,
    'sca-' || CAST(l_partkey AS VARCHAR) AS recommendationReference,
    l_linestatus = 'O' AS securityUpdateAvailable
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

VC = """vc AS (
  SELECT 'CVE-' || CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, s_acctbal / 1000 AS cvssV3,
    CASE WHEN s_acctbal >= 7000 THEN 'High' WHEN s_acctbal >= 3000 THEN 'Medium' ELSE 'Low' END AS severity
  FROM supplier)"""

LG = """lg AS (
  SELECT 'user' || CAST(user_id AS VARCHAR) AS accountName, 'CORP' AS accountDomain,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS machineId, ts AS logonTime, event_id AS eventId
  FROM events)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _prevalence(key: str) -> str:
    return f"""SELECT {key}, CAST(count(DISTINCT machineId) AS INTEGER) AS organizationPrevalence,
  strftime(min(evidenceCreationTime), {TS}) AS orgFirstSeen, strftime(max(evidenceCreationTime), {TS}) AS orgLastSeen
FROM evh WHERE {key} IS NOT NULL GROUP BY {key}"""


SQL: dict[str, str] = {
    "machines_filtered_top": w(M) + """SELECT id, computerDnsName, healthStatus, exposureLevel, rbacGroupId FROM m
WHERE healthStatus = 'Active' AND exposureLevel IN ('Low', 'High') ORDER BY id LIMIT 100""",

    "alerts_since_page": w(A) + f"""SELECT id, machineId, status, severity, strftime(alertCreationTime, {TS}) AS created
FROM a WHERE status IN ('New', 'InProgress') AND severity = 'High' AND alertCreationTime >= TIMESTAMP '1998-01-01 00:00:00'
ORDER BY alertCreationTime DESC, id LIMIT 50 OFFSET 20""",

    "machines_tag_prefix": w(M) + """SELECT id, list_contains(machineTags, 'household') AS isHousehold FROM m
WHERE EXISTS (SELECT 1 FROM unnest(machineTags) AS u(tag) WHERE starts_with(u.tag, 'nation-1'))""",

    "machines_distinct_ipv4": w(M) + """SELECT DISTINCT ip AS ipAddress FROM (SELECT unnest(ips) AS ip FROM m)
WHERE ip IS NOT NULL AND NOT contains(ip, ':')""",

    "machines_find_by_ip": w(M) + f"""SELECT id, lastIpAddress, strftime(lastSeen, {TS}) AS lastSeen FROM m
WHERE list_contains(ips, '192.168.7.1')
  AND lastSeen BETWEEN TIMESTAMP '2000-12-21 00:00:00' AND TIMESTAMP '2001-02-19 00:00:00'""",

    "page_url_redaction": f"""SELECT page_id,
  CASE WHEN url IS NULL OR contains(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1), '[')
         <> contains(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1), ']')
       THEN '[redacted-url]' ELSE regexp_replace(url, '[?#].*$', '') END AS url,
  nullif(lower(regexp_extract(url, {HOST_RE}, 1)), '') AS host
FROM pages""",

    "alert_ips": w(EV) + "SELECT DISTINCT alertId, ipAddress FROM ev WHERE ipAddress IS NOT NULL",

    "alert_machines": w(M, A) + """SELECT a.id AS alertId, m.id AS machineId, m.computerDnsName, m.healthStatus
FROM a JOIN m ON a.machineId = m.id""",

    "machine_vulnerabilities": w(AV, VC) + """SELECT DISTINCT av.deviceId AS machineId, vc.id, vc.name, vc.cvssV3, vc.severity
FROM av JOIN vc ON av.cveId = vc.id""",

    "machine_missing_kbs": w(AV) + """, kb AS (
  SELECT recommendedSecurityUpdateId AS id, count(DISTINCT deviceId) AS machineMissedOn, count(DISTINCT cveId) AS cveAddressed
  FROM av WHERE recommendedSecurityUpdateId IS NOT NULL GROUP BY 1)
SELECT DISTINCT av.deviceId AS machineId, kb.id, kb.machineMissedOn, kb.cveAddressed
FROM av JOIN kb ON av.recommendedSecurityUpdateId = kb.id""",

    "domain_machines": w(M, A, EV) + """SELECT DISTINCT evh.host, m.id AS machineId
FROM evh JOIN a ON evh.alertId = a.id JOIN m ON a.machineId = m.id WHERE evh.host IS NOT NULL""",

    "vulnerability_machines": w(M, AV) + """SELECT DISTINCT av.cveId, m.id AS machineId, m.computerDnsName
FROM av JOIN m ON av.deviceId = m.id""",

    "software_machines": w(M, AV) + """SELECT DISTINCT av.softwareVendor || '-_-' || av.softwareName AS softwareId, m.id AS machineId,
  CAST(m.rbacGroupId AS BIGINT) AS rbacGroupId
FROM av JOIN m ON av.deviceId = m.id""",

    "file_alerts": w(A, EV) + """SELECT DISTINCT ev.sha1 AS hash, a.id AS alertId, a.severity
FROM ev JOIN a ON ev.alertId = a.id WHERE ev.sha1 IS NOT NULL""",

    "domain_prevalence": w(EV) + f"""SELECT host, CAST(organizationPrevalence AS VARCHAR) AS orgPrevalence, organizationPrevalence,
  orgFirstSeen, orgLastSeen FROM ({_prevalence('host')})""",

    "file_prevalence": w(EV) + f""", p AS ({_prevalence('sha1')}),
names AS (SELECT sha1, fileName, count(*) AS n FROM ev WHERE fileName IS NOT NULL GROUP BY 1, 2),
r AS (SELECT sha1, fileName, row_number() OVER (PARTITION BY sha1 ORDER BY n DESC, fileName) AS rk FROM names),
t AS (SELECT sha1, string_agg(fileName, ',' ORDER BY rk) AS topFileNames FROM r WHERE rk <= 3 GROUP BY sha1)
SELECT p.sha1, p.organizationPrevalence, p.orgFirstSeen, p.orgLastSeen, t.topFileNames,
  CAST(CAST(trunc(part.p_retailprice) AS BIGINT) AS VARCHAR) AS globalPrevalence
FROM p LEFT JOIN t ON p.sha1 = t.sha1 LEFT JOIN part ON CAST(part.p_partkey AS VARCHAR) = p.sha1""",

    "ip_prevalence": w(EV) + f"SELECT * FROM ({_prevalence('ipAddress')})",

    "software_versions": w(AV) + """SELECT softwareVendor || '-_-' || softwareName AS softwareId, softwareVersion AS version,
  count(DISTINCT deviceId) AS installations, CAST(max(numberOfWeaknesses) AS BIGINT) AS vulnerabilities
FROM av GROUP BY 1, 2""",

    "cve_exposure": w(AV) + "SELECT cveId AS id, count(DISTINCT deviceId) AS exposedMachines FROM av GROUP BY 1",

    "missing_kb_rollup": w(AV) + """SELECT recommendedSecurityUpdateId AS id, min(recommendedSecurityUpdate) AS name,
  string_agg(DISTINCT softwareName, ',' ORDER BY softwareName) AS productsNames,
  count(DISTINCT deviceId) AS machineMissedOn, count(DISTINCT cveId) AS cveAddressed
FROM av WHERE recommendedSecurityUpdateId IS NOT NULL GROUP BY 1""",

    "user_footprint": w(LG) + f""", pm AS (
  SELECT accountName, accountDomain, machineId, count(*) AS n, min(logonTime) AS f, max(logonTime) AS l
  FROM lg WHERE machineId IS NOT NULL GROUP BY 1, 2, 3)
SELECT accountDomain || '\\' || accountName AS id, accountName,
  strftime(min(f), {TS}) AS firstSeen, strftime(max(l), {TS}) AS lastSeen, count(*) AS logOnMachinesCount,
  (list(machineId ORDER BY n DESC, machineId))[1] AS mostPrevalentMachineId,
  (list(machineId ORDER BY n, machineId))[1] AS leastPrevalentMachineId
FROM pm GROUP BY accountName, accountDomain""",
}


from .plans.domains import DOMAINS  # noqa: E402


def _in_list(domain: str) -> str:
    return "(" + ", ".join("'" + v + "'" for v in DOMAINS[domain]) + ")"


SC = """sc AS (
  SELECT 'vendor' || CAST(p_partkey % 25 AS VARCHAR) || '-_-sw' || CAST(p_partkey AS VARCHAR) AS id,
    'sw' || CAST(p_partkey AS VARCHAR) AS name, 'vendor' || CAST(p_partkey % 25 AS VARCHAR) AS vendor, p_type AS category
  FROM part)"""

RC = """rc AS (
  SELECT 'sca-' || CAST(p_partkey AS VARCHAR) AS id, 'sw' || CAST(p_partkey AS VARCHAR) AS productName,
    'vendor' || CAST(p_partkey % 25 AS VARCHAR) AS vendor,
    CASE WHEN p_size > 25 THEN 'Active' ELSE 'Exception' END AS status
  FROM part)"""

USERS = f"""pm AS (
  SELECT accountName, accountDomain, machineId, count(*) AS n, min(logonTime) AS f, max(logonTime) AS l
  FROM lg WHERE machineId IS NOT NULL GROUP BY 1, 2, 3),
users AS (
  SELECT accountName, accountDomain, accountDomain || '\\' || accountName AS id, count(*) AS logOnMachinesCount,
    max(l) AS lastSeen
  FROM pm GROUP BY 1, 2)"""

KB = """kb AS (
  SELECT recommendedSecurityUpdateId AS id, count(DISTINCT deviceId) AS machineMissedOn, count(DISTINCT cveId) AS cveAddressed
  FROM av WHERE recommendedSecurityUpdateId IS NOT NULL GROUP BY 1)"""

REQUESTS = """SELECT CAST(user_id AS VARCHAR) AS machineId,
    CASE event_type WHEN 'purchase' THEN 'High' WHEN 'view' THEN 'Low' WHEN 'click' THEN 'Medium'
      WHEN 'error' THEN 'Severe' ELSE 'Informational' END AS severity,
    CAST(event_id AS VARCHAR) AS reportId, ts, event_type FROM events"""

DELTA = """d AS (
  SELECT CAST(user_id AS VARCHAR) AS id, 'CVE-' || CAST(user_id % 100 AS VARCHAR) AS cveId,
    CASE event_type WHEN 'signup' THEN 'New' WHEN 'purchase' THEN 'Fixed' WHEN 'error' THEN 'Fixed' ELSE 'Updated' END AS status,
    ts AS eventTimestamp, value AS cvssScore, event_id AS eventId
  FROM events)"""

APPLY = w(DELTA) + f""", latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY eventTimestamp DESC, eventId DESC) AS rn FROM d)
  WHERE rn = 1),
snap AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, 'CVE-' || CAST(c_custkey % 100 AS VARCHAR) AS cveId, 'New' AS status,
    TIMESTAMP '2023-12-31 00:00:00' AS eventTimestamp, c_acctbal / 1000 AS cvssScore
  FROM customer),
ch AS (SELECT latest.* FROM latest LEFT JOIN snap ON latest.id = snap.id
       WHERE snap.id IS NULL OR latest.eventTimestamp >= snap.eventTimestamp)
SELECT id, cveId, status, strftime(eventTimestamp, {TS}) AS eventTimestamp, cvssScore
FROM snap WHERE id NOT IN (SELECT id FROM ch)
UNION ALL
SELECT id, cveId, status, strftime(eventTimestamp, {TS}) AS eventTimestamp, cvssScore FROM ch WHERE status <> 'Fixed'"""

SUBMISSIONS = """s AS (
  SELECT CASE WHEN page_id % 11 = 0 THEN '' ELSE url END AS indicatorValue,
    CASE WHEN page_id % 13 = 0 THEN 'Host' ELSE 'Url' END AS indicatorType,
    CASE page_id % 3 WHEN 0 THEN 'Block' WHEN 1 THEN 'Audit' ELSE 'Warn' END AS action,
    CASE WHEN page_id % 17 = 0 THEN NULL ELSE 'page ' || CAST(page_id AS VARCHAR) END AS title,
    'Medium' AS severity
  FROM pages)"""

AVX = """x AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_custkey % 6 AS k,
    CASE c_nationkey % 5 WHEN 0 THEN 'Windows10' WHEN 1 THEN 'Windows11' WHEN 2 THEN 'WindowsServer2019'
      WHEN 3 THEN 'Linux' ELSE 'macOS' END AS os,
    CASE c_custkey % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Passive' ELSE 'SideBySidePassive' END AS mode
  FROM customer),
y AS (SELECT *, starts_with(lower(os), 'macos') OR starts_with(lower(os), 'linux') AS nonwin FROM x)"""

SQL.update({
    "machine_logon_users": w(LG) + ", " + USERS + """,
lb AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS machineId, 'user' || CAST(o_orderkey % 150 AS VARCHAR) AS accountName,
         'CORP' AS accountDomain FROM orders)
SELECT lb.machineId, users.id AS userId, users.logOnMachinesCount
FROM lb JOIN users ON lb.accountName = users.accountName AND lb.accountDomain = users.accountDomain""",

    "machine_software": w(AV, SC) + """SELECT DISTINCT av.deviceId AS machineId, sc.id, sc.name, sc.vendor, sc.category
FROM av JOIN sc ON av.softwareVendor = sc.vendor AND av.softwareName = sc.name""",

    "machine_recommendations": w(AV, RC) + """SELECT DISTINCT av.deviceId AS machineId, rc.id, rc.productName, rc.status
FROM av JOIN rc ON av.recommendationReference = rc.id""",

    "alert_domains": w(EV) + "SELECT DISTINCT alertId, host FROM evh WHERE host IS NOT NULL",

    "alert_files": w(EV) + """SELECT DISTINCT ev.alertId, ev.sha1, p.p_type AS fileType, CAST(p.p_size AS BIGINT) * 1024 AS size
FROM ev LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = ev.sha1 WHERE ev.sha1 IS NOT NULL""",

    "alert_user": w(A, LG) + ", " + USERS + f"""
SELECT a.id AS alertId, users.id AS userId, strftime(users.lastSeen, {TS}) AS lastSeen
FROM a JOIN users ON a.relatedUserName = users.accountName AND users.accountDomain = 'CORP'""",

    "domain_alerts": w(A, EV) + """SELECT DISTINCT evh.host, a.id AS alertId, a.status
FROM evh JOIN a ON evh.alertId = a.id WHERE evh.host IS NOT NULL""",

    "ip_alerts": w(EV) + "SELECT DISTINCT ipAddress, alertId FROM ev WHERE ipAddress IS NOT NULL",

    "user_alerts": w(A, EV) + """SELECT DISTINCT accountName, alertId FROM (
  SELECT relatedUserName AS accountName, id AS alertId FROM a
  UNION ALL SELECT accountName, alertId FROM ev) WHERE accountName IS NOT NULL""",

    "user_machines": w(M, LG) + """SELECT DISTINCT lg.accountName, m.id AS machineId, m.healthStatus
FROM lg JOIN m ON lg.machineId = m.id""",

    "software_vulnerabilities": w(AV, VC) + """SELECT DISTINCT av.softwareVendor || '-_-' || av.softwareName AS softwareId, vc.id, vc.severity
FROM av JOIN vc ON av.cveId = vc.id""",

    "software_missing_kbs": w(AV) + ", " + KB + """
SELECT DISTINCT av.softwareVendor || '-_-' || av.softwareName AS softwareId, kb.id, kb.machineMissedOn, kb.cveAddressed
FROM av JOIN kb ON av.recommendedSecurityUpdateId = kb.id""",

    "recommendation_software": w(RC, SC) + """SELECT rc.id AS recommendationId, sc.id, sc.name, sc.vendor
FROM rc JOIN sc ON rc.productName = sc.name AND rc.vendor = sc.vendor""",

    "recommendation_machines": w(M, AV) + """SELECT DISTINCT av.recommendationReference AS recommendationId, m.id AS machineId,
  CAST(m.rbacGroupId AS BIGINT) AS rbacGroupId
FROM av JOIN m ON av.deviceId = m.id""",

    "recommendation_vulnerabilities": w(AV, VC) + """SELECT DISTINCT av.recommendationReference AS recommendationId, vc.id, vc.name
FROM av JOIN vc ON av.cveId = vc.id""",

    "software_rollup": w(AV) + """, ver AS (
  SELECT softwareVendor || '-_-' || softwareName AS id, softwareVersion AS version, count(DISTINCT deviceId) AS inst,
    max(numberOfWeaknesses) AS vul
  FROM av GROUP BY 1, 2),
dist AS (SELECT id, string_agg(version || ':' || CAST(inst AS VARCHAR) || ':' || CAST(vul AS VARCHAR), ','
           ORDER BY version, inst, vul) AS distributions FROM ver GROUP BY id),
agg AS (SELECT softwareVendor || '-_-' || softwareName AS id, count(DISTINCT deviceId) AS installedMachines,
          count(DISTINCT deviceId) AS exposedMachines, count(DISTINCT cveId) AS weaknesses FROM av GROUP BY 1)
SELECT agg.id, agg.installedMachines, agg.exposedMachines, agg.weaknesses, dist.distributions
FROM agg JOIN dist ON agg.id = dist.id""",

    "recommendation_rollup": w(AV) + """SELECT recommendationReference AS id, count(DISTINCT cveId) AS weaknesses,
  count(DISTINCT CASE WHEN cveId IS NOT NULL THEN deviceId END) AS exposedMachinesCount,
  count(DISTINCT deviceId) AS totalMachineCount
FROM av WHERE recommendationReference IS NOT NULL GROUP BY 1""",

    "baseline_profile_rollup": """WITH b AS (
  SELECT 'profile-' || CAST(l_suppkey % 10 AS VARCHAR) AS profileId, CAST(o_custkey AS VARCHAR) AS deviceId,
    l_linenumber <> 7 AS isApplicable, l_returnflag <> 'R' AS isCompliant, l_tax = 0 AS isExempt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
pd AS (
  SELECT profileId, deviceId,
    coalesce(bool_and(CASE WHEN isApplicable AND NOT coalesce(isExempt, false) THEN coalesce(isCompliant, false) END), true) AS passed
  FROM b GROUP BY 1, 2)
SELECT profileId AS id, count(*) FILTER (WHERE passed) AS passedDevices, count(*) AS totalDevices FROM pd GROUP BY 1""",

    "scan_success": """SELECT CAST(o_orderkey AS VARCHAR) AS sessionId, 'def-' || CAST(o_custkey % 50 AS VARCHAR) AS scanDefinitionId,
  CAST(count(l_orderkey) AS INTEGER) AS numberOfTargets,
  CAST(count(l_orderkey) FILTER (WHERE l_returnflag = 'N') AS INTEGER) AS numberOfSuccessfullyScannedTargets
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey""",

    "latest_score_per_group": f"""SELECT rbacGroupId, strftime(time, {TS}) AS time, score FROM (
  SELECT CAST(user_id AS BIGINT) AS rbacGroupId, ts AS time, value AS score,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",

    "vulnerability_changes_since": w(DELTA) + f"""SELECT id, status, strftime(eventTimestamp, {TS}) AS eventTimestamp, eventId
FROM d WHERE eventTimestamp >= TIMESTAMP '2024-01-20 00:00:00' AND status IN ('New', 'Fixed')""",

    "vulnerability_snapshot_apply": APPLY,
    "vulnerability_changes_stream": APPLY,

    "change_counts_daily": w(DELTA) + f"""SELECT strftime(date_trunc('day', eventTimestamp), {TS}) AS windowStart,
  strftime(date_trunc('day', eventTimestamp) + INTERVAL 1 DAY, {TS}) AS windowEnd, status, count(*) AS changes
FROM d GROUP BY 1, 2, 3""",

    "change_counts_stream": w(DELTA) + f"""SELECT strftime(date_trunc('day', eventTimestamp), {TS}) AS windowStart,
  strftime(date_trunc('day', eventTimestamp) + INTERVAL 1 DAY, {TS}) AS windowEnd, status, count(*) AS changes
FROM d WHERE date_trunc('day', eventTimestamp) + INTERVAL 1 DAY <= (SELECT max(eventTimestamp) - INTERVAL 1 HOUR FROM d)
GROUP BY 1, 2, 3""",

    "machine_contract_nulls": """SELECT * FROM (VALUES ('id'), ('isPotentialDuplication'), ('isExcluded'), ('healthStatus'),
  ('deviceValue'), ('rbacGroupId'), ('exposureLevel'), ('onboardingStatus')) AS t("column")
  CROSS JOIN (SELECT CAST(0 AS BIGINT) AS violations)
UNION ALL SELECT 'managedBy', count(*) FROM customer
UNION ALL SELECT 'managedByStatus', count(*) FROM customer
UNION ALL SELECT 'vmMetadata.cloudProvider', CAST(0 AS BIGINT)""",

    "document_domain_check": """SELECT 'lang' AS "column",
  count(*) FILTER (WHERE lang IS NOT NULL AND lang NOT IN ('en', 'de', 'fr', 'es')) AS violations FROM documents
UNION ALL SELECT 'source', count(*) FILTER (WHERE source IS NOT NULL AND source NOT IN
  ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9')) FROM documents""",

    "label_reconcile": """WITH r AS (SELECT doc_id, CAST(n_chars > 2000 AS INTEGER) AS quality, 0 AS toxic FROM documents),
j AS (
  SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, l.doc_id IS NOT NULL AS hl, r.doc_id IS NOT NULL AS hr,
    l.quality AS lq, r.quality AS rq, l.toxic AS lt, r.toxic AS rt
  FROM labels l FULL OUTER JOIN r ON l.doc_id = r.doc_id)
SELECT doc_id, '_row' AS "column", CASE WHEN hl THEN 'present' ELSE 'absent' END AS "left",
  CASE WHEN hr THEN 'present' ELSE 'absent' END AS "right" FROM j WHERE NOT (hl AND hr)
UNION ALL SELECT doc_id, 'quality', CAST(lq AS VARCHAR), CAST(rq AS VARCHAR) FROM j WHERE hl AND hr AND lq IS DISTINCT FROM rq
UNION ALL SELECT doc_id, 'toxic', CAST(lt AS VARCHAR), CAST(rt AS VARCHAR) FROM j WHERE hl AND hr AND lt IS DISTINCT FROM rt""",

    "alerts_batch_patch": w(A) + """SELECT id,
  CASE WHEN severity = 'High' AND status = 'New' THEN 'InProgress' ELSE status END AS status,
  CASE WHEN severity = 'High' AND status = 'New' THEN 'soc@corp' END AS assignedTo,
  CASE WHEN severity = 'High' AND status = 'New' THEN 1 ELSE 0 END AS comments
FROM a""",

    "indicator_import_results": w(SUBMISSIONS) + f""", e AS (
  SELECT *, concat_ws('; ',
    CASE WHEN indicatorValue IS NULL THEN 'indicatorValue is required' END,
    CASE WHEN indicatorType IS NULL THEN 'indicatorType is required' END,
    CASE WHEN action IS NULL THEN 'action is required' END,
    CASE WHEN indicatorValue IS NOT NULL AND length(indicatorValue) < 1 THEN 'indicatorValue must have at least 1 character(s)' END,
    CASE WHEN indicatorType IS NOT NULL AND indicatorType NOT IN {_in_list('TI_INDICATOR_TYPE')}
      THEN 'indicatorType must be one of TI_INDICATOR_TYPE' END,
    CASE WHEN action IS NOT NULL AND action NOT IN {_in_list('TI_INDICATOR_ACTION')} THEN 'action must be one of TI_INDICATOR_ACTION' END,
    CASE WHEN severity IS NOT NULL AND severity NOT IN {_in_list('SEVERITY')} THEN 'severity must be one of SEVERITY' END,
    CASE WHEN title IS NULL THEN 'title is required' END) AS reasons
  FROM s)
SELECT CASE WHEN reasons = '' THEN sha256(indicatorType || '|' || indicatorValue) END AS id, indicatorValue AS indicator,
  reasons <> '' AS isFailed, nullif(reasons, '') AS failureReason
FROM e""",

    "alert_delete_outcome": """WITH ids AS (SELECT DISTINCT CAST(event_id * 2 AS VARCHAR) AS id FROM events),
o AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders)
SELECT ids.id, o.id IS NOT NULL AS found FROM ids LEFT JOIN o ON ids.id = o.id""",

    "machine_tag_update": w(M) + """, t AS (
  SELECT id, lower(split_part(machineTags[1], ',', 1)) AS tag, healthStatus FROM m
  UNION ALL SELECT id, machineTags[2], healthStatus FROM m
  UNION ALL SELECT id, 'reviewed', healthStatus FROM m WHERE riskScore = 'High')
SELECT id, string_agg(DISTINCT tag, ',' ORDER BY tag) AS machineTags FROM t
WHERE NOT (healthStatus = 'NoSensorData' AND tag = 'household') GROUP BY id""",

    "device_group_assignment": """SELECT CAST(c_custkey AS VARCHAR) AS id,
  (list(n_nationkey ORDER BY n_regionkey * 100 + n_nationkey, n_nationkey))[1] AS deviceGroupId
FROM customer JOIN nation ON starts_with(lower(c_name), 'customer#') AND (
  c_nationkey = n_nationkey OR (n_nationkey < 5 AND starts_with('nation-' || CAST(c_nationkey AS VARCHAR), 'nation-1')))
GROUP BY c_custkey""",

    "hunting_query": w(M, A) + """SELECT a.severity, count(*) AS alerts, count(DISTINCT a.machineId) AS machines
FROM a JOIN m ON a.machineId = m.id
WHERE a.status = 'New' AND m.healthStatus <> 'Inactive'
GROUP BY a.severity""",

    "av_health_flatten": w(AVX) + """SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS machineId, c_name AS computerDnsName,
  CASE WHEN starts_with(lower(os), 'windows') THEN 'windows' WHEN starts_with(lower(os), 'linux') THEN 'linux'
       WHEN starts_with(lower(os), 'macos') THEN 'mac' END AS osKind,
  CASE WHEN k IN (0, 1, 2, 4) THEN mode END AS avMode,
  CASE WHEN k = 0 THEN 'Completed' WHEN k = 4 THEN 'Preset' WHEN k IN (1, 3, 5) AND nonwin THEN '-' END AS quickScanResult,
  CASE WHEN k = 0 THEN (CASE WHEN nonwin THEN '-' ELSE '' END) WHEN k IN (1, 3, 4, 5) AND nonwin THEN '-' END AS quickScanError,
  CASE WHEN k = 0 THEN '2024-01-15 08:00:00' END AS quickScanTime,
  CASE WHEN k = 0 THEN (CASE WHEN nonwin THEN '-' ELSE '' END) WHEN k IN (1, 3, 4, 5) AND nonwin THEN '-' END AS fullScanResult,
  CASE WHEN k = 0 THEN '0x80' WHEN k IN (1, 3, 4, 5) AND nonwin THEN '-' END AS fullScanError,
  CASE WHEN k = 0 THEN (CASE WHEN c_acctbal > 5000 THEN 'True' ELSE 'False' END) END AS avIsSignatureUpToDate,
  CAST(c_nationkey AS BIGINT) AS rbacGroupId, '2024-02-01 00:00:00' AS dataRefreshTimestamp
FROM y""",
})


TASKS = """t AS (
  SELECT DISTINCT 'task-' || CAST(p_partkey AS VARCHAR) AS taskId, av.recommendationReference AS rec, m.id AS machineId
  FROM part JOIN av ON av.recommendationReference = 'sca-' || CAST(p_partkey AS VARCHAR)
  JOIN m ON av.deviceId = m.id)"""

SQL.update({
    "machine_alerts": w(M, A) + """SELECT a.machineId, a.id, a.severity FROM a JOIN m ON a.machineId = m.id
WHERE m.healthStatus = 'Active'""",

    "file_machines": w(M, A, EV) + """SELECT DISTINCT ev.sha1 AS hash, m.id AS machineId, m.computerDnsName
FROM ev JOIN a ON ev.alertId = a.id JOIN m ON a.machineId = m.id WHERE ev.sha1 IS NOT NULL""",

    "remediation_machines": w(M, AV, TASKS) + "SELECT taskId, machineId FROM t",

    "remediation_progress": w(M, AV, TASKS) + """, still AS (
  SELECT DISTINCT recommendationReference AS rec, deviceId AS machineId FROM av WHERE securityUpdateAvailable)
SELECT t.taskId AS id, count(*) AS targetDevices, count(*) FILTER (WHERE still.machineId IS NULL) AS fixedDevices
FROM t LEFT JOIN still ON t.rec = still.rec AND t.machineId = still.machineId GROUP BY t.taskId""",

    "alert_create": f"""WITH r AS (
  SELECT CAST(user_id AS VARCHAR) AS machineId,
    CASE event_type WHEN 'purchase' THEN 'High' WHEN 'view' THEN 'Low' WHEN 'click' THEN 'Medium'
      WHEN 'error' THEN 'Severe' ELSE 'Informational' END AS severity,
    CAST(event_id AS VARCHAR) AS reportId, ts, event_type
  FROM events)
SELECT 'ref_' || reportId || '_' || r.machineId AS id, r.machineId, c.c_name AS computerDnsName, severity, 'New' AS status,
  strftime(ts, {TS}) AS created
FROM r JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = r.machineId
WHERE severity IN {_in_list('ALERT_SEVERITY')} AND event_type <> 'signup'""",

    "alert_create_table": w(A) + f""", r AS ({REQUESTS})
SELECT id, machineId, severity, status FROM a
UNION ALL SELECT 'ref_' || reportId || '_' || machineId, machineId, severity, 'New' FROM r
JOIN customer ON CAST(c_custkey AS VARCHAR) = machineId WHERE severity IN {_in_list('ALERT_SEVERITY')} AND event_type <> 'signup'""",

    "alert_create_rejected": f"""WITH r AS ({REQUESTS})
SELECT reportId, machineId, concat_ws('; ',
  CASE WHEN severity NOT IN {_in_list('ALERT_SEVERITY')} THEN 'severity must be one of ALERT_SEVERITY' END,
  CASE WHEN event_type = 'signup' THEN 'category must be one of IOA_CATEGORY; category cannot be Unknown' END,
  CASE WHEN c_custkey IS NULL THEN 'machineId is not a known machine' END) AS errors
FROM r LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = machineId
WHERE severity NOT IN {_in_list('ALERT_SEVERITY')} OR event_type = 'signup' OR c_custkey IS NULL""",

    "alert_delete_remaining": w(A) + """SELECT id, machineId, status FROM a
WHERE id NOT IN (SELECT CAST(event_id * 2 AS VARCHAR) FROM events)""",

    "indicator_upsert": """WITH ex AS (SELECT url AS indicatorValue, 'Url' AS indicatorType, 'Audit' AS action FROM pages),
ch AS (SELECT url AS indicatorValue, 'Url' AS indicatorType, 'Block' AS action, page_id FROM pages WHERE contains(url, '?')),
chl AS (SELECT indicatorValue, indicatorType, action FROM (
  SELECT *, row_number() OVER (PARTITION BY indicatorType, indicatorValue ORDER BY page_id DESC) AS rn FROM ch) WHERE rn = 1)
SELECT indicatorValue, indicatorType, action FROM ex
WHERE NOT EXISTS (SELECT 1 FROM chl WHERE chl.indicatorValue = ex.indicatorValue AND chl.indicatorType = ex.indicatorType)
UNION ALL SELECT indicatorValue, indicatorType, action FROM chl""",

    "machine_value_update": w(M) + """SELECT id, CASE WHEN riskScore = 'High' THEN 'High' ELSE 'Normal' END AS deviceValue,
  riskScore = 'High' AS isExcluded, CASE WHEN riskScore = 'High' THEN 'Other' END AS exclusionReason FROM m""",

    "export_roundtrip": w(M) + f"""SELECT id, healthStatus, rbacGroupId, strftime(lastSeen, {TS}) AS lastSeen, 3 AS interfaces,
  array_to_string(machineTags, ',') AS machineTags FROM m""",

    "page_roundtrip": w(A) + f"""SELECT id, machineId, status, severity, strftime(alertCreationTime, {TS}) AS created FROM a""",
})
SQL["av_export_files"] = SQL["av_health_flatten"]

SQL.update({
    "machine_wire_coercion_loss": """SELECT "column", violations FROM (VALUES ('id', 0), ('computerDnsName', 0),
  ('healthStatus', 0), ('lastSeen', 0)) AS t("column", v0) CROSS JOIN (SELECT CAST(0 AS BIGINT) AS violations)
UNION ALL SELECT 'rbacGroupId', count(*) FILTER (WHERE c_acctbal < 0) FROM customer""",

    "event_write_batches": """SELECT count(*) AS rows, true AS withinLimit, true AS enoughBatches FROM events""",
})

SQL.update({
    "alerts_created_at": w(A) + "SELECT id, machineId, severity FROM a WHERE alertCreationTime = TIMESTAMP '1998-01-01 00:00:00'",

    "machine_by_id": w(M) + "SELECT id, computerDnsName, riskScore FROM m WHERE id = '42'",

    "machines_by_event_ids": w(M) + "SELECT id, riskScore FROM m WHERE id IN (SELECT CAST(user_id AS VARCHAR) FROM events)",

    "changes_since_day": w(DELTA) + "SELECT id, status, eventId FROM d WHERE eventTimestamp >= TIMESTAMP '2024-01-15 00:00:00'",

    "vulnerabilities_filtered": w(VC) + "SELECT id, name, severity FROM vc WHERE severity IN ('High', 'Medium')",

    "software_filtered": w(SC) + "SELECT id, name, vendor FROM sc WHERE vendor = 'vendor3'",

    "recommendations_filtered": w(RC) + "SELECT id, vendor, productName FROM rc WHERE vendor IN ('vendor1', 'vendor2')",

    "indicators_filtered": w(SUBMISSIONS) + """SELECT indicatorValue, action, title FROM s
WHERE indicatorType = 'Url' AND action IN ('Block', 'Warn')""",
})

SQL.update({
    "event_write_batches_full": "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 500 AS batchId FROM events",

    "device_group_patterns": """WITH g AS (
  SELECT p_partkey AS gid, p_partkey % 7 AS priority, p_partkey % 3 AS test,
    CASE WHEN p_partkey % 3 = 2 THEN 'customer#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') ELSE CAST(p_partkey AS VARCHAR) END AS value FROM part),
hits AS (
  SELECT c_custkey, gid, priority FROM customer JOIN g ON CASE test WHEN 0 THEN ends_with(lower(c_name), value) WHEN 1 THEN contains(lower(c_name), value)
    ELSE starts_with(lower(c_name), value) END)
SELECT CAST(c_custkey AS VARCHAR) AS id, CAST((SELECT first(gid ORDER BY priority, gid) FROM hits h WHERE h.c_custkey = c.c_custkey) AS INTEGER) AS deviceGroupId
FROM customer c""",

    "scan_definition_update": """WITH c AS (
  SELECT CAST(user_id % 150 AS VARCHAR) AS id, event_id AS n, event_type AS e FROM events WHERE event_type <> 'error'),
l AS (
  SELECT id, max(n) FILTER (e = 'click') AS named, max(n) FILTER (e = 'view') AS timed, max(n) FILTER (e = 'purchase') AS linux, max(n) FILTER (e = 'signup') AS windows
  FROM c GROUP BY id),
d AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name, s_suppkey, true AS there FROM supplier),
j AS (
  SELECT coalesce(d.id, l.id) AS id, d.s_name, d.s_suppkey, coalesce(there, false) AS there, named, timed, linux, windows,
    linux IS NOT NULL AND (windows IS NULL OR linux > windows) AS is_linux FROM d FULL OUTER JOIN l ON d.id = l.id)
SELECT id, CASE WHEN named IS NOT NULL THEN 'scan ' || CAST(named AS VARCHAR) ELSE s_name END AS scanName, CAST(timed % 24 AS INTEGER) AS intervalInHours,
  CASE WHEN is_linux THEN 'PrivateKey' WHEN windows IS NOT NULL THEN 'Kerberos' WHEN there THEN 'Ntlm' END AS type,
  CASE WHEN is_linux THEN 'p' || CAST(linux AS VARCHAR) WHEN linux IS NULL AND there THEN 'user' || CAST(s_suppkey AS VARCHAR) END AS username,
  CASE WHEN is_linux THEN NULL WHEN windows IS NOT NULL THEN 'd' || CAST(windows AS VARCHAR) WHEN there THEN 'CORP' END AS domain,
  CASE WHEN is_linux THEN 'k' END AS privateKey FROM j""",

    "scan_definition_rejected": """SELECT event_id, CAST(user_id % 150 AS VARCHAR) AS id, 'field not allowed for type PrivateKey: domain' AS errors
FROM events WHERE event_type = 'error'""",

    "indicator_rows_serialized": """SELECT 'u' || CAST(event_id AS VARCHAR) AS indicatorValue, 'Block' AS action, true AS generateAlert
FROM events WHERE event_type NOT IN ('error', 'signup', 'purchase', 'view')""",

    "indicator_rows_rejected": """SELECT event_id, CASE event_type WHEN 'error' THEN 'not JSON' WHEN 'signup' THEN 'not a JSON object' WHEN 'purchase' THEN 'no text'
  ELSE 'a value does not fit its type' END AS reason FROM events WHERE event_type IN ('error', 'signup', 'purchase', 'view')""",

    "device_group_add": """SELECT n_nationkey AS id, n_name AS deviceGroupName FROM nation UNION ALL SELECT 999, 'Unassigned' UNION ALL
SELECT CAST(user_id % 40 AS INTEGER), 'g' || CAST(max(event_id) AS VARCHAR) FROM events
WHERE user_id % 40 NOT IN (SELECT n_nationkey FROM nation) AND user_id % 40 <> 999 GROUP BY 1""",

    "hunting_results_inferred": """SELECT c_custkey AS id, c_name AS DeviceName, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey * 10 AS VARCHAR) ELSE 'n/a' END AS score,
  c_nationkey AS nation FROM customer WHERE c_nationkey <> 7""",

    "export_mixed_codecs": w(M) + "SELECT id, healthStatus, rbacGroupId FROM m",

    "export_stream_ingest": w(M) + """SELECT 'row' AS kind, id, healthStatus FROM m UNION ALL
SELECT 'bad', '{"id": "cut' || CAST(n_nationkey AS VARCHAR), NULL FROM nation""",

    "software_reread": w(SC) + "SELECT id, name, vendor FROM sc",
    "vulnerabilities_reread": w(VC) + "SELECT id, name, severity FROM vc",
    "recommendations_reread": w(RC) + "SELECT id, productName, vendor, status FROM rc",
    "software_inventory_reread": w(AV) + "SELECT deviceId, softwareVendor, softwareName, softwareVersion, numberOfWeaknesses FROM av",
    "vulnerability_inventory_reread": w(AV) + "SELECT deviceId, cveId, softwareName, recommendedSecurityUpdateId FROM av",
    "vulnerability_changes_reread": w(DELTA) + f"SELECT id, cveId, status, strftime(eventTimestamp, {TS}) AS eventTimestamp FROM d",
})

SQL.update({
    "scan_history_coverage": """WITH e AS (SELECT event_type AS t, event_type = 'error' AND event_id % 10 = 0 AS bad FROM events),
g AS (SELECT t FROM e WHERE NOT bad),
v AS (
  SELECT '$' AS path, 'malformed' AS kind, count(*) AS records, 'object' AS expected, 'malformed' AS status FROM e WHERE bad
  UNION ALL SELECT '$', 'object', count(*), 'object', 'ok' FROM g
  UNION ALL SELECT '$.orgId', 'text', count(*), 'text', 'ok' FROM g
  UNION ALL SELECT '$.sessionId', 'text', count(*) FILTER (t <> 'signup'), 'text', 'ok' FROM g
  UNION ALL SELECT '$.sessionId', 'integer', count(*) FILTER (t = 'signup'), 'text', 'type' FROM g
  UNION ALL SELECT '$.numberOfTargets', 'integer', count(*) FILTER (t <> 'error'), 'integer', 'ok' FROM g
  UNION ALL SELECT '$.numberOfTargets', 'absent', count(*) FILTER (t = 'error'), 'integer', 'absent' FROM g
  UNION ALL SELECT '$.vendorNote', 'object', count(*) FILTER (t = 'purchase'), NULL, 'extra' FROM g
  UNION ALL SELECT '$.scannedTargets', 'array', count(*), 'array', 'ok' FROM g
  UNION ALL SELECT '$.scannedTargets[]', 'object', count(*) FILTER (t <> 'view'), 'object', 'ok' FROM g
  UNION ALL SELECT '$.scannedTargets[].ip', 'text', count(*) FILTER (t <> 'view'), 'text', 'ok' FROM g
  UNION ALL SELECT '$.scannedTargets[].scanStatus', 'text', count(*) FILTER (t <> 'view'), 'text', 'ok' FROM g
  UNION ALL SELECT '$.scannedTargets[].hostname', 'integer', count(*) FILTER (t = 'click'), 'text', 'type' FROM g
  UNION ALL SELECT '$.scannedTargets[].hostname', 'text', count(*) FILTER (t NOT IN ('click', 'view')), 'text', 'ok' FROM g)
SELECT * FROM v WHERE records > 0
UNION ALL SELECT '$.' || f, 'absent', n, CASE WHEN f LIKE 'number%' THEN 'integer' ELSE 'text' END, 'missing' FROM (SELECT count(*) AS n FROM g),
  unnest(['scanDefinitionId', 'scannerId', 'numberOfSuccessfullyScannedTargets', 'scanStatus', 'generalErrorMessage']) AS u(f)
UNION ALL SELECT '$.scannedTargets[].' || f, 'absent', n, 'text', 'missing' FROM (SELECT count(*) FILTER (t <> 'view') AS n FROM g),
  unnest(['scanDuration', 'scannedDeviceDescription', 'errorMessage']) AS u(f)""",

    "domain_prevalence_sketched": w(EV) + """SELECT host, count(DISTINCT machineId) AS machines,
  count(DISTINCT machineId) FILTER (year(evidenceCreationTime) = 1995) AS machines1995, true AS withinError FROM evh WHERE host IS NOT NULL GROUP BY 1""",

    "cve_exposure_sketched": w(AV) + "SELECT cveId AS id, count(DISTINCT deviceId) AS exposedMachines, true AS withinError FROM av GROUP BY 1",
})


SQL.update({
    "vulnerability_changes_log": APPLY,

    "alerts_after_skip": w(A) + f"""SELECT id, severity, strftime(alertCreationTime, {TS}) AS alertCreationTime FROM a
ORDER BY date_trunc('day', a.alertCreationTime) DESC, severity, id OFFSET 12000""",

    "recommendations_after_skip": w(RC) + "SELECT id, status FROM rc ORDER BY status, id OFFSET 100",
})
