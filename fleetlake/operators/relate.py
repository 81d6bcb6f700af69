"""Related-entity navigation (J1-J26), set-wise.

The upstream asks the service for ``/{entity}/{id}/{related}`` one id at a
time. Here every navigation takes a *set* of keys -- a DataFrame, a Python
list, one id, or ``None`` for "all" -- and returns ``key`` + the related
contract's columns, so a single job answers the question for a whole fleet.

Plan shape:

* key sets are applied first as semi joins (broadcast only when the key frame
  is proven small), so later joins see only the relevant rows;
* bulk fact rows (inventories, evidence) are reduced to distinct
  (key, related-id) pairs *before* the join -- a two-phase hash aggregate
  that pre-aggregates hot keys map-side;
* the related catalog is broadcast when its size is proven under
  ``BROADCAST_MAX_BYTES`` (estimated); otherwise a sort-merge join that AQE can
  split when a key is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import url_host
from ..plans.joins import bounded_broadcast, key_frame, semi_join, spread
from .conform import conform

SOFTWARE_ID_SEPARATOR = "-_-"  # fixed value: upstream software id = vendor-_-name


# ---------------------------------------------------------------- bridges --

def evidence_bridge(alerts: DataFrame) -> DataFrame:
    """EV: one row per (alert, evidence item); alerts without evidence kept once."""
    return (alerts.select(F.col("id").alias("alertId"), "machineId",
                          F.explode_outer("evidence").alias("e"))
                  .select("alertId", "machineId", "e.*"))


def logon_bridge(alerts: DataFrame) -> DataFrame:
    """Logged-on users per machine from the alerts' ``loggedOnUsers`` arrays."""
    return (alerts.select("machineId", F.col("alertCreationTime").alias("logonTime"),
                          F.explode("loggedOnUsers").alias("u"))
                  .select(F.col("u.accountName").alias("accountName"),
                          F.col("u.domainName").alias("accountDomain"), "machineId", "logonTime"))


def software_id(vendor, name):
    return F.concat_ws(SOFTWARE_ID_SEPARATOR, vendor, name)


def _restrict(df: DataFrame, column: str, keys) -> DataFrame:
    """Apply a key set to ``df[column]``; None = all rows."""
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        return semi_join(df, keys.select(F.col(keys.columns[0]).alias(column)), column)
    vals = [keys] if isinstance(keys, (str, int)) else list(keys)
    return semi_join(df, key_frame(df.sparkSession, vals, column), column)


def _catalog(df: DataFrame) -> DataFrame:
    return bounded_broadcast(df)


# --------------------------------------------------------- machine → X ----

def machine_alerts(alerts: DataFrame, machine_ids=None) -> DataFrame:
    """Alerts raised on the given machines (key = machineId)."""
    return _restrict(alerts, "machineId", machine_ids)


def machine_logon_users(alerts: DataFrame, users: DataFrame, machine_ids=None) -> DataFrame:
    """Users seen logged on to the machines, joined to the user table."""
    lb = _restrict(logon_bridge(alerts), "machineId", machine_ids)
    pairs = lb.select("machineId", "accountName", "accountDomain").distinct()
    return pairs.join(users, ["accountName", "accountDomain"], "inner")


def machine_software(inventory: DataFrame, catalog: DataFrame, machine_ids=None) -> DataFrame:
    """Software installed on the machines (inventory x catalog on vendor+name)."""
    inv = _restrict(inventory, "deviceId", machine_ids)
    pairs = inv.select(F.col("deviceId").alias("machineId"), F.col("softwareVendor").alias("vendor"),
                       F.col("softwareName").alias("name")).distinct()
    return pairs.join(_catalog(catalog), ["vendor", "name"], "inner").select("machineId", *catalog.columns)


def machine_vulnerabilities(vuln_inventory: DataFrame, cve_catalog: DataFrame, machine_ids=None) -> DataFrame:
    """CVEs exposed on the machines, one row per (machine, CVE)."""
    inv = _restrict(vuln_inventory, "deviceId", machine_ids)
    pairs = inv.select(F.col("deviceId").alias("machineId"), F.col("cveId").alias("id")).distinct()
    out = pairs.join(_catalog(cve_catalog), "id", "inner")
    return conform(out, "public_vulnerability_dto", keep=["machineId"])


def machine_recommendations(vuln_inventory: DataFrame, recommendations: DataFrame, machine_ids=None) -> DataFrame:
    """Recommendations that apply to the machines."""
    inv = _restrict(vuln_inventory, "deviceId", machine_ids)
    pairs = (inv.select(F.col("deviceId").alias("machineId"), F.col("recommendationReference").alias("id"))
                .dropna().distinct())
    return pairs.join(_catalog(recommendations), "id", "inner")


def missing_kb_rollup(vuln_inventory: DataFrame) -> DataFrame:
    """Per security update, the machines missing it and the CVEs it fixes.

    Two plain hash aggregates joined on the update id: exact distinct counts
    (two-phase, hot updates pre-aggregated map-side) and the distinct
    affected software names, de-duplicated *before* they are gathered into
    ``productsNames`` (so the list is built from at most one row per name).
    """
    rows = vuln_inventory.filter(F.col("recommendedSecurityUpdateId").isNotNull()).select(
        F.col("recommendedSecurityUpdateId").alias("id"), "recommendedSecurityUpdate", "recommendedSecurityUpdateUrl",
        "deviceId", "cveId", "softwareName")
    counts = rows.groupBy("id").agg(F.count_distinct("deviceId").alias("machineMissedOn"),
                                    F.count_distinct("cveId").alias("cveAddressed"))
    # name / url are per-update attributes: de-duplicate first, then pick one (no string buffers on the big side)
    labels = (rows.select("id", "recommendedSecurityUpdate", "recommendedSecurityUpdateUrl").distinct()
                  .groupBy("id").agg(F.max("recommendedSecurityUpdate").alias("name"),
                                     F.max("recommendedSecurityUpdateUrl").alias("url")))
    names = (rows.select("id", "softwareName").dropna().distinct()
                 .groupBy("id").agg(F.array_sort(F.collect_list("softwareName")).alias("productsNames")))
    return conform(counts.join(labels, "id", "left").join(names, "id", "left"), "public_product_fix_dto")


def machine_missing_kbs(vuln_inventory: DataFrame, machine_ids=None) -> DataFrame:
    """Security updates each machine is missing, with fleet-wide figures."""
    inv = _restrict(vuln_inventory, "deviceId", machine_ids)
    pairs = (inv.filter(F.col("recommendedSecurityUpdateId").isNotNull())
                .select(F.col("deviceId").alias("machineId"), F.col("recommendedSecurityUpdateId").alias("id"))
                .distinct())
    return pairs.join(missing_kb_rollup(vuln_inventory), "id", "inner").select("machineId", *conform_cols("public_product_fix_dto"))


def conform_cols(name: str) -> list[str]:
    from ..plans.contracts import contract
    return contract(name).fieldNames()


# ----------------------------------------------------------- alert → X ----

def alert_domains(alerts: DataFrame, alert_ids=None) -> DataFrame:
    """Hosts per alert: the nested ``domains`` plus hosts of evidence URLs."""
    return _host_pairs(_restrict(alerts, "id", alert_ids)).select("alertId", "host").distinct()


def _values_of(alerts: DataFrame, name: str, *lists) -> DataFrame:
    """(alertId, machineId, name): each distinct non-null value of the alerts' lists, in one pass."""
    none = F.array().cast("array<string>")
    every = F.array_distinct(F.concat(*[F.coalesce(x, none) for x in lists]))
    return alerts.select(F.col("id").alias("alertId"), "machineId", F.explode(every).alias(name)).where(F.col(name).isNotNull())


def _host_pairs(alerts: DataFrame) -> DataFrame:
    return _values_of(alerts, "host", F.col("domains.host"), F.transform("evidence", lambda e: url_host(e.getField("url"))))


def alert_files(alerts: DataFrame, files: DataFrame, alert_ids=None) -> DataFrame:
    """File evidence per alert; hashes unknown to the file table are kept."""
    ev = evidence_bridge(_restrict(alerts, "id", alert_ids))
    pairs = ev.filter(F.col("sha1").isNotNull()).select("alertId", "sha1").distinct()
    out = pairs.join(_catalog(files), "sha1", "left")
    return conform(out, "file", keep=["alertId"])


def alert_ips(alerts: DataFrame, alert_ids=None) -> DataFrame:
    """Distinct evidence IP addresses per alert."""
    ev = evidence_bridge(_restrict(alerts, "id", alert_ids))
    return ev.select("alertId", "ipAddress").dropna().distinct()


def alert_machines(alerts: DataFrame, machines: DataFrame, alert_ids=None) -> DataFrame:
    """The machine each alert was raised on (key = alertId)."""
    a = _restrict(alerts, "id", alert_ids).select(F.col("id").alias("alertId"), F.col("machineId").alias("id"))
    return a.join(machines, "id", "inner").select("alertId", *machines.columns)


def alert_user(alerts: DataFrame, users: DataFrame, alert_ids=None) -> DataFrame:
    """The related user of each alert, matched on account name + domain."""
    a = _restrict(alerts, "id", alert_ids).select(
        F.col("id").alias("alertId"), F.col("relatedUser.userName").alias("accountName"),
        F.col("relatedUser.domainName").alias("accountDomain")).dropna()
    return a.join(users, ["accountName", "accountDomain"], "inner")


# ------------------------------------------------------- inverse lookups ----

def _alerts_by_id(alerts: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    return pairs.select(key, F.col("alertId").alias("id")).distinct().join(alerts, "id", "inner")


def domain_alerts(alerts: DataFrame, hosts=None) -> DataFrame:
    """Alerts that touch the hosts (inverse of J7)."""
    pairs = _restrict(alert_domains(alerts), "host", hosts)
    return _alerts_by_id(alerts, pairs, "host")


def _machines_of(pairs: DataFrame, key: str, machines: DataFrame) -> DataFrame:
    p = pairs.select(key, F.col("machineId").alias("id")).distinct()
    return p.join(machines, "id", "inner").select(key, *machines.columns)


def domain_machines(alerts: DataFrame, machines: DataFrame, hosts=None) -> DataFrame:
    """Machines with alerts touching the hosts (J12 then J10), distinct."""
    return _machines_of(_restrict(_host_pairs(alerts), "host", hosts), "host", machines)


def file_alerts(alerts: DataFrame, hashes=None) -> DataFrame:
    """Alerts with file evidence matching the hashes (SHA-1 or SHA-256)."""
    return _alerts_by_id(alerts, _restrict(_hash_pairs(alerts), "hash", hashes), "hash")


def _hash_pairs(alerts: DataFrame) -> DataFrame:
    return _values_of(alerts, "hash", F.col("evidence.sha1"), F.col("evidence.sha256"))


def file_machines(alerts: DataFrame, machines: DataFrame, hashes=None) -> DataFrame:
    """Machines with alerts on the files (J14 then J10), distinct."""
    return _machines_of(_restrict(_hash_pairs(alerts), "hash", hashes), "hash", machines)


def ip_alerts(alerts: DataFrame, ips=None) -> DataFrame:
    """Alerts with the IPs in their evidence (inverse of J9)."""
    pairs = _restrict(alert_ips(alerts), "ipAddress", ips)
    return _alerts_by_id(alerts, pairs, "ipAddress")


def user_alerts(alerts: DataFrame, accounts=None) -> DataFrame:
    """Alerts whose related user or any evidence account is the account."""
    named = _values_of(alerts, "accountName", F.array("relatedUser.userName"), F.col("evidence.accountName"))
    return _alerts_by_id(alerts, _restrict(named, "accountName", accounts), "accountName")


def user_machines(logons: DataFrame, machines: DataFrame, accounts=None) -> DataFrame:
    """Machines the accounts logged on to (inverse of J1), distinct."""
    lb = _restrict(logons, "accountName", accounts)
    return _machines_of(lb, "accountName", machines)


def _assets(pairs: DataFrame, key: str, machines: DataFrame) -> DataFrame:
    m = machines.select("id", "computerDnsName", "osPlatform", F.col("machineTags").alias("tags"),
                        "rbacGroupName", F.col("rbacGroupId").cast("bigint").alias("rbacGroupId"))
    p = spread(pairs.select(key, F.col("machineId").alias("id")).where("id is not null"), key, "id").distinct()
    return conform(p.join(m, "id", "inner"), "public_asset_dto", keep=[key])


def software_machines(inventory: DataFrame, machines: DataFrame, software_ids=None) -> DataFrame:
    """Machines with the software installed (public_asset_dto rows)."""
    inv = inventory.select(software_id(F.col("softwareVendor"), F.col("softwareName")).alias("softwareId"),
                           F.col("deviceId").alias("machineId"))
    return _assets(_restrict(inv, "softwareId", software_ids), "softwareId", machines)


def software_vulnerabilities(vuln_inventory: DataFrame, cve_catalog: DataFrame, software_ids=None) -> DataFrame:
    """CVEs found in the software anywhere in the fleet."""
    inv = vuln_inventory.select(software_id(F.col("softwareVendor"), F.col("softwareName")).alias("softwareId"),
                                F.col("cveId").alias("id"))
    pairs = _restrict(inv, "softwareId", software_ids).distinct()
    out = pairs.join(_catalog(cve_catalog), "id", "inner")
    return conform(out, "public_vulnerability_dto", keep=["softwareId"])


def software_missing_kbs(vuln_inventory: DataFrame, software_ids=None) -> DataFrame:
    """Security updates that fix the software, with fleet-wide figures."""
    inv = vuln_inventory.filter(F.col("recommendedSecurityUpdateId").isNotNull()).select(
        software_id(F.col("softwareVendor"), F.col("softwareName")).alias("softwareId"),
        F.col("recommendedSecurityUpdateId").alias("id"))
    pairs = _restrict(inv, "softwareId", software_ids).distinct()
    return pairs.join(missing_kb_rollup(vuln_inventory), "id", "inner")


def vulnerability_machines(vuln_inventory: DataFrame, machines: DataFrame, cve_ids=None) -> DataFrame:
    """Machines exposed to the CVEs, distinct."""
    inv = vuln_inventory.select("cveId", F.col("deviceId").alias("machineId"))
    return _machines_of(_restrict(inv, "cveId", cve_ids), "cveId", machines)


def recommendation_software(recommendations: DataFrame, catalog: DataFrame, rec_ids=None) -> DataFrame:
    """Catalog software a recommendation is about (product name + vendor)."""
    r = _restrict(recommendations, "id", rec_ids).select(
        F.col("id").alias("recommendationId"), F.col("productName").alias("name"), "vendor")
    out = r.join(_catalog(catalog), ["name", "vendor"], "inner")
    return conform(out, "public_product_dto", keep=["recommendationId"])


def recommendation_machines(vuln_inventory: DataFrame, machines: DataFrame, rec_ids=None) -> DataFrame:
    """Machines a recommendation applies to (inverse of J5)."""
    inv = vuln_inventory.select(F.col("recommendationReference").alias("recommendationId"),
                                F.col("deviceId").alias("machineId"))
    return _assets(_restrict(inv, "recommendationId", rec_ids), "recommendationId", machines)


def recommendation_vulnerabilities(vuln_inventory: DataFrame, cve_catalog: DataFrame, rec_ids=None) -> DataFrame:
    """CVEs a recommendation addresses."""
    inv = vuln_inventory.select(F.col("recommendationReference").alias("recommendationId"), F.col("cveId").alias("id"))
    pairs = _restrict(inv, "recommendationId", rec_ids).distinct()
    out = pairs.join(_catalog(cve_catalog), "id", "inner")
    return conform(out, "public_vulnerability_dto", keep=["recommendationId"])


def remediation_machines(tasks: DataFrame, vuln_inventory: DataFrame, machines: DataFrame, task_ids=None) -> DataFrame:
    """Machines targeted by remediation tasks (task -> recommendation -> J24)."""
    t = _restrict(tasks, "id", task_ids).select(F.col("id").alias("taskId"),
                                                F.col("recommendationReference").alias("recommendationId"))
    wanted = None if task_ids is None else t.select("recommendationId").dropna().distinct()
    assets = recommendation_machines(vuln_inventory, machines, wanted)
    return t.join(assets, "recommendationId", "inner")
