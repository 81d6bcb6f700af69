"""Prevalence, exposure and rollup aggregations.

The service hands these figures back pre-computed; here they are recomputed
from the rows. Every aggregate is partial-aggregation friendly (count,
min/max, distinct counts via the two-phase Expand plan, ``bool_and``, and
argmax/argmin through ``min``/``max`` of a struct), so a hot key -- one
machine, CVE or host holding a third of all rows -- is pre-aggregated
map-side and never lands whole in one task. Per-group lists are only ever
built from already-bounded inputs (top-k rows, per-version rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import spread
from .conform import conform
from .relate import evidence_bridge, software_id


def _prevalence(rows: DataFrame, key: str, machine: str, ts: str) -> DataFrame:
    return rows.groupBy(key).agg(
        F.count_distinct(machine).cast("int").alias("organizationPrevalence"),
        F.min(ts).alias("orgFirstSeen"),
        F.max(ts).alias("orgLastSeen"),
    ).withColumn("orgPrevalence", F.col("organizationPrevalence").cast("string"))


def domain_stats(host_rows: DataFrame, *, machine: str = "machineId", ts: str = "evidenceCreationTime") -> DataFrame:
    """G1: per host, distinct machines and first / last sighting."""
    return conform(_prevalence(host_rows.filter(F.col("host").isNotNull()), "host", machine, ts), "in_org_domain_stats")


def ip_stats(ip_rows: DataFrame, *, machine: str = "machineId", ts: str = "evidenceCreationTime") -> DataFrame:
    """Per IP address, distinct machines and first / last sighting."""
    p = _prevalence(ip_rows.filter(F.col("ipAddress").isNotNull()), "ipAddress", machine, ts)
    return conform(p, "in_org_ip_stats")


def top_values(rows: DataFrame, key: str, value: str, k: int, *, out: str = "topValues") -> DataFrame:
    """Top-``k`` most frequent ``value`` per ``key`` (ties: smaller value first).

    count per (key, value) -> ``row_number() <= k``; Spark plans the rank
    filter with a WindowGroupLimit before the shuffle, so each partition ships
    at most k rows per key. The final list holds at most k entries.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy(F.col("_n").desc(), F.col(value).asc())
    ranked = counts.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k)
    return ranked.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rk", value))), lambda s: s.getField(value)).alias(out))


def file_stats(file_rows: DataFrame, files: DataFrame | None = None, *, k: int = 3,
               machine: str = "machineId", ts: str = "evidenceCreationTime") -> DataFrame:
    """Per SHA-1, org prevalence, first / last seen and the top-k file names.

    One partial aggregate per (sha1, machine, name) feeds both outputs -- the
    per-file figures (distinct machines as a count of (sha1, machine) groups)
    and the name counts for the top-k. That reduced table is written once as
    parquet under the session's checkpoint folder, so the evidence is read
    and shuffled once; both outputs then read the written table. Global columns
    come from the file table when given (left join), else null.
    """
    from ..session import materialize

    base = materialize(file_rows.filter(F.col("sha1").isNotNull())
                                .groupBy("sha1", machine, "fileName")
                                .agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")),
                       "file-stats")
    per_machine = base.groupBy("sha1", machine).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    prev = per_machine.groupBy("sha1").agg(
        F.count(F.lit(1)).cast("int").alias("organizationPrevalence"),
        F.min("_first").alias("orgFirstSeen"), F.max("_last").alias("orgLastSeen"),
    ).withColumn("orgPrevalence", F.col("organizationPrevalence").cast("string"))
    name_counts = base.filter(F.col("fileName").isNotNull()).groupBy("sha1", "fileName").agg(F.sum("_n").alias("_n"))
    w = Window.partitionBy("sha1").orderBy(F.col("_n").desc(), F.col("fileName").asc())
    ranked = name_counts.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k)
    names = ranked.groupBy("sha1").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rk", "fileName"))), lambda x: x.getField("fileName"))
        .alias("topFileNames"))
    out = prev.join(names, "sha1", "left")
    if files is not None:
        g = files.select("sha1", F.col("globalPrevalence").cast("int").alias("globallyPrevalence"),
                         F.col("globalPrevalence").cast("string").alias("globalPrevalence"),
                         "globalFirstObserved", "globalLastObserved")
        out = out.join(g, "sha1", "left")
    return conform(out, "in_org_file_stats")


def evidence_rows(alerts: DataFrame) -> DataFrame:
    """Evidence bridge with the host of each URL, input for G1-G3."""
    from ..functions.scalars import url_host
    return evidence_bridge(alerts).withColumn("host", url_host("url"))


def version_distribution(inventory: DataFrame) -> DataFrame:
    """Per (software, version): installing machines, max weaknesses."""
    return (inventory.groupBy(software_id(F.col("softwareVendor"), F.col("softwareName")).alias("softwareId"),
                              F.col("softwareVersion").alias("version"))
                     .agg(F.count_distinct("deviceId").alias("installations"),
                          F.max("numberOfWeaknesses").cast("bigint").alias("vulnerabilities")))


def software_rollup(inventory: DataFrame, vuln_inventory: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Per software: weaknesses, installed / exposed machines, distributions.

    Three hash aggregates joined on the software id: installed machines
    (two-phase distinct count per vendor + name), exposure from the
    vulnerability inventory, and the per-version distribution (G4). Strings
    are grouping keys, never aggregation buffers.
    """
    installed = (inventory.groupBy(F.col("softwareVendor").alias("vendor"), F.col("softwareName").alias("name"))
                          .agg(F.count_distinct("deviceId").alias("installedMachines"))
                          .select(software_id(F.col("vendor"), F.col("name")).alias("id"), "vendor", "name",
                                  "installedMachines"))
    exposed = vuln_inventory.groupBy(software_id(F.col("softwareVendor"), F.col("softwareName")).alias("id")).agg(
        F.count_distinct("cveId").alias("weaknesses"), F.count_distinct("deviceId").alias("exposedMachines"))
    dist = (version_distribution(inventory)
            .groupBy(F.col("softwareId").alias("id"))
            .agg(F.array_sort(F.collect_list(F.struct("version", "installations", "vulnerabilities"))).alias("distributions")))
    out = (installed.join(exposed, "id", "left").join(dist, "id", "left")
                    .fillna(0, subset=["weaknesses", "exposedMachines"]))
    if catalog is not None:
        out = out.join(catalog.select("id", "category", "isNormalized"), "id", "left")
    return conform(out, "software")


def cve_rollup(vuln_inventory: DataFrame) -> DataFrame:
    """Per CVE, the number of distinct exposed machines."""
    return vuln_inventory.groupBy(F.col("cveId").alias("id")).agg(
        F.count_distinct("deviceId").alias("exposedMachines"))


def recommendation_rollup(vuln_inventory: DataFrame) -> DataFrame:
    """Per recommendation: weaknesses, exposed and total machine counts."""
    return vuln_inventory.filter(F.col("recommendationReference").isNotNull()).groupBy(
        F.col("recommendationReference").alias("id")).agg(
        F.count_distinct("cveId").alias("weaknesses"),
        F.count_distinct(F.when(F.col("cveId").isNotNull(), F.col("deviceId"))).alias("exposedMachinesCount"),
        F.count_distinct("deviceId").alias("totalMachineCount"))


def baseline_profile_rollup(assessments: DataFrame) -> DataFrame:
    """Per profile, devices passing every applicable, non-exempt setting.

    Per (profile, device): ``bool_and(isCompliant)`` over applicable and not
    exempt settings (a device with none applicable counts, and passes); then
    per profile: passed / total devices.
    """
    scoped = F.col("isApplicable") & ~F.coalesce(F.col("isExempt"), F.lit(False))
    per_device = assessments.groupBy("profileId", "deviceId").agg(
        F.coalesce(F.bool_and(F.when(scoped, F.coalesce(F.col("isCompliant"), F.lit(False)))), F.lit(True)).alias("passed"))
    return per_device.groupBy(F.col("profileId").alias("id")).agg(
        F.count_if("passed").alias("passedDevices"), F.count(F.lit(1)).alias("totalDevices"))


def scan_success(history: DataFrame, *, success: str = "Success") -> DataFrame:
    """Per scan session, targets scanned and targets scanned successfully."""
    return history.withColumn("numberOfTargets", F.size(F.coalesce("scannedTargets", F.array()))) \
                  .withColumn("numberOfSuccessfullyScannedTargets",
                              F.size(F.filter(F.coalesce("scannedTargets", F.array()),
                                              lambda t: t.getField("scanStatus") == F.lit(success))))


def latest_score_per_group(scores: DataFrame, *, group: str = "rbacGroupId", time: str = "time",
                           tiebreak: list[str] | None = None) -> DataFrame:
    """The most recent score row per group (ties broken by ``tiebreak``)."""
    others = [c for c in scores.columns if c not in (group, time, *(tiebreak or []))]
    best = F.max(F.struct(F.col(time), *[F.col(t) for t in (tiebreak or [])], *[F.col(c) for c in others]))
    return scores.groupBy(group).agg(best.alias("_b")).select(group, "_b.*")


def user_footprint(logons: DataFrame, *, account: str = "accountName", domain: str = "accountDomain",
                   machine: str = "machineId", ts: str = "logonTime") -> DataFrame:
    """Per account: first / last seen, machine count, most / least used machine.

    Logons are first counted per (account, machine); most used = highest
    count, least used = lowest count, ties to the smaller machine id. Logons
    without a machine are ignored.
    """
    per_machine = logons.filter(F.col(machine).isNotNull()).groupBy(account, domain, machine).agg(
        F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    out = per_machine.groupBy(account, domain).agg(
        F.min("_first").alias("firstSeen"), F.max("_last").alias("lastSeen"),
        F.count(F.lit(1)).alias("logOnMachinesCount"),
        F.min(F.struct(-F.col("_n"), F.col(machine))).getField(machine).alias("mostPrevalentMachineId"),
        F.min(F.struct(F.col("_n"), F.col(machine))).getField(machine).alias("leastPrevalentMachineId"),
    ).withColumn("id", F.concat_ws("\\", F.col(domain), F.col(account)))
    return conform(out.withColumnRenamed(domain, "accountDomain").withColumnRenamed(account, "accountName"), "user")


def remediation_progress(task_machines: DataFrame, vuln_inventory: DataFrame) -> DataFrame:
    """Per task, targeted devices and those no longer exposed (fixed).

    ``task_machines`` is (taskId, recommendationId, id=machine) as J26 returns.
    A targeted device is fixed when no inventory row links it to the
    recommendation any more.
    """
    on = ["recommendationId", "id"]  # both sides are spread by it, so neither a distinct nor the join shuffles again
    still = spread(vuln_inventory.select(F.col("recommendationReference").alias("recommendationId"), F.col("deviceId").alias("id")).dropna(), *on)
    still = still.distinct().withColumn("_open", F.lit(True))
    t = spread(task_machines.select("taskId", *on), *on).distinct()
    j = t.join(still, on, "left")
    return j.groupBy(F.col("taskId").alias("id")).agg(
        F.count(F.lit(1)).alias("targetDevices"), F.count_if(F.col("_open").isNull()).alias("fixedDevices"))
