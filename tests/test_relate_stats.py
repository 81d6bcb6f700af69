"""Joins and rollups on small literal fixtures, checked against brute force in Python."""
import datetime as dt
from collections import Counter, defaultdict

from fleetlake.operators import relate, stats
from fleetlake.operators.conform import conform

T = dt.datetime


def fixtures(spark):
    ev = [("f1", "a.exe", "1.1.1.1", "https://x.com/p?s=1", T(2024, 1, 1)),
          ("f1", "b.exe", "1.1.1.1", "https://y.com/", T(2024, 1, 2)),
          ("f2", "a.exe", "2.2.2.2", None, T(2024, 1, 3))]
    rows = [("a1", "m1", [dict(entityType="File", evidenceCreationTime=e[4], sha1=e[0], fileName=e[1], ipAddress=e[2], url=e[3]) for e in ev[:2]]),
            ("a2", "m2", [dict(entityType="File", evidenceCreationTime=ev[2][4], sha1="f1", fileName="a.exe", ipAddress="1.1.1.1", url=None),
                          dict(entityType="File", evidenceCreationTime=ev[2][4], sha1=ev[2][0], fileName=ev[2][1], ipAddress=ev[2][2], url=ev[2][3])]),
            ("a3", "m1", None)]
    alerts = conform(spark.createDataFrame(rows, "id string, machineId string, evidence array<struct<entityType:string,"
                                                 "evidenceCreationTime:timestamp,sha1:string,fileName:string,ipAddress:string,url:string>>"), "alert")
    machines = conform(spark.createDataFrame([("m1", "h1"), ("m2", "h2")], "id string, computerDnsName string"), "machine")
    return alerts, machines


def test_alert_joins(spark):
    alerts, machines = fixtures(spark)
    assert {(r.alertId, r.ipAddress) for r in relate.alert_ips(alerts).collect()} == {("a1", "1.1.1.1"), ("a2", "1.1.1.1"), ("a2", "2.2.2.2")}
    assert {(r.alertId, r.host) for r in relate.alert_domains(alerts).collect()} == {("a1", "x.com"), ("a1", "y.com")}
    assert {(r.hash, r.id) for r in relate.file_alerts(alerts, ["f1"]).collect()} == {("f1", "a1"), ("f1", "a2")}
    assert {(r.hash, r.id) for r in relate.file_machines(alerts, machines, ["f1"]).collect()} == {("f1", "m1"), ("f1", "m2")}
    assert {(r.alertId, r.id) for r in relate.alert_machines(alerts, machines, ["a3"]).collect()} == {("a3", "m1")}
    assert {r.id for r in relate.machine_alerts(alerts, ["m1"]).collect()} == {"a1", "a3"}


def test_prevalence_matches_brute_force(spark):
    alerts, _ = fixtures(spark)
    rows = stats.evidence_rows(alerts).collect()
    fs = {r.sha1: r for r in stats.file_stats(stats.evidence_rows(alerts), k=1).collect()}
    machines = defaultdict(set)
    names = defaultdict(Counter)
    for r in rows:
        if r.sha1:
            machines[r.sha1].add(r.machineId)
            names[r.sha1][r.fileName] += 1
    for sha, ms in machines.items():
        assert fs[sha].organizationPrevalence == len(ms)
        top = sorted(names[sha].items(), key=lambda kv: (-kv[1], kv[0]))[0][0]
        assert fs[sha].topFileNames == [top]
    ips = {r.ipAddress: r.organizationPrevalence for r in stats.ip_stats(stats.evidence_rows(alerts)).collect()}
    assert ips == {"1.1.1.1": 2, "2.2.2.2": 1}


def test_footprint_and_latest(spark):
    logons = spark.createDataFrame([("u", "D", "m1", T(2024, 1, 1)), ("u", "D", "m1", T(2024, 1, 2)), ("u", "D", "m2", T(2024, 1, 3)),
                                    ("v", "D", "m3", T(2024, 1, 1)), ("v", "D", None, T(2024, 1, 9))],
                                   "accountName string, accountDomain string, machineId string, logonTime timestamp")
    out = {r.accountName: r for r in stats.user_footprint(logons).collect()}
    assert out["u"].mostPrevalentMachineId == "m1" and out["u"].leastPrevalentMachineId == "m2"
    assert out["u"].logOnMachinesCount == 2 and out["v"].lastSeen == T(2024, 1, 1)
    scores = spark.createDataFrame([(T(2024, 1, 1), 1.0, 7), (T(2024, 1, 2), 2.0, 7), (T(2024, 1, 2), 3.0, 8)],
                                   "time timestamp, score double, rbacGroupId long")
    assert {r.rbacGroupId: r.score for r in stats.latest_score_per_group(scores).collect()} == {7: 2.0, 8: 3.0}
