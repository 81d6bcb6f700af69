from datetime import datetime, timedelta, timezone

import pytest

from fleetlake.functions import predicates as P
from fleetlake.functions.query_models import AlertsQuery, MachinesExportQuery, MachinesQuery, SoftwareQuery
from fleetlake.functions.scalars import since_bound, since_date, utc_iso_z
from fleetlake.operators.conform import conform


@pytest.fixture()
def machines(spark):
    rows = [(f"id{i}", "Active" if i % 2 else "Inactive", ["prod", f"team-{i % 3}"], f"10.0.0.{i}",
             datetime(2025, 6, 1, 8, 0) + timedelta(hours=i), [{"ipAddress": f"10.0.0.{i}"}, {"ipAddress": "fe80::1"}])
            for i in range(10)]
    df = spark.createDataFrame(rows, "id string, healthStatus string, machineTags array<string>, lastIpAddress string, "
                                     "lastSeen timestamp, ipAddresses array<struct<ipAddress:string>>")
    return conform(df, "machine")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_equality_membership_conjunction(machines):
    assert len(ids(MachinesQuery(healthStatus="Active").apply(machines))) == 5
    assert ids(MachinesQuery(id=["id1", "id2"]).apply(machines)) == ["id1", "id2"]
    assert ids(MachinesQuery(id=["id1", "id2"], healthStatus="Active").apply(machines)) == ["id1"]
    assert ids(MachinesQuery(id=[]).apply(machines)) == []
    assert machines.filter(P.eq("id", "o'brien")).count() == 0


def test_top_skip_one_slice(machines):
    assert ids(MachinesQuery(top=3).apply(machines)) == ["id0", "id1", "id2"]
    assert ids(MachinesQuery(skip=8).apply(machines)) == ["id8", "id9"]
    assert ids(MachinesQuery(top=2, skip=4).apply(machines)) == ["id4", "id5"]
    with pytest.raises(ValueError):
        MachinesQuery(top=0)
    with pytest.raises(ValueError):
        MachinesQuery(top=10001)
    with pytest.raises(ValueError):
        MachinesQuery(skip=-1)
    with pytest.raises(ValueError):
        MachinesQuery(page_size=10001)
    MachinesExportQuery(page_size=200000)


def test_domain_type_and_unknown_field_errors(machines):
    with pytest.raises(ValueError):
        MachinesQuery(healthStatus="Sleeping")
    with pytest.raises(ValueError):
        SoftwareQuery(color="red")
    with pytest.raises(TypeError):
        MachinesQuery(computerDnsName=5).predicate(machines.schema)
    # int allowed where the column is numeric (rbacGroupId INT)
    assert MachinesQuery(rbacGroupId=3).predicate(machines.schema) is not None
    with pytest.raises(TypeError):
        AlertsQuery(assignedTo=True).predicate(conform(machines.limit(0), "alert").schema)


def test_since_forms():
    now = datetime(2025, 6, 10, tzinfo=timezone.utc)
    assert since_bound(3, now=now) == datetime(2025, 6, 7, tzinfo=timezone.utc)
    assert since_bound(datetime(2025, 6, 1, 8, 30)) == datetime(2025, 6, 1, 8, 30, tzinfo=timezone.utc)
    est = timezone(timedelta(hours=-5))
    assert utc_iso_z(datetime(2025, 6, 1, 8, 0, tzinfo=est)) == "2025-06-01T13:00:00Z"
    assert since_bound("2025-01-01") == "2025-01-01"
    with pytest.raises(TypeError):
        since_bound(1.5)
    assert since_date(2, now=now) == "2025-06-08"
    with pytest.raises(ValueError):
        since_date("01/02/2025", regex=r"^\d{4}-\d{2}-\d{2}$")


def test_since_filter(machines):
    q = MachinesQuery(sinceTime=datetime(2025, 6, 1, 15, 0))
    assert ids(q.apply(machines)) == ["id7", "id8", "id9"]


def test_tags_ip_and_ipv4(machines):
    assert len(ids(machines.filter(P.tag_match("team-1")))) == 3
    assert machines.filter(P.tag_match("team")).count() == 0
    assert machines.filter(P.tag_match("team", starts_with=True)).count() == 10
    near = P.ip_near("10.0.0.3", datetime(2025, 6, 1, 11, 0), timedelta(minutes=30))
    assert ids(machines.filter(near)) == ["id3"]
    assert sorted(r.ipAddress for r in P.distinct_ipv4(machines).collect()) == sorted(f"10.0.0.{i}" for i in range(10))


def test_lookup_ids_list_and_frame(machines, spark):
    assert ids(P.lookup_ids(machines, "id4")) == ["id4"]
    keys = spark.createDataFrame([("id1",), ("id9",), ("nope",)], ["k"])
    assert ids(P.lookup_ids(machines, keys)) == ["id1", "id9"]
