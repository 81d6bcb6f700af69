"""Edge cases: redaction, paging, filter value rules, empty skips."""
import json
import os

import pytest

from fleetlake.functions.query_models import AlertsQuery, CertificateInventoryQuery, MachinesQuery
from fleetlake.functions.scalars import REDACTED_URL, redact_url
from fleetlake.operators.conform import conform
from fleetlake.sources.pages import scan_pages
from pyspark.sql.types import StructType


@pytest.mark.parametrize("raw, shown", [
    ("abfss://land@store.test/day=1/part-7.json?tok=x", "abfss://land@store.test/day=1/part-7.json"),
    ("https://user:pw@files.test:8443/a%3Fb/c#top?x=1", "https://user:pw@files.test:8443/a%3Fb/c"),
    ("https://[2001:db8::9]:80/f?s=1", "https://[2001:db8::9]:80/f"),
    ("/mnt/drop/only#frag", "/mnt/drop/only"),
    ("s3a://b/k?one=1\ntwo=2", "s3a://b/k"),
    ("s3a://b/plain", "s3a://b/plain"), ("?", ""), ("", ""), ("ftp://[broken/x", REDACTED_URL), (None, REDACTED_URL)])
def test_redaction_cases(spark, raw, shown):
    df = spark.createDataFrame([(raw,)], "u string")
    assert df.select(redact_url("u").alias("r")).head().r == shown


def test_two_pages_plus_one_and_empty_page(spark, tmp):
    os.makedirs(f"{tmp}/p")
    pages = [{"value": [{"id": "1", "name": "a"}, {"id": "2", "name": "b"}], "@odata.nextLink": "/next"},
             {"value": [{"id": "3", "name": "c"}]}]
    for i, pg in enumerate(pages):
        with open(f"{tmp}/p/{i}.json", "w") as f:
            json.dump(pg, f, indent=2)  # pretty printed: one response per file
    schema = StructType.fromDDL("id STRING, name STRING")
    assert sorted(r.id for r in scan_pages(spark, f"{tmp}/p", schema).collect()) == ["1", "2", "3"]
    os.makedirs(f"{tmp}/e")
    with open(f"{tmp}/e/0.json", "w") as f:
        f.write("[]")
    assert scan_pages(spark, f"{tmp}/e", schema).count() == 0


def test_filter_value_rules(spark):
    alerts = conform(spark.createDataFrame([("a1", "New")], "id string, status string"), "alert")
    with pytest.raises(TypeError):
        AlertsQuery(assignedTo=[1, 2]).predicate(alerts.schema)
    # int list is fine where the column is numeric (incidentId BIGINT)
    assert AlertsQuery(incidentId=[1, 2]).predicate(alerts.schema) is not None
    with pytest.raises(ValueError):
        CertificateInventoryQuery(deviceId="x")
    assert CertificateInventoryQuery(top=5).top == 5


def test_skip_zero_is_one_slice(spark):
    df = conform(spark.createDataFrame([(f"m{i}",) for i in range(5)], "id string"), "machine")
    assert [r.id for r in MachinesQuery(skip=0).apply(df).collect()] == ["m0", "m1", "m2", "m3", "m4"]
    assert [r.id for r in MachinesQuery(skip=0, top=2).apply(df).collect()] == ["m0", "m1"]
