import gzip
import json
import os

import pytest
from pyspark.sql.types import StructType

from fleetlake.sources.export import scan_export, scan_export_quarantine, skipped_files
from fleetlake.sources.pages import manifest_paths, scan_inferred, scan_pages
from fleetlake.sources.readers import read_export, read_pages

SCHEMA = "id STRING, name STRING"


def _write(path, text, gz=False):
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
    return path


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_plain_blank_lines_bom_and_gzip(spark, tmp):
    schema = StructType.fromDDL(SCHEMA)
    a = _write(f"{tmp}/a.json", '﻿{"id":"1","name":"x"}\n\n\n{"id":"2","name":"y"}\n')
    b = _write(f"{tmp}/b.json.gz", "".join(json.dumps({"id": str(i), "name": "g"}) + "\n" for i in range(3, 8)), gz=True)
    df = scan_export(spark, [a, b], schema)
    assert _ids(df) == ["1", "2", "3", "4", "5", "6", "7"]
    assert set(r._source.rsplit("/", 1)[-1] for r in df.select("_source").collect()) == {"a.json", "b.json.gz"}


def test_gzip_by_magic_bytes_and_multi_member(spark, tmp):
    schema = StructType.fromDDL(SCHEMA)
    p = f"{tmp}/blob"
    with open(p, "wb") as f:
        f.write(gzip.compress(b'{"id":"1"}\n{"id":"2"}\n') + gzip.compress(b'{"id":"3"}\n'))
    q = _write(f"{tmp}/plain", '{"id":"4"}\n')
    assert _ids(scan_export(spark, [p, q], schema)) == ["1", "2", "3", "4"]
    assert _ids(scan_export(spark, [p], schema, detect="magic")) == ["1", "2", "3"]


def test_empty_blob_skipped_and_no_blobs(spark, tmp):
    schema = StructType.fromDDL(SCHEMA)
    a = _write(f"{tmp}/a.json", '{"id":"1"}\n')
    e = _write(f"{tmp}/empty.json", "")
    df = scan_export(spark, [a, e], schema)
    assert df.count() == 1
    assert [r._source.rsplit("/", 1)[-1] for r in skipped_files(spark, [a, e], df).collect()] == ["empty.json"]
    assert scan_export(spark, [], schema).count() == 0


def test_bad_line_fails_or_quarantines(spark, tmp):
    schema = StructType.fromDDL(SCHEMA)
    p = _write(f"{tmp}/bad.json", '{"id":"1"}\n{not json\n')
    with pytest.raises(Exception):
        scan_export(spark, [p], schema).collect()
    good, bad = scan_export_quarantine(spark, [p], schema)
    assert _ids(good) == ["1"] and bad.collect()[0]._corrupt_record == "{not json"


def test_envelopes_and_pages(spark, tmp):
    os.makedirs(f"{tmp}/pages")
    docs = {"p1": [{"id": "1", "name": "a"}, {"id": "2", "name": "b"}], "p2": {"value": [{"id": "3"}], "@odata.nextLink": "/next"},
            "p3": {"value": {"id": "4"}}, "p4": {"id": "5"}, "p5": {"value": None}, "p6": 7, "p7": []}
    for k, v in docs.items():
        _write(f"{tmp}/pages/{k}.json", json.dumps(v))
    assert _ids(scan_pages(spark, f"{tmp}/pages", StructType.fromDDL(SCHEMA))) == ["1", "2", "3", "4", "5"]


def test_manifest_and_inferred(spark, tmp):
    a = _write(f"{tmp}/a.json", '{"id":"1"}\n')
    m = _write(f"{tmp}/manifest.json", json.dumps({"exportFiles": [a, None], "generatedTime": "2024-01-01T00:00:00Z"}))
    assert manifest_paths(spark, m) == [a]
    h = _write(f"{tmp}/hunt.json", json.dumps({"Schema": [], "Results": [{"DeviceName": "d", "n": 1}, {"DeviceName": "e", "n": 2}]}))
    out = scan_inferred(spark, h)
    assert sorted(out.columns) == ["DeviceName", "n"] and out.count() == 2


def test_readers(spark, tmp):
    p = _write(f"{tmp}/m.json", json.dumps({"id": "m1", "healthStatus": "Active", "rbacGroupId": "4", "Unknown": 1}) + "\n")
    df = read_export(spark, "machines", [p])
    r = df.collect()[0]
    assert r.id == "m1" and r.rbacGroupId == 4 and "Unknown" not in df.columns
    os.makedirs(f"{tmp}/pg")
    _write(f"{tmp}/pg/1.json", json.dumps({"value": [{"id": "a1", "severity": "High", "status": "New"}]}))
    assert read_pages(spark, "alerts", f"{tmp}/pg").collect()[0].severity == "High"
    av = _write(f"{tmp}/av.json", json.dumps({"DeviceId": "d1", "OsPlatform": "Linux"}) + "\n")
    out = read_export(spark, "av_health", [av]).collect()[0]
    assert out.machineId == "d1" and out.osKind == "linux" and out.quickScanResult == "-"


def test_blank_only_blob_is_skipped_not_fatal(spark, tmp):
    schema = StructType.fromDDL(SCHEMA)
    a = _write(f"{tmp}/a.json", '{"id":"1"}\n')
    blank = _write(f"{tmp}/blank.json", "\n  \n\n")
    gz_blank = _write(f"{tmp}/blank2.json.gz", "\n\n", gz=True)
    df = scan_export(spark, [a, blank, gz_blank], schema)
    assert _ids(df) == ["1"]
    skipped = sorted(r._source.rsplit("/", 1)[-1] for r in skipped_files(spark, [a, blank, gz_blank], df).collect())
    assert skipped == ["blank.json", "blank2.json.gz"]
