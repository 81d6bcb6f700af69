"""Landed pages of every envelope shape, cut and large pages, codecs by content, quarantine, lineage."""
import gzip
import json
import os

import pytest
from fleetlake.sources.export import raw_lines, scan_export, scan_export_quarantine, skipped_files
from fleetlake.sources.pages import manifest_paths, scan_pages
from fleetlake.sources.readers import DATASETS, read_export, read_export_quarantine, read_pages
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([StructField("id", StringType()), StructField("n", LongType())])


def land(folder, files):
    os.makedirs(folder)
    for name, content in files.items():
        with open(f"{folder}/{name}", "wb") as f:
            f.write(content if isinstance(content, bytes) else content.encode())


@pytest.mark.parametrize("text, ids", [
    ('[{"id":"1"},{"id":"2"}]', ["1", "2"]), ('{"value":[{"id":"1"}],"next":"x"}', ["1"]), ('{"value":{"id":"1"}}', ["1"]), ('{"id":"1","n":"7"}', ["1"]),
    ('{"value":null}', []), ('{"value":[]}', []), ('{"value":5}', []), ('{"value":"[1]"}', []), ("[]", []), ("null", []), ('"text"', []), ("12", []),
    ("﻿ \n[{\"id\":\"1\"}]", ["1"]), ("  \n\t ", []), ("", []), ('{\n "value": [\n  {"id": "a\\"]}"}\n ]\n}', ['a"]}'])])
def test_envelopes(spark, tmp, text, ids):
    land(f"{tmp}/p", {"0.json": text})
    assert sorted(r.id for r in scan_pages(spark, f"{tmp}/p", SCHEMA).collect()) == ids


@pytest.mark.parametrize("text", ['{"value":[{"id":"1"},{"id":"2"', '[{"id":"1"},', '{"value":[{"id":"1"}]', "nonsense", '{"id":'])
def test_a_cut_page_aborts(spark, tmp, text):
    land(f"{tmp}/p", {"0.json": '[{"id":"1"}]', "1.json": text})
    with pytest.raises(Exception):
        scan_pages(spark, f"{tmp}/p", SCHEMA).collect()


def test_a_large_page_gives_every_row(spark, tmp):
    n = 140_000  # above the 128 MiB that a VARIANT holds
    os.makedirs(f"{tmp}/p")
    with open(f"{tmp}/p/0.json", "w") as f:
        f.write('{"value":[')
        f.write(",".join(f'{{"id":"{i}","n":{i},"pad":"{"x" * 1000}"}}' for i in range(n)))
        f.write("]}")
    row = scan_pages(spark, f"{tmp}/p", SCHEMA).selectExpr("count(*) c", "sum(n) s", "count(distinct id) d").head()
    assert (row.c, row.s, row.d) == (n, n * (n - 1) // 2, n)


def test_manifest(spark, tmp):
    land(f"{tmp}/m", {"a.json": json.dumps({"exportFiles": ["u1", "u2", None], "generatedTime": "2024-01-01T00:00:00Z"}), "b.json": json.dumps({"value": {"exportFiles": ["u3"]}})})
    assert sorted(manifest_paths(spark, f"{tmp}/m")) == ["u1", "u2", "u3"]


LINES = b'\xef\xbb\xbf{"id":"1","n":1}\n\n  {"id":"2","n":"2"}\r\n{"id":"\xc3\xa9","n":null}'


@pytest.mark.parametrize("detect", ["content", "magic"])
@pytest.mark.parametrize("name, content", [("a.json", LINES), ("a.json.gz", gzip.compress(LINES)), ("b.json", gzip.compress(LINES)), ("c.gz", LINES),
                                           ("noname", gzip.compress(LINES[:20]) + gzip.compress(LINES[20:])), ("d.txt", LINES + b"\n"), ("e.zst", LINES)])
def test_codec_by_content(spark, tmp, name, content, detect):
    land(f"{tmp}/x", {name: content})
    for path in (f"{tmp}/x/{name}", f"{tmp}/x/", f"{tmp}/x"):
        out = scan_export(spark, [path], SCHEMA, detect=detect).collect()
        assert sorted((r.id, r.n) for r in out) == [("1", 1), ("2", 2), ("é", None)] and {os.path.basename(r._source) for r in out} == {name}


def test_gzip_cut_off_aborts(spark, tmp):
    whole = gzip.compress(b'{"id":"1"}\n' * 5000)
    land(f"{tmp}/x", {"a.json": whole[: len(whole) // 2]})
    with pytest.raises(Exception):
        raw_lines(spark, [f"{tmp}/x"]).collect()


def test_many_lines_in_one_odd_blob(spark, tmp):
    land(f"{tmp}/x", {"a.log": gzip.compress("".join(f'{{"id":"{i}é"}}\n' for i in range(60_000)).encode())})
    assert raw_lines(spark, [f"{tmp}/x"]).distinct().count() == 60_000


def test_bad_lines_are_quarantined_and_blank_blobs_reported(spark, tmp):
    land(f"{tmp}/x", {"a.json": '{"id":"1"}\n{"id":\n', "b.json": "\n\n"})
    with pytest.raises(Exception):
        scan_export(spark, [f"{tmp}/x"], SCHEMA).collect()
    good, bad = scan_export_quarantine(spark, [f"{tmp}/x"], SCHEMA)
    assert [r.id for r in good.collect()] == ["1"] and [r._corrupt_record for r in bad.collect()] == ['{"id":']
    paths = [f"{tmp}/x/a.json", f"{tmp}/x/b.json"]
    assert [os.path.basename(r._source) for r in skipped_files(spark, paths, good).collect()] == ["b.json"]


def test_antivirus_lines_keep_their_source(spark, tmp):
    land(f"{tmp}/x", {"a.json": '{"DeviceId":"d1","OsPlatform":"Windows10"}\nnot json\n'})
    with pytest.raises(Exception):
        read_export(spark, "av_health", [f"{tmp}/x"]).collect()
    good, bad = read_export_quarantine(spark, "av_health", [f"{tmp}/x"])
    assert [(r.id, os.path.basename(r._source)) for r in good.collect()] == [("d1", "a.json")] and bad.count() == 1


def test_secrets_are_an_opt_in(spark, tmp):
    land(f"{tmp}/x", {"a.json": json.dumps({"id": "s", "scanAuthenticationParams": {"type": "SnmpAuthParams", "communityString": "hush"}})})
    assert read_pages(spark, "scan_definitions", f"{tmp}/x").head().scanAuthenticationParams.communityString is None
    assert read_pages(spark, "scan_definitions", f"{tmp}/x", keep_secrets=True).head().scanAuthenticationParams.communityString == "hush"


@pytest.mark.parametrize("dataset", sorted(DATASETS))
def test_every_dataset_reads_a_record_of_its_contract(spark, tmp, dataset):
    """A record with every field of the contract, nested ones included, lands and comes back typed."""
    from fleetlake.plans.contracts import contract
    from pyspark.sql import types as T

    def value(t):
        if isinstance(t, T.StructType):
            return {f.name: value(f.dataType) for f in t.fields}
        if isinstance(t, T.ArrayType):
            return [value(t.elementType)]
        if isinstance(t, T.MapType):
            return {"k": value(t.valueType)}
        if isinstance(t, T.BooleanType):
            return True
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            return "2024-01-02T03:04:05Z"
        if isinstance(t, T.DateType):
            return "2024-01-02"
        return "7" if isinstance(t, T.StringType) else 7

    schema = contract(DATASETS[dataset].contract)
    record = value(schema)
    land(f"{tmp}/x", {"a.json": json.dumps(record) + "\n"})
    for out in (read_export(spark, dataset, [f"{tmp}/x"]), *([] if DATASETS[dataset].flatten else [read_pages(spark, dataset, f"{tmp}/x", keep_secrets=True)])):
        rows = out.collect()
        assert len(rows) == 1 and rows[0]._source.endswith("a.json")
        got = rows[0].asDict(recursive=True)
        if not DATASETS[dataset].flatten and dataset != "scan_definitions":
            assert not [f.name for f in schema.fields if got[f.name] is None], dataset
        assert out.select(*schema.fieldNames()).schema.simpleString() == schema.simpleString()
