"""Codecs told by tasks, streamed ingest with a restart, its quarantine and lineage."""
import gzip
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from fleetlake.plans.contracts import contract as schema_for
from fleetlake.sources import export
from fleetlake.streaming.changefeed import ingest_export, read_ingested


def lines(ids):
    return "".join(json.dumps({"id": i, "healthStatus": "Active"}) + "\n" for i in ids).encode()


def put(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(content)


@pytest.fixture()
def mixed(tmp):
    d = f"{tmp}/landed"
    put(d, "a.json", lines(["a1", "a2"]))
    put(d, "b.json", gzip.compress(lines(["b1"])) + gzip.compress(lines(["b2"])))  # two members, a plain name
    put(d, "c.json.gz", lines(["c1"]))  # plain, named as packed
    put(d, "d.json.gz", gzip.compress(b"\xef\xbb\xbf" + lines(["d1"])))
    put(d, "e f%20é.json", gzip.compress(lines(["e1"])))
    put(d, "g.bz2", lines(["g1"]))
    put(d, "empty.json", b"")
    put(d, "blank.json.gz", gzip.compress(b"\n \n"))
    put(f"{d}/inner", "h.json", lines(["h1"]))
    return d


IDS = ["a1", "a2", "b1", "b2", "c1", "d1", "e1", "g1", "h1"]


@pytest.mark.parametrize("detect", ["content", "magic"])
def test_mixed_codecs(spark, mixed, detect):
    kind = schema_for("machine")
    out = export.scan_export(spark, [mixed], kind, detect=detect)
    assert sorted(r.id for r in out.collect()) == IDS
    assert sorted(json.loads(r.value)["id"] for r in export.raw_lines(spark, [mixed], detect=detect).collect()) == IDS
    assert sorted(json.loads(r.value)["id"] for r in export.raw_lines(spark, [f"{mixed}/b.json", f"{mixed}/c.json.gz"], detect=detect).collect()) == ["b1", "b2", "c1"]


def test_only_misnamed_blobs_reach_the_driver(spark, mixed, monkeypatch):
    monkeypatch.setattr("builtins.open", lambda *a, **k: pytest.fail("the driver opened a blob"))
    wrong = export._misnamed(spark, [mixed], export.open_local)
    assert sorted(os.path.basename(p) for p, _ in wrong) == ["b.json", "c.json.gz", "e f%20é.json", "g.bz2"]


def test_without_an_opener_sparks_bytes_are_used(spark, mixed, monkeypatch):
    monkeypatch.setattr(export, "opener_for", lambda *a: None)
    assert sorted(r.id for r in export.scan_export(spark, [mixed], schema_for("machine")).collect()) == IDS


def test_lines_are_streamed():
    class Counted(io.BytesIO):
        most = 0

        def read(self, n=-1):
            assert 0 < n <= export.PIECE
            return super().read(n)

    content = lines(range(100_000))
    for blob in (content, gzip.compress(content), gzip.compress(content[:999]) + b"\0\0" + gzip.compress(content[999:])):
        assert sum(1 for _ in export._lines_of(Counted(blob))) == 100_000
    with pytest.raises(EOFError):
        list(export._lines_of(Counted(gzip.compress(content)[:-9])))


def test_two_triggers_with_a_stop_between(spark, tmp, mixed):
    kind, table = schema_for("machine"), f"{tmp}/table"
    rows, bad, blobs = read_ingested(spark, table, kind)
    assert rows.count() == bad.count() == blobs.count() == 0
    ingest_export(spark, mixed, kind, table, max_files_per_trigger=2).awaitTermination()
    assert sorted(r.id for r in read_ingested(spark, table, kind)[0].collect()) == IDS
    put(mixed, "late.json", lines(["l1"]) + b'{"id": "cut\n' + lines(["l2"]) + b"[1]\n")
    put(mixed, "blank2.json", b"\n")
    ingest_export(spark, mixed, kind, table).awaitTermination()
    ingest_export(spark, mixed, kind, table).awaitTermination()  # nothing new
    rows, bad, blobs = read_ingested(spark, table, kind)
    assert sorted(r.id for r in rows.collect()) == sorted([*IDS, "l1", "l2"])
    assert sorted(r._corrupt_record for r in bad.collect()) == ["[1]", '{"id": "cut']
    seen = {os.path.basename(r._source): (r.n_rows, r.n_bad) for r in blobs.collect()}
    assert seen["late.json"] == (2, 2) and seen["blank2.json"] == seen["blank.json.gz"] == (0, 0) and len(seen) == 10
    assert blobs.select("batch").distinct().count() >= 6


def test_a_cut_off_batch_is_written_anew(spark, tmp):
    kind, d, table = schema_for("machine"), f"{tmp}/landed", f"{tmp}/table"
    put(d, "a.json", lines(["a1"]))
    ingest_export(spark, d, kind, table).awaitTermination()
    for name in os.listdir(f"{table}/_checkpoint/commits"):  # as if the driver had died before it noted the batch
        os.remove(f"{table}/_checkpoint/commits/{name}")
    put(d, "b.json", lines(["b1"]))
    ingest_export(spark, d, kind, table).awaitTermination()
    assert sorted(r.id for r in read_ingested(spark, table, kind)[0].collect()) == ["a1", "b1"]


def test_lineage_is_redacted(spark, tmp):
    d, kind = f"{tmp}/landed", schema_for("machine")
    put(d, "a.json?sig=secret", lines(["a1"]) + b"oops\n")
    ingest_export(spark, d, kind, f"{tmp}/table").awaitTermination()
    rows, bad, blobs = read_ingested(spark, f"{tmp}/table", kind)
    for df in (rows, bad, blobs):
        assert [r._source.rsplit("/", 1)[1] for r in df.select(F.col("_source")).collect()] == ["a.json"]
