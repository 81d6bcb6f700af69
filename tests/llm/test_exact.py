"""Exact duplicates against a dictionary of texts."""
import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import exact
from fleetlake.llm.queries import op11_exact_dedup

SF = "/root/testdata/sf0.001"


def brute(rows):
    """``(id, keep_id, group_size, kept, sha)`` of ``(id, text)``, ids without repeats."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[b"".join((t or "").encode().split())].append((-len(t or ""), i))
    return sorted((i, min(m)[1], len(m), i == min(m)[1], hashlib.sha256(b).hexdigest()) for b, m in groups.items() for _, i in m)


def rows_of(df):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect())


def test_query_on_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(op11_exact_dedup(spark, SF)) == brute(rows)


@pytest.mark.parametrize("digest", [exact.content_hash, lambda t: F.length(t) % 3, lambda t: F.substring(t, 1, 1)])
def test_collisions_are_told_apart(spark, digest):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab \t\n\x0b\x0c\ré  \x1c") for _ in range(rng.randint(0, 6))) for _ in range(600)] + [None, "", "a" * 9000, " a" * 9000]
    ids = rng.sample(range(10_000), len(texts))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
    assert rows_of(exact.exact_duplicates(df, digest=digest)) == brute(list(zip(ids, texts)))


def test_repeated_and_null_ids(spark, odd_docs):
    out = exact.exact_duplicates(odd_docs, keep=("n_chars", "id", "h", "kept")).collect()
    rows = {r["n_chars"]: r for r in odd_docs.collect()}
    assert len(out) == len(rows) and out[0].__fields__ == ["doc_id", "n_chars", "id", "h", "kept", "keep_id", "group_size", "kept", "text_sha256"]
    groups = defaultdict(list)
    for r in out:
        groups[r["text_sha256"]].append(r)
    for members in groups.values():
        sizes = [len(rows[m["n_chars"]]["text"] or "") for m in members]
        stays = [m for m in members if m[7]]
        assert len(stays) == 1 and {m["group_size"] for m in members} == {len(members)} and {m["keep_id"] for m in members} == {stays[0]["doc_id"]}
        best = [m["doc_id"] for m, s in zip(members, sizes) if s == max(sizes)]
        assert stays[0]["doc_id"] == min((b for b in best if b is not None), default=None)
    assert len([m for m in out if not m[7]]) == sum(len(g) - 1 for g in groups.values()) >= 5
    assert exact.exact_duplicates(odd_docs.limit(0)).count() == 0


def test_other_id_types(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "xy "), ("c", None), (None, "x  y")], "name string, body string")
    got = {(r["name"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_duplicates(df, id_col="name", text_col="body").collect()}
    assert got == {("b", None, 3, False), ("a", None, 3, False), (None, None, 3, True), ("c", "c", 1, True)}
