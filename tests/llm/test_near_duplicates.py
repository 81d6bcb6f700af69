"""SimHash and lattice near-duplicates against brute force."""
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fleetlake.llm import lattice, simhash
from fleetlake.llm.common import connected_components

SF = "/root/testdata/sf0.001"


def reach(ids, near):
    """Smallest id reachable from each place over a symmetric relation."""
    label = list(ids)
    while True:
        new = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(label))]
        if new == label:
            return label
        label = new


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, w = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            words, w = words + [w] * bool(w), ""
        else:
            w += c
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "a", "A b", "A b c", "x y z x y z x", "É Ü ß\x0bq\x85r", " a\tb\n\nc d  e ", "w " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_long_text_fingerprint_in_parts():
    words = [f"w{i * i % 997}" for i in range(70_000)]
    assert simhash.fingerprint(" ".join(words).encode()) == simhash.fingerprint("\n".join(words).encode())
    n, ones = len(words) - 2, np.zeros(64, int)
    for i in range(n):
        h = xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42)
        ones += [h >> b & 1 for b in range(64)]
    assert simhash.fingerprint(" ".join(words).encode()) == sum(1 << b for b in range(64) if 2 * ones[b] > n)


def test_simhash_components_random(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = []
    for b in base:  # chains: each two bits or so from the one before
        for _ in range(int(rng.integers(1, 15))):
            for bit in rng.integers(0, 64, int(rng.integers(0, 5))):
                b ^= np.uint64(1) << np.uint64(bit)
            fps.append(int(b))
    ids = rng.permutation(len(fps)).tolist()
    prints = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in zip(ids, fps)], "id long, fp long")
    near = [[j for j in range(len(fps)) if bin(fps[i] ^ fps[j]).count("1") <= 3] for i in range(len(fps))]
    want = {int(np.uint64(f).view(np.int64)): c for f, c in zip(fps, reach(ids, near))}
    for block in (2048, 3):  # also with cells of many blocks
        got = {r["fp"]: r["component"] for r in simhash.components(prints, block=block).collect()}
        assert got == want


def test_simhash_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    ids = sorted(texts)
    fps = [simhash.fingerprint((texts[i] or "").encode()) for i in ids]
    near = [[j for j in range(len(ids)) if bin(fps[i] ^ fps[j]).count("1") <= 3] for i in range(len(ids))]
    want = {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, reach(ids, near))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == want


def test_simhash_odd_rows(spark, odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    of = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert {of[i]["fingerprint"] for i in (4, 5, 6)} == {"0" * 16} and {of[i]["component_id"] for i in (4, 5, 6)} == {4}
    assert of[2]["component_id"] == 1 and not of[2]["kept"] and of[1]["kept"]
    assert all(r["kept"] for r in got if r["doc_id"] is None)
    assert simhash.near_duplicates(odd_docs.limit(0)).collect() == []
    left = simhash.one_of_each_group(odd_docs)
    assert left.columns == odd_docs.columns
    kept = [r["doc_id"] for r in left.collect()]
    assert kept.count(1) == 1 and 2 not in kept and 5 not in kept and kept.count(4) == 1 and kept.count(None) == 0
    repeated = odd_docs.where("doc_id = 2")
    assert simhash.one_of_each_group(repeated).count() == 1
    nameless = [(None, "a b c d", 1), (None, "a b c d", 2), (None, "q r s t u v w", 3), (None, None, 4), (None, "", 5), (9, "q r s t u v w", 6)]
    df = spark.createDataFrame(nameless, "doc_id long, text string, _i int").withColumn("_many", F.lit("x")).withColumn("_H", F.lit(1))
    left = simhash.one_of_each_group(df)
    assert left.columns == df.columns and sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == [(0, ""), (0, "a b c d"), (9, "q r s t u v w")]


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 4999)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[i] == 1000 for i in range(1000, 1200)) and got[5000] == 4999
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_e8_decoding_is_nearest():
    x = np.random.default_rng(0).normal(size=(500, 8)) * 3
    p = lattice.decode(x)
    roots = lattice.neighbours()
    assert len(np.unique(roots, axis=0)) == 240 and np.allclose((roots**2).sum(1), 2)
    assert (((x - p) ** 2).sum(1) <= ((x[:, None] - p[:, None] - roots[None]) ** 2).sum(2).min(1) + 1e-9).all()
    assert (((x - p) ** 2).sum(1) <= 1 + 1e-9).all()  # covering radius


def test_lattice_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    (oa, na), (ob, nb) = lattice.cells(a), lattice.cells(0.98 * a + np.sqrt(1 - 0.98**2) * b)
    hit = ((oa == ob) | (na == ob[:, :, None]).any(2) | (nb == oa[:, :, None]).any(2)).any(1)
    assert hit.mean() > 0.99


def brute_vectors(rows):
    ids, ok = [r[0] for r in rows], []
    for i, v, label in rows:
        ok.append(i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v))
    def linked(i, j):
        (_, v, a), (_, w, b) = rows[i], rows[j]
        if i == j or not (ok[i] and ok[j]) or a != b or len(v) != len(w):
            return False
        v, w = np.array(v, float), np.array(w, float)
        return (v @ w) / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= 0.98
    near = [[j for j in range(len(rows)) if linked(i, j)] for i in range(len(rows))]
    c = reach([i if i is not None else 10**9 + k for k, i in enumerate(ids)], near)
    return sorted((str(i), len(n), None if i is None else x) for i, n, x in zip(ids, near, c))


@pytest.mark.parametrize("block", [2048, 2])
def test_lattice_odd_rows(spark, block):
    rng = np.random.default_rng(4)
    base = [rng.normal(size=16) for _ in range(6)]
    rows = [(k, (base[k % 6] + rng.normal(size=16) * 0.05 * (k % 4)).astype(np.float32).tolist(), k % 3 % 2) for k in range(60)]
    same = rows[0][1]
    rows += [(100, same, 0), (100, same, 0), (101, [2 * x for x in same], 0), (102, same, None), (None, same, 0), (103, None, 0), (104, [], 0),
             (105, [0.0] * 16, 0), (106, [None, *same[1:]], 0), (107, [float("nan"), *same[1:]], 0), (108, [float("inf"), *same[1:]], 0),
             (109, same[:8], 0), (110, same[:8], 0), (111, [-x for x in same], 0)]
    df = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], "vec_id long, embedding array<float>, label int, node int, size string, cell double")
    got = lattice.near_duplicates(df, block=block).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got) == brute_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_lattice_dense_label(spark, monkeypatch):
    """Near copies and vectors around them: counts are right, no block is larger than it may be, and
    not every link leaves a task."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    rows = [(k, (base + rng.normal(size=16) * (0.02 if k % 3 else 0.12)).tolist(), 0) for k in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    kept = {}

    def written(frame, name):
        kept[name] = frame.localCheckpoint()
        return kept[name]

    monkeypatch.setattr(lattice, "written", written)
    got = lattice.near_duplicates(df, block=16).collect()
    want = brute_vectors(rows)
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got) == want
    links = sum(r[1] for r in want) // 2
    assert links > 10_000 and kept["links"].where("b is not null").count() < links / 4

    def sizes(batches, least, group, **_):
        import pyarrow as pa

        for batch in lattice.runs(batches, [*group, "side"]):
            many = pa.Table.from_batches([batch]).group_by([*group, "side"]).aggregate([([], "count_all")])["count_all"].combine_chunks()
            yield pa.RecordBatch.from_arrays([many, pa.nulls(len(many), pa.int64()), many], names=["a", "b", "many"])

    monkeypatch.setattr(lattice, "_verify", sizes)
    lattice.near_duplicates(df, block=16)
    assert 8 < kept["links"].agg(F.max("a")).head()[0] <= 48


def test_spanning_links():
    rng = np.random.default_rng(9)
    for n in (2, 10, 60):
        a, b = rng.integers(0, n, (2, n * 3))
        a, b = a[a != b], b[a != b]
        some = lattice._spanning(a, b, n)
        near, few = [[] for _ in range(n)], [[] for _ in range(n)]
        for x, y, to in [(a, b, near), (a[some], b[some], few)]:
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                to[i].append(j)
                to[j].append(i)
        whole = reach(range(n), near)
        assert reach(range(n), few) == whole and len(some) == n - len(set(whole))


def test_lattice_query_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = [tuple(r) for r in df.collect()]
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in lattice.near_duplicates(df).collect())
    want = brute_vectors(rows)
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want)
    assert got == want  # at this size no link is missed
