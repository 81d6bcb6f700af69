"""The filter audit against a walk through every order."""
from collections import Counter, defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from fleetlake.llm import filter_audit
from fleetlake.llm.queries import op13_filter_audit

SF = "/root/testdata/sf0.001"
COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(rows, labels, filters="ABCDE"):
    """``rows``: (id, part, set of failing letters)."""
    good = {r["doc_id"] for r in labels if r["doc_id"] is not None and r["quality"] == 1}
    toxic = {r["doc_id"] for r in labels if r["doc_id"] is not None and r["toxic"] == 1}
    parts, out, total = defaultdict(list), [], Counter()
    for r in rows:
        parts[r[1] or ""].append(r)
    for part, members in parts.items():
        for order in permutations(filters):
            left = list(members)
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[2]]
                fails = [r for r in members if f in r[2]]
                left = [r for r in left if f not in r[2]]
                total[part, f] += len(gone)
                out.append([part, "".join(order), k + 1, len(left), len(gone), len(fails) - len(gone), sum(r[2] == {f} for r in members),
                            sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone), f])
    return sorted((*r[:-1], total[r[0], r[-1]]) for r in out)


def failing(docs):
    least = {}
    for i, _, t in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, part, t in docs:
        t = t or ""
        w = t.encode().split()
        checks = (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), i is not None and i > least[t])
        out.append((i, part, {f for f, c in zip("ABCDE", checks) if c}))
    return out


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_query_on_documents(spark):
    docs = [(r["doc_id"], r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(op13_filter_audit(spark, SF)) == brute(failing(docs), spark.read.parquet(f"{SF}/labels.parquet").collect())


def test_odd_rows(spark, odd_docs, labels, tmp):
    odd = odd_docs.withColumn("row", F.lit(1)).withColumn("part", F.lit("x")).withColumn("text", F.when(F.col("n_chars") == 10, "AB # AB").otherwise(F.col("text")))
    odd.write.parquet(f"{tmp}/documents.parquet")
    labels.union(labels).write.parquet(f"{tmp}/labels.parquet")
    docs = [(r["doc_id"], r["lang"], r["text"]) for r in odd.collect()]
    got = rows_of(op13_filter_audit(spark, tmp))
    assert got == brute(failing(docs), labels.collect()) and {g[0] for g in got} == {"", "en"}
    empty = filter_audit.audit(filter_audit.text_failures(odd_docs.limit(0)), labels)
    assert empty.count() == 0


def test_other_filters_nulls_and_no_labels(spark):
    rows = [(1, "p", True, False, None), (2, "p", True, True, True), (2, "p", False, True, False), (None, None, None, None, True), (3, "q", False, False, False)]
    df = spark.createDataFrame(rows, "id long, part string, X boolean, Y boolean, Z boolean")
    want = brute([(r[0], r[1], {f for f, v in zip("XYZ", r[2:]) if v}) for r in rows], [], "XYZ")
    assert rows_of(filter_audit.audit(df, filters="XYZ")) == want
    assert rows_of(filter_audit.audit(df, filters="Y")) == brute([(r[0], r[1], {"Y"} if r[3] else set()) for r in rows], [], "Y")


def test_no_join_of_the_audit_shuffles(spark, monkeypatch):
    seen = []
    real = filter_audit.written
    monkeypatch.setattr(filter_audit, "written", lambda df, name: seen.append((name, df)) or real(df, name))
    rows = spark.range(2000).select("id", F.lit("p").alias("part"), *[(F.col("id") % k == 0).alias(f) for f, k in zip("ABCDE", (2, 3, 5, 7, 11))])
    filter_audit.audit(rows).count()
    plan = dict(seen)["counts"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("LeftAnti") == 5 and plan.count("LeftSemi") == 15
