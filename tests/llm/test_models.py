"""Quality classifier, mixing, and the pipeline."""
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetlake.llm import mixing, ordinal, packing, queries, simhash

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_ordinal_recovers_a_known_model():
    rng = np.random.default_rng(0)
    x = (rng.random((4000, 12)) < 0.4).astype(float)
    w = np.zeros(12)
    w[:4] = [2.0, -2.0, 1.5, -1.0]
    score, t = x @ w + rng.logistic(size=4000), np.array([-1.0, 1.0])
    grades = (score[:, None] > t).sum(axis=1)
    rows = [(np.flatnonzero(r) + 3, np.ones(int(r.sum()))) for r in x]
    model = ordinal.fit_ordinal(rows, grades, buckets=32, ridge=1e-5)
    assert np.abs(model.weights[3:15] - w).max() < 0.4 and np.abs(model.thresholds - t).max() < 0.4
    tails = model.tails(np.array([-50.0, 0.0, 50.0]))
    assert (tails[:, 0] >= tails[:, 1]).all() and tails[0].max() < 1e-6 and tails[2].min() > 1 - 1e-6


def test_ordinal_without_ratings_keeps_all(spark, odd_docs, labels):
    model = ordinal.train(odd_docs, ordinal.grades_from_labels(labels.limit(0)))
    out = ordinal.classify(odd_docs, model, keep=("doc_id", "kept", "text"))
    assert out.count() == odd_docs.count() and all(r[-1] for r in out.collect())
    model = ordinal.train(odd_docs, ordinal.grades_from_labels(labels))
    assert ordinal.classify(odd_docs, model).count() == odd_docs.count()
    assert ordinal.classify(odd_docs.limit(0), model).count() == 0


def test_classifier_on_held_out_labels(documents):
    docs, labels = documents
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    grades = ordinal.grades_from_labels(labels)
    model = ordinal.train(docs, grades.where(half))
    out = ordinal.classify(docs, model).join(grades.where(~half), "doc_id").toPandas()
    clean = out.grade == 2
    assert out.kept[clean].mean() > 0.9 and out.kept[~clean].mean() < 0.5
    assert out.expected_grade[clean].mean() > out.expected_grade[~clean].mean() + 0.5


def test_mixing_meets_its_targets(spark, documents):
    docs, labels = documents
    labelled = mixing.labelled_domains(docs, labels)
    targets = {"en": 0.4, "de": 0.3, "fr": 0.2, "es": 0.1}
    out = mixing.mix(docs, labelled, targets=targets, budget=200_000.0).toPandas()
    assert (out.rate >= 0).all()
    for d, share in targets.items():
        total = (out.rate * out.tokens * out.posteriors.map(lambda p, d=d: dict(p)[d])).sum()
        assert total == pytest.approx(200_000 * share, rel=1e-3)
    assert np.allclose(out.posteriors.map(lambda p: sum(dict(p).values())), 1)
    truth = docs.select("doc_id", "lang").toPandas().drop_duplicates().merge(out, on="doc_id")
    assert (truth.lang == truth.domain).mean() > 0.9
    assert not any(k in out for k in ("Python", "Arrow"))


def test_mixing_gradient_equals_numpy(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.5, 0.5, 0.5], 60)
    n = rng.integers(0, 500, 60)
    rows = [(int(a), 1, *map(float, b)) for a, b in zip(n, p)]
    members = spark.createDataFrame(rows, "tokens long, same long, p_0 double, p_1 double, p_2 double")
    out, report = mixing.fit_rates(members, [1.0, 2.0, 7.0], budget=9000.0, steps=40)
    wanted, rate = 9000 * np.array([0.1, 0.2, 0.7]), np.ones(60)
    mass = (n[:, None] * p).sum(0)
    for _ in range(40):
        reached = ((rate * n)[:, None] * p).sum(0)
        if (np.abs(reached - wanted) / wanted).max() <= 1e-4:
            break
        rate = np.maximum(0, rate - p @ ((reached - wanted) / mass))
    got = np.array([r["rate"] for r in out.orderBy("p_0").collect()])
    assert np.allclose(got, rate[np.argsort(p[:, 0])])
    assert report["targets"] == pytest.approx(list(wanted))


def test_mixing_plan_is_native(documents, capsys):
    docs, labels = documents
    mixing.mix(docs, mixing.labelled_domains(docs, labels), steps=2).explain()
    assert not any(x in capsys.readouterr().out for x in ("Python", "Arrow", "Pandas"))


def test_mixing_odd_rows(spark, odd_docs, labels):
    mixed = mixing.mix(odd_docs, mixing.labelled_domains(odd_docs, labels))
    n = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).distinct().count()
    assert mixed.count() == n and mixed.where("rate is null or rate < 0 or isnan(rate)").count() == 0
    out = mixing.apply_rates(odd_docs, mixed)
    assert out.columns == odd_docs.columns
    empty = mixing.mix(odd_docs.limit(0), mixing.labelled_domains(odd_docs, labels).limit(0))
    assert empty.count() == 0
    alone = mixing.mix(odd_docs, mixing.labelled_domains(odd_docs, labels).limit(0))
    assert alone.count() == n and alone.where("rate <> 1").count() == 0
    assert mixing.apply_rates(odd_docs, alone).count() == odd_docs.count()


def test_missed_targets_are_told_and_rates_have_a_floor(spark):
    rows = [(100, 1, 0.9, 0.1)] * 5 + [(100, 1, 0.6, 0.4)] * 5
    members = spark.createDataFrame(rows, "tokens long, same long, p_0 double, p_1 double")
    with pytest.warns(UserWarning, match="off their targets"):
        _, report = mixing.fit_rates(members, [0.0, 1.0], budget=1000.0)  # no document is of the second domain alone
    assert report["off"] > 0.1
    out, report = mixing.fit_rates(members, [0.74, 0.26], budget=1200.0, least=1.0)
    assert out.agg(F.min("rate")).head()[0] >= 1.0 and report["off"] <= 1e-4 and sum(report["reached"]) == pytest.approx(1200, rel=1e-3)


def test_copies_follow_rates(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(2000)], "doc_id long, text string")
    mixed = docs.select("doc_id", F.xxhash64("text").alias("h"), F.when(F.col("doc_id") < 1000, 0.25).otherwise(2.5).alias("rate"))
    out = mixing.apply_rates(docs, mixed)
    few, many = out.where("doc_id < 1000").count(), out.where("doc_id >= 1000").count()
    assert 190 < few < 310 and 2400 < many < 2600
    assert out.groupBy("doc_id").count().agg(F.max("count")).head()[0] == 3


def without_passages(texts, span=150, words=51):
    """Texts without the runs of at least ``words`` words that strings of ``span`` bytes found twice cover."""
    often = Counter(hash(t[i : i + span]) for t in texts.values() for i in range(len(t) - span + 1))
    out = {}
    for k, t in texts.items():
        cover = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - span + 1):
            if often[hash(t[i : i + span])] > 1:
                cover[i] += 1
                cover[i + span] -= 1
        inside = np.concatenate([[0], np.cumsum(cover[:-1]) > 0, [0]]).astype(int)
        edges, at, rest = np.flatnonzero(np.diff(inside)), 0, b""
        for a, b in zip(edges[::2], edges[1::2]):
            if len(t[a:b].split()) >= words:
                rest, at = rest + t[at:a], b
        out[k] = (rest + t[at:]).decode("utf-8", "ignore")
    return out


def test_pipeline_stage_by_stage(spark, documents):
    docs, labels = documents
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "mixing", "best_fit_packing"]
    from fleetlake.llm.common import written

    kept = written(corpus_pipeline.quality_classifier(spark, docs, SF), "t")
    verdict = ordinal.classify(docs, ordinal.train(docs, ordinal.grades_from_labels(labels)))
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in verdict.where("kept").select("doc_id").collect())

    single = written(corpus_pipeline.simhash_near_dedup(spark, kept, SF), "t")
    want = simhash.near_duplicates(kept).where("kept").select("doc_id")
    assert single.columns == docs.columns
    assert sorted(r[0] for r in single.select("doc_id").collect()) == sorted(r[0] for r in want.collect())

    cut = written(corpus_pipeline.suffix_array_dedup(spark, single, SF), "t")
    want = without_passages({r["doc_id"]: (r["text"] or "").encode() for r in single.collect()})
    assert cut.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want
    assert cut.where("n_chars <> length(text)").count() == 0

    mixed = written(corpus_pipeline.mixing(spark, cut, SF), "t")
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() == cut.count() <= mixed.count()

    packed = corpus_pipeline.best_fit_packing(spark, mixed, SF).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    assert set(packed.doc_id) == {r[0] for r in mixed.select("doc_id").distinct().collect()}


def test_pipeline_on_odd_rows(spark, odd_docs, labels, tmp):
    labels.write.parquet(f"{tmp}/labels.parquet")
    odd_docs.write.parquet(f"{tmp}/documents.parquet")
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), tmp).count() == 0, name
        out = stage(spark, docs, tmp)
        assert out.count() > 0 or name == "quality_classifier", name
        if name != "best_fit_packing":
            assert out.columns == docs.columns, name
    assert corpus_pipeline.run(spark, tmp).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_queries_are_registered():
    import __spark_entry__ as E

    found = E.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in found if k.startswith("op")} and "pipeline" in found
    assert set(queries.QUERIES) <= set(found)
    assert packing.CAPACITY == 1024
