from pyspark.sql import functions as F

from fleetlake.operators.conform import empty_table
from fleetlake.operators.sinks import LazyResult, json_column, to_arrow, to_dicts
from fleetlake.operators.slicing import assign_batches, take_slice


def test_slices(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    assert [r.id for r in take_slice(df, ["k", "id"], top=3).collect()] == [0, 7, 14]
    assert [r.id for r in take_slice(df, "id", top=2, skip=10).collect()] == [10, 11]
    assert take_slice(df, "id", skip=990).count() == 10


def test_batches_bounded(spark):
    df = spark.range(2345).repartition(3)
    b = assign_batches(df, 500)
    sizes = [r["count"] for r in b.groupBy("batchId").count().collect()]
    assert max(sizes) <= 500 and sum(sizes) == 2345


def test_sinks_and_lazy(spark, tmp):
    df = spark.createDataFrame([("a", [1, 2])], "id string, xs array<int>")
    assert to_dicts(df, 10) == [{"id": "a", "xs": [1, 2]}]
    assert df.select(json_column(df).alias("j")).collect()[0].j == '{"id":"a","xs":[1,2]}'
    assert to_arrow(df, 10).num_rows == 1
    calls = []

    def build():
        calls.append(1)
        return spark.read.json(f"{tmp}/d") if len(calls) > 1 else df

    df.write.json(f"{tmp}/d")
    h = LazyResult(build)
    assert calls == []
    assert h.count() == 1 and h.count() == 1 and len(calls) == 1
    h2 = h.refresh()
    assert h2.count() == 1 and len(calls) == 2
    assert empty_table(spark, "machine").count() == 0


def test_deep_skip_with_descending_keys_ties_and_nulls(spark, monkeypatch):
    """Any n, in either way of finding the boundary, against a sort of all rows."""
    from pyspark.sql import functions as F

    from fleetlake.operators import slicing

    rows = [(i, None if i % 7 == 0 else i % 3, "same" if i % 3 else f"r{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, g int, _number string").repartition(5)
    low = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    high = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for most in (10_000, 0):  # 0: always by numbered ranges
        monkeypatch.setattr(slicing, "TOP_MAX", most)
        for n in (1, 28, 29, 199, 200, 500):
            assert [tuple(r) for r in slicing.skip(df, n, ["g", "id"]).collect()] == low[n:]
            if n > 28:
                assert [tuple(r) for r in slicing.skip(df, n, [F.col("g").desc(), "id"]).collect()] == high[n:]
        # ties only: as many rows as are left, the same ones for any partitioning
        a, b = (sorted(r.id for r in slicing.skip(x, 50, "g").collect()) for x in (df, df.repartition(3, "id")))
        assert a == b and len(a) == 150
        same = spark.createDataFrame([(1, 1)] * 30, "a int, b int")
        assert slicing.skip(same, 10, "a").count() == 20 and slicing.skip(same.limit(0), 3, "a").count() == 0


def test_a_deep_skip_sorts_no_ties_in_one_task(spark):
    """All rows tie: their hashes deal them to ranges."""
    from pyspark.sql import functions as F

    from fleetlake.operators.slicing import _ties

    df = spark.range(40_000).select("id", F.lit(1).alias("g"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = [r[0] for r in df.orderBy("g", _ties(df)).select(F.spark_partition_id()).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) == 40_000 and max(tasks.count(t) for t in set(tasks)) < 10_000
