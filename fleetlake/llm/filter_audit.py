"""How filters interact, by relations of failing ids (operator 13).

Every filter has one stored table: the rows that fail it, with the part they belong to and what is
known of them from labels. Prefixes are walked as sets, for what a filter removes after
others does not depend on their order: 80 pairs of a set and a next filter for five
filters, not 600 steps. The filters are taken one after the other; by each filter g, the rows that
fail another filter f and are left after a set without g are joined with g's table:

* left-semi: they were removed by g, so they are redundant for f after the set with g;
* left-anti: they are what f still removes after the set with g, and are stored for the next filters.

What f removes after all the others fails it alone, and what survives a prefix is what no filter of
it has removed; rows that fail no filter are only counted. Tables are bucketed by row number, so
no join of the audit shuffles, and the counts meet in one small aggregate.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, slices, utf8, written
from fleetlake.session import ensure_checkpoint_dir

#: Rows of a bucket of a failing-id table, on the average, and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 500_000, 8
_UPPER, _MARKS = bytes(range(65, 91)), b"#$%&*|"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.bool_()] * 4 + [pa.binary()]
    for batch in slices(batches, "text"):
        out = [[] for _ in kinds]
        for text in utf8(batch.column(batch.num_columns - 1)):
            words = text.split()
            caps = len(text) - len(text.translate(None, _UPPER))
            points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
            values = (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * caps > 10 * points,
                      len(text.translate(None, _MARKS)) < len(text), hashlib.blake2b(text, digest_size=32).digest())
            for column, v in zip(out, values, strict=True):
                column.append(v)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]],
                                         names=["id", "part", "A", "B", "C", "D", "digest"])


def text_failures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``(id, part, A, B, C, D, E)`` of every row of ``docs``, the letters true where the row fails the filter:

    A: under 100 words; B: under 80 distinct words of 100; C: over 10 of 100 code points are
    ``[A-Z]``; D: one of ``#$%&*|``; E: the text of a row with a smaller id, removed or not. Words
    stand between ASCII white space. A null text is empty, a null part the empty string. A null id is no
    smaller than any and has none smaller, so such rows neither fail E nor make others fail it;
    rows that repeat an id do not fail E by one another. Texts are compared by a 256-bit digest.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))
    rows = written(rows.mapInArrow(_measured, f"id {kind}, part string, A boolean, B boolean, C boolean, D boolean, digest binary"), "measured")
    several = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    several = written(several.select(F.col("digest").alias("digest_"), "least"), "least")  # a plain side: a hot digest's rows can be split
    found = rows.join(several, F.col("digest") == F.col("digest_"), "left")
    return found.select("id", "part", "A", "B", "C", "D", F.coalesce(F.col("id") > F.col("least"), F.lit(False)).alias("E"))


def _stored(df: DataFrame, name: str, buckets: int, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in the shared folder, in buckets by ``row``, in one folder for each value of ``by``."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    df.write.partitionBy(*by).bucketBy(buckets, "row").option("path", path).saveAsTable(table, format="parquet")
    return spark.table(table)


def audit(rows: DataFrame, labels: DataFrame | None = None, *, filters: str = "ABCDE", id_col: str = "id", part_col: str = "part",
          label_id: str = "doc_id") -> DataFrame:
    """What each filter of each order of ``filters`` does to ``rows``, which has a boolean column for each
    filter's letter (true: fails; null: passes). One row per part (``part``: each value of
    ``part_col``, null as the empty string), ``filter_order`` and ``step`` (from 1), with zeros:

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fail its filter, removed before),
    ``unique_fails`` (fail its filter only), ``good_lost`` and ``toxic_lost`` (removed here, with ``quality`` = 1 and
    ``toxic`` = 1 in ``labels(doc_id, quality, toxic)``), ``shapley`` (what its filter removes, summed over all orders).

    Rows with a null id have no labels; rows that repeat an id all have its labels; of several labels of an id
    the greatest counts. Null labels are zero. Other columns are not read. Without rows there are no parts.
    The orders are n!, so ``filters`` should be few (at most seven).
    """
    if not 1 <= len(filters) <= 7 or len(set(filters)) < len(filters):
        raise ValueError("filters: one to seven different letters")
    spark, n = rows.sparkSession, len(filters)
    known = rows.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        *[F.coalesce(F.col(f), F.lit(False)).alias(f"fails{i}") for i, f in enumerate(filters)])
    if labels is None:
        known = known.withColumn("good", F.lit(0)).withColumn("toxic", F.lit(0))
    else:
        one = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("id_")).agg(
            *[F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(t) for c, t in (("quality", "good"), ("toxic", "toxic"))])
        one = written(one, "labels")  # a plain side: rows that repeat an id can be split
        known = known.join(one, F.col("id") == F.col("id_"), "left").drop("id_").fillna(0, ["good", "toxic"])
    known = written(known.drop("id").withColumn("row", F.monotonically_increasing_id()), "rows")
    buckets = max(LEAST_BUCKETS, -(-known.count() // BUCKET_ROWS))
    failing = F.filter(F.array(*[F.when(F.col(f"fails{i}"), F.lit(i)) for i in range(n)]), lambda x: x.isNotNull())
    fails = known.select("row", "part", "good", "toxic", F.explode(failing).alias("f")).repartition(buckets, "row")
    fails = _stored(fails, "fails", buckets, ("f",)).withColumn("mask", F.lit(0))

    def joined(g: int, before: list[DataFrame], how: str) -> DataFrame:
        table = fails.where(F.col("f") == g).select("row").hint("shuffle_hash")  # one bucket at a time in memory
        out = reduce(DataFrame.unionByName, [rows.where(F.col("f") != g).join(table, "row", how) for rows in before])
        return out.select("row", "part", "good", "toxic", "f", (F.col("mask") + F.lit(1 << g)).alias("mask"))

    left, redundant = [fails], []  # what is left after sets of the filters so far, by the last of the set
    for g in range(n):
        redundant.append(joined(g, left, "left_semi"))
        left.append(joined(g, left, "left_anti"))
        if g < n - 1:
            left[-1] = _stored(left[-1], "left", buckets)

    def counted(tables: list[DataFrame], semi: bool) -> DataFrame:
        return reduce(DataFrame.unionByName, tables).select("part", "f", "mask", "good", "toxic", F.lit(semi).alias("semi"))

    counts = counted(left, False).unionByName(counted(redundant, True)).groupBy("part", "f", "mask", "semi").agg(
        F.count("*").alias("rows"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    counts = written(counts, "counts")  # a few hundred rows a part

    parts = known.groupBy("part").agg(F.count("*").alias("total"))
    steps, later, ways = [], [], []
    for order in permutations(range(n)):
        mask = 0
        for k, f in enumerate(order):
            steps.append(("".join(filters[g] for g in order), k + 1, f, mask))
            mask |= 1 << f
    for f in range(n):
        for mask in range(1 << n):
            if not mask >> f & 1:
                later += [(f, mask & (2 << g) - 1, mask) for g in range(n) if mask >> g & 1]  # the first tables of the prefix, one more each time
                ways.append((f, mask))
    steps = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, f int, mask int"))  # n! * n rows, whatever the data
    later = F.broadcast(spark.createDataFrame(later or [(-1, -1, -1)], "f int, mask int, whole int"))
    # every part, filter and prefix set has a row, zeros included
    zeros = parts.select("part", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(m).alias("mask")) for f, m in ways])).alias("s")).select("part", "s.*")
    removed = zeros.join(counts.where("not semi").drop("semi"), ["part", "f", "mask"], "left").fillna(0, ["rows", "good", "toxic"])
    redundant = counts.where("semi").select("part", "f", "mask", "rows").join(later, ["f", "mask"]).groupBy("part", "f", F.col("whole").alias("mask")).agg(
        F.sum("rows").alias("redundant"))
    alone = removed.where(F.expr(f"mask = {(1 << n) - 1} - shiftleft(1, f)")).select("part", "f", F.col("rows").alias("unique_fails"))
    each = removed.join(redundant, ["part", "f", "mask"], "left").join(alone, ["part", "f"]).join(parts, "part").join(steps, ["f", "mask"])
    each = each.withColumn("redundant", F.coalesce("redundant", F.lit(0)))
    each = each.withColumn("gone", F.expr("sum(rows) over (partition by part, filter_order order by step rows unbounded preceding)"))
    each = each.withColumn("shapley", F.expr("sum(rows) over (partition by part, f)"))
    return each.select("part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("rows").alias("removed"), "redundant", "unique_fails",
                       F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
