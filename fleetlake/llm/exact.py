"""Exact duplicates by a 128-bit content hash, bytes compared inside groups (operator 11).

Texts are equal when they are identical without ASCII white space. Rows are grouped by
the MD5 of what is left: only ids, lengths and digests are shuffled. Groups are then
checked: texts are reduced to the distinct ones per hash, by bytes, each map task first by
itself, so that a group of any size reaches the shuffle as one row a task; every distinct text is
shuffled once, whatever the size of the table (looking up groups first would do without most of them only as
long as the list of groups can be broadcast). A hash that has two or more texts is a collision; its rows
are grouped by the text itself.

Group tables are written before rows look them up: both sides of that join are plain tables,
so Spark broadcasts a small one and splits the rows of a hot group otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import written

#: ASCII white space, one character each.
WHITE = " \t\n\x0b\x0c\r"


def bare(text: Column) -> Column:
    """``text`` without ASCII white space."""
    return F.translate(text, WHITE, "")


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def _groups(rows: DataFrame, on: list[str]) -> DataFrame:
    """Groups of two or more rows with equal ``on``: their size and the row that stays."""
    stays = F.min(F.struct(-F.col("_points"), F.col("_id").isNull(), "_id", "_row"))  # most code points, then the smallest id, then one row
    groups = rows.groupBy(*on).agg(F.count("*").alias("_n"), stays.alias("_stays")).where("_n > 1")
    return groups.select(*[F.col(c).alias(f"{c}_of") for c in on], "_n", F.col("_stays._id").alias("_keep_id"), F.col("_stays._row").alias("_keep_row"))


def _judged(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    alone = F.col("_n").isNull()
    joined = rows.join(groups, [F.col(c) == F.col(f"{c}_of") for c in on], "left")
    return joined.select(*[c for c in rows.columns if c.startswith("_k")], "_id", F.when(alone, F.col("_id")).otherwise(F.col("_keep_id")).alias("_keep_id"),
                         F.coalesce("_n", F.lit(1)).alias("_n"), (alone | (F.col("_row") == F.col("_keep_row"))).alias("_kept"), F.lower(F.hex("_sha")).alias("_sha"))


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                     digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """For every row of ``docs``: the id, the columns named in ``keep``, ``keep_id`` (the id of the row
    that stays of its group), ``group_size``, ``kept`` and ``text_sha256`` (of the text without white
    space, lower-case hex).

    Of equal texts the row with the most code points in the original text stays, then the one
    with the smallest id, null ids last; of rows that repeat id and length one stays, any of them. A null
    text is empty; texts without a visible character are one group. Names of ``keep`` cannot
    clash with this function's; columns not named are not read. An empty table gives an empty table.
    ``digest`` is the content hash; a weak one gives the same groups, more slowly.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = [F.col(id_col).alias("_id"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]]
    source = docs.select(*columns, F.length(text).alias("_points"), bare(text).alias("_bare")).withColumn("_hash", digest(F.col("_bare")))
    numbered = source.withColumn("_sha", F.unhex(F.sha2("_bare", 256))).withColumn("_row", F.monotonically_increasing_id())
    rows = written(numbered.drop("_bare"), "digests")
    groups = written(_groups(rows, ["_hash"]), "groups")

    texts = source.select("_hash", "_bare").distinct()  # compared by bytes, first within a map task
    several = written(texts.groupBy("_hash").agg(F.count("*").alias("_texts")).where("_texts > 1").select(F.col("_hash").alias("_hash_of")), "collisions")
    if several.isEmpty():
        out = _judged(rows, groups, ["_hash"])
    else:
        out = _judged(rows.join(several, F.col("_hash") == F.col("_hash_of"), "left_anti"), groups, ["_hash"])
        told = written(numbered.join(several, F.col("_hash") == F.col("_hash_of"), "left_semi"), "collided")
        out = out.unionByName(_judged(told, written(_groups(told, ["_hash", "_bare"]), "groups"), ["_hash", "_bare"]))
    return out.select(F.col("_id").alias(id_col), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_keep_id").alias("keep_id"),
                      F.col("_n").alias("group_size"), F.col("_kept").alias("kept"), F.col("_sha").alias("text_sha256"))
