"""SimHash near-duplicates through pivot distance tables (operator 3).

Fingerprints of 64 bits are compared with many *reference fingerprints* once: a
fingerprint's row in the pivot table is its Hamming distance to each of them. By the
triangle inequality two fingerprints within ``most_bits`` of one another have pivot
distances that differ by at most ``most_bits`` in every coordinate, so a pair whose
largest coordinate difference is above that is discarded without comparing bits, and
what survives is verified bit by bit.

The references are zero and the masks of ``block_bits`` neighbouring bits. Of a
fingerprint x, d(x, 0) + block_bits - d(x, mask) is twice the ones that x has inside
the mask, and those *pivot counts* of two fingerprints within ``most_bits`` differ in
at most ``most_bits`` masks. So the masks are put into ``groups`` groups; in at least
``groups - most_bits`` of them all pivot counts agree. Each choice of that many groups
is a table whose key is a hash of their pivot counts: pairs that meet in no table are
discarded by their pivot distances and never formed, and no pair within
``most_bits`` is lost. Candidates of a cell are compared in blocks by numpy (largest
coordinate difference first, then the bits), and only links that join what the block
has not joined yet are given out: enough for the components, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.blocks import BLOCK, block_pairs, runs
from fleetlake.llm.common import connected_components, free_names, prepare, record, slices, utf8, written

SHINGLE = 3
MOST_BITS = 3
BLOCK_BITS = 2
GROUPS = 6
SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's UTF-8 bytes: A-Z lower-cased, words between ASCII white
    space, space-joined ``shingle``-word shingles with repeats (fewer words: all of them;
    none: 0), XXH64 with seed 42; a bit is one if over half the hashes have it."""
    words = text.lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for a in range(0, n, 1 << 15):  # long texts in bounded parts
        part = words[a : min(n, a + (1 << 15)) + shingle - 1]
        hashes = np.array([digest(b" ".join(x), SEED) for x in zip(*[part[i:] for i in range(shingle)], strict=False)]
                          or [digest(b" ".join(part), SEED)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        fps = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` for every row; a null text has no words."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle), f"id {docs.schema[id_col].dataType.simpleString()}, fp long").withColumnRenamed("id", id_col)


def references(block_bits: int = BLOCK_BITS) -> np.ndarray:
    """The reference fingerprints: zero, then the masks of ``block_bits`` neighbouring bits."""
    mask = (1 << block_bits) - 1
    return np.array([0, *[mask << s for s in range(0, 64, block_bits)]], dtype=np.uint64)


def pivot_table(fps: np.ndarray, block_bits: int = BLOCK_BITS) -> np.ndarray:
    """Hamming distances of fingerprints (rows) to the references (columns)."""
    return np.bitwise_count(fps[:, None] ^ references(block_bits)[None, :]).astype(np.int8)


def _tables(groups: int, most_bits: int) -> list[tuple[int, ...]]:
    return list(combinations(range(groups), groups - most_bits))


def _cells(batches: Iterator[pa.RecordBatch], block_bits: int, groups: int, most_bits: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("cell", pa.int64()), ("table", pa.int32()), ("fp", pa.int64())])
    rng = np.random.default_rng(20)
    factors = rng.integers(1, 1 << 62, size=64 // block_bits, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    owner = np.arange(64 // block_bits) % groups
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        d = pivot_table(fps, block_bits).astype(np.int64)
        counts = ((d[:, :1] + block_bits - d[:, 1:]) // 2).astype(np.uint64)
        of = [((counts + np.uint64(1)) * factors)[:, owner == g].sum(axis=1, dtype=np.uint64) for g in range(groups)]
        for t, chosen in enumerate(_tables(groups, most_bits)):
            key = np.zeros(len(fps), np.uint64)
            for g in chosen:
                key = (key ^ of[g]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            yield record(schema, key.view(np.int64), np.full(len(fps), t, np.int32), fps.view(np.int64))


def _links(batches: Iterator[pa.RecordBatch], block_bits: int, most_bits: int) -> Iterator[pa.RecordBatch]:
    """Links that span the components of each group of rows (table, cell, _i, _j)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in runs(batches, ["table", "cell", "_i", "_j"]):
        cols = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("table", "cell", "_i", "_j", "_side", "fp")]
        group = np.cumsum(np.concatenate([[0], np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)]))
        fps, side, between = cols[5].view(np.uint64), cols[4], cols[2] != cols[3]
        pivots = pivot_table(fps, block_bits)
        root, a_out, b_out = np.arange(len(fps)), [], []
        at = np.arange(len(fps))
        shift = 0
        while True:
            shift += 1  # compare every row with the one `shift` rows on, while that is in its group
            at = at[at + shift < len(fps)]
            at = at[group[at] == group[at + shift]]
            if not len(at):
                break
            x = at[(root[at] != root[at + shift]) & ~(between[at] & (side[at] == side[at + shift]))]
            y = x + shift
            near = np.abs(pivots[x, 0] - pivots[y, 0]) <= most_bits  # the discard by coordinates, one first
            x, y = x[near], y[near]
            near = np.abs(pivots[x] - pivots[y]).max(axis=1, initial=0) <= most_bits
            x, y = x[near], y[near]
            linked = np.bitwise_count(fps[x] ^ fps[y]) <= most_bits
            for i, j in zip(x[linked].tolist(), y[linked].tolist(), strict=True):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                while root[j] != j:
                    root[j] = root[root[j]]
                    j = root[j]
                if i != j:
                    root[max(i, j)] = min(i, j)
            took = x[linked]
            if len(took):
                a_out.append(fps[took].view(np.int64))
                b_out.append(fps[y[linked]].view(np.int64))
                while True:  # all rows point at their root again
                    up = root[root]
                    if np.array_equal(up, root):
                        break
                    root = up
        if a_out:
            yield record(schema, np.concatenate(a_out), np.concatenate(b_out))


def components(prints: DataFrame, *, most_bits: int = MOST_BITS, block_bits: int = BLOCK_BITS, groups: int = GROUPS,
               block: int = BLOCK) -> DataFrame:
    """``(fp, component)`` for distinct fingerprints of ``prints(id, fp)``: component is the
    smallest id whose fingerprint is reachable by links of at most ``most_bits`` bits. Exact:
    ``groups`` (more than ``most_bits``) sets only how selective the tables are; with more
    rows take more groups, which makes C(groups, most_bits) tables."""
    if groups <= most_bits:
        raise ValueError("groups must be more than most_bits")
    least = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    cells = least.select("fp").mapInArrow(partial(_cells, block_bits=block_bits, groups=groups, most_bits=most_bits),
                                          "cell long, table int, fp long")
    pairs = block_pairs(cells, ["cell", "table"], "fp", block)
    sort = ["table", "cell", "_i", "_j"]
    links = (pairs.repartition(*sort).sortWithinPartitions(*sort, "_side")
             .mapInArrow(partial(_links, block_bits=block_bits, most_bits=most_bits), "a long, b long"))
    member = connected_components(links)
    labelled = least.join(member, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    roots = labelled.groupBy("root").agg(F.min("least").alias("component"))
    return labelled.join(roots, "root").select("fp", "component")


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, most_bits: int = MOST_BITS, block_bits: int = BLOCK_BITS,
                    groups: int = GROUPS, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint, component_id, kept)`` for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest id reachable
    by links of at most ``most_bits`` differing bits; ``kept`` is true for that id. Texts
    that are null, empty or white space have fingerprint zero and link like any other.
    Rows that repeat an id each get a row; a row with a null id takes part in links, gets
    its component's smallest id (null if there is none) and is kept, as nothing names it
    as a copy. Other columns are not read. An empty table gives an empty table.
    """
    prints = fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col).withColumnRenamed(id_col, "id")
    prints = written(prints, "fingerprints")
    of = components(prints, most_bits=most_bits, block_bits=block_bits, groups=groups, block=block)
    out = prints.join(of.withColumnRenamed("fp", "fp_"), F.col("fp") == F.col("fp_"))
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) without near-duplicates: of each group the document with
    the smallest id stays (of several texts under that id one, of repeated rows one). Rows
    with a null id are told apart by their text and come after all ids: where a group has no id, one
    of them stays."""
    h = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    key = F.struct(docs[id_col].isNull().alias("n"), docs[id_col].alias("i"), h.alias("h"))
    prints = written(fingerprints(docs.select(key.alias("key"), docs[text_col].alias("text")), id_col="key", text_col="text")
                     .select(F.col("key").alias("id"), "fp"), "fingerprints")
    stay = components(prints, **options).select("component").distinct()
    rows = prints.groupBy("id").agg(F.count("*").alias("rows"))
    i, hash_, many = free_names(docs, "_i", "_h", "_many")
    # a plain side of the join, so that rows of a key that repeats often can be split
    stay = written(stay.join(rows, F.col("component") == F.col("id")).select(
        F.col("component.i").alias(i), F.col("component.h").alias(hash_), (F.col("rows") > 1).alias(many)), "stay")

    def found(which: DataFrame) -> DataFrame:
        return docs.join(which, docs[id_col].eqNullSafe(F.col(i)) & (h == F.col(hash_)))

    once, repeated = found(stay.where(~F.col(many))), found(stay.where(many)).dropDuplicates([i, hash_])
    return once.unionByName(repeated).drop(i, hash_, many)
