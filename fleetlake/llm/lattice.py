"""Embedding near-duplicates by lattice hashing (operator 1).

Each of several tables projects unit vectors by a random Gaussian matrix to 8
dimensions, shifts them at random and decodes them to the nearest point of the lattice
E8: the densest packing there, so near vectors mostly share a cell while others
spread over very many. A vector enters its own cell of each table and *probes* the
neighbouring cells nearest to it (of the 240 lattice points around). Vectors that meet
are verified by cosine in double precision.

Equal vectors are one class, compared once. Only members of cells in which an entry
and a probe meet are looked at further: entries and probes are dealt to blocks of
bounded size by a hash, and a task holds one pair of blocks at a time. A link is counted only
in the first table and cell in which its two vectors meet, so a task gives out how many
links each vector has in it and the links that span them. So no cell, however
full, is one task's work, and neither pairs nor all links leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.blocks import runs
from fleetlake.llm.common import connected_components, prepare, record, written

LEAST_COSINE = 0.98
TABLES = 6
PROBES = 12
#: Cells are finer with a larger scale (the unit sphere's radius in lattice units).
SCALE = 1.4
SEED = 7
BLOCK = 2048


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or all entries +-1/2 with an even
    number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 to each row: the better of the nearest in D8 (integers of even sum)
    and in D8 shifted by one half."""
    def d8(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
        if len(odd):  # round the coordinate with the largest error the other way
            err = y[odd] - near[odd]
            worst = np.abs(err).argmax(axis=1)
            at = (np.arange(len(odd)), worst)
            near[odd, worst] += np.where(err[at] >= 0, 1, -1)
        return near

    a, b = d8(x), d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


@lru_cache(maxsize=8)
def _projections(dim: int, tables: int, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((tables, dim, 8)) * scale, rng.uniform(0, 2, (tables, 8))


def _cell_hash(points: np.ndarray) -> np.ndarray:
    doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    h = np.zeros(points.shape[:-1], np.uint64)
    for k in range(8):
        h = (h ^ doubled[..., k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return h.view(np.int64)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Own cell (rows x tables) and probed neighbouring cells (rows x tables x probes) of unit vectors."""
    project, shift = _projections(unit.shape[1], tables, scale, seed)
    own, near = np.empty((len(unit), tables), np.int64), np.empty((len(unit), tables, probes), np.int64)
    roots = neighbours()
    for t in range(tables):
        x = unit @ project[t] + shift[t]
        point = decode(x)
        own[:, t] = _cell_hash(point)
        gain = (x - point) @ roots.T  # the neighbour with the largest product is the nearest
        best = np.argpartition(-gain, probes - 1, axis=1)[:, :probes] if probes < 240 else np.tile(np.arange(240), (len(unit), 1))
        near[:, t] = _cell_hash(point[:, None, :] + roots[best])
    return own, near


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _signed(batches: Iterator[pa.RecordBatch], tables: int, probes: int, scale: float, seed: int) -> Iterator[pa.RecordBatch]:
    """Classes with their own and probed cells; a cell's hash takes in the label and the dimension."""
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        dims = np.array([len(x) for x in batch.column(2)])
        own, near = np.empty((batch.num_rows, tables), np.int64), np.empty((batch.num_rows, tables, probes), np.int64)
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            v = _matrix(batch.column(2).take(pa.array(rows)), dim)
            mine, probed = cells(v / np.linalg.norm(v, axis=1, keepdims=True), tables, probes, scale, seed)
            mix = ((label[rows] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(int(dim) * 0xA0761D6478BD642F % (1 << 64))).view(np.int64)
            own[rows], near[rows] = mine ^ mix[:, None], probed ^ mix[:, None, None]
        lists = [pa.array(list(x.reshape(batch.num_rows, -1)), pa.list_(pa.int64())) for x in (own, near)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "own", "near"])


_ENTRY = pa.schema([("table", pa.int32()), ("cell", pa.int64()), ("node", pa.int64()), ("probe", pa.bool_())])


def _cells_of(column: pa.Array, rows: int, *shape: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, *shape)


def _entries(batches: Iterator[pa.RecordBatch], tables: int, probes: int) -> Iterator[pa.RecordBatch]:
    """Entries and probes of classes, each cell of a table once for a class."""
    for batch in batches:
        node, n = batch.column(0).to_numpy(), batch.num_rows
        own, near = _cells_of(batch.column(1), n, tables), np.sort(_cells_of(batch.column(2), n, tables, probes), axis=2)
        for t in range(tables):
            new = near[:, t] != own[:, t, None]
            new[:, 1:] &= near[:, t, 1:] != near[:, t, :-1]
            row, _ = np.nonzero(new)
            yield record(_ENTRY, np.full(n + len(row), t, np.int32), np.concatenate([own[:, t], near[:, t][new]]), np.concatenate([node, node[row]]),
                         np.arange(n + len(row)) >= n)


def _first_meeting(own1: np.ndarray, near1: np.ndarray, own2: np.ndarray, near2: np.ndarray, table: int, cell: int) -> np.ndarray:
    """Whether each pair of vectors meets in no earlier table, and in this table in no smaller cell."""
    out = np.flatnonzero(~(own1[:, :table] == own2[:, :table]).any(axis=1))
    for t in range(table, -1, -1):
        a, b = own1[out, t], own2[out, t]
        at_a = (a == b) | (near2[out, t] == a[:, None]).any(axis=1)
        at_b = (a == b) | (near1[out, t] == b[:, None]).any(axis=1)
        if t < table:
            out = out[~(at_a | at_b)]
        else:
            last = np.iinfo(np.int64).max
            out = out[np.minimum(np.where(at_a, a, last), np.where(at_b, b, last)) == cell]
    return out


def _spanning(a: np.ndarray, b: np.ndarray, many: int) -> np.ndarray:
    """Places of links that join what all links between ``many`` places join."""
    root, out, at = np.arange(many), [], np.arange(len(a))
    while True:
        r, s = root[a[at]], root[b[at]]
        at, high, low = at[r != s], np.maximum(r, s)[r != s], np.minimum(r, s)[r != s]
        if not len(at):
            return np.concatenate(out) if out else at
        high, first = np.unique(high, return_index=True)
        root[high] = low[first]  # each root under a smaller one
        out.append(at[first])
        while not np.array_equal(root[root], root):
            root = root[root]


PART, PAIRS = 256, 1 << 14


class _Block:
    """One block of a cell: the rows of one side of a group."""

    def __init__(self, batch: pa.RecordBatch, tables: int, probes: int):
        def column(c: str) -> pa.Array:
            return batch.column(batch.schema.get_field_index(c))

        self.node, self.label, self.size = [column(c).to_numpy(zero_copy_only=False) for c in ("node", "label", "size")]
        self.own, self.near = _cells_of(column("own"), batch.num_rows, tables), _cells_of(column("near"), batch.num_rows, tables, probes)
        self.vectors = column("embedding")
        self.dims = np.array([len(x) for x in self.vectors])


def _links(x: _Block, y: _Block, table: int, cell: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in two blocks (or in one, each pair once) of links that are first met in this cell."""
    found = []
    for dim in np.intersect1d(x.dims, y.dims):  # one, unless two cells' hashes collide
        mine, theirs = np.flatnonzero(x.dims == dim), np.flatnonzero(y.dims == dim)
        v = _matrix(x.vectors.take(pa.array(mine)), dim)
        vn = np.sqrt((v * v).sum(axis=1))
        for k in range(0, len(theirs), PART):
            part = theirs[k : k + PART]
            w = _matrix(y.vectors.take(pa.array(part)), dim)
            wn = np.sqrt((w * w).sum(axis=1))
            # norms are divided one by one, so that neither product over- nor underflows
            cosine = (v / vn[:, None]) @ (w / wn[:, None]).T
            all_i, all_j = np.nonzero(cosine >= least - 1e-9)
            for c in range(0, len(all_i), PAIRS):
                i, j = all_i[c : c + PAIRS], all_j[c : c + PAIRS]
                m, n = mine[i], part[j]
                ok = (x.label[m] == y.label[n]) & ((m < n) if x is y else (x.node[m] != y.node[n]))
                i, j, m, n = i[ok], j[ok], m[ok], n[ok]
                ok = cosine[i, j] >= least + 1e-9
                unsure = np.flatnonzero(~ok)
                p, q = v[i[unsure]], w[j[unsure]]
                ok[unsure] = (p * q).sum(axis=1) / (np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1))) >= least
                m, n = m[ok], n[ok]
                first = _first_meeting(x.own[m], x.near[m], y.own[n], y.near[n], table, cell)
                found.append(np.stack([m[first], n[first]]))
    both = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    return both[0], both[1]


def _verify(batches: Iterator[pa.RecordBatch], least: float, group: list[str], tables: int, probes: int) -> Iterator[pa.RecordBatch]:
    """For each group (table, cell, pair of blocks) the links that span its verified links ``(a, b, null)``
    and ``(a, null, rows that a links to there)``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("many", pa.int64())])
    held_key, held = None, None
    for batch in runs(batches, [*group, "side"]):
        cols = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in (*group, "side")]
        cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:], strict=False):
            key, block = tuple(c[s] for c in cols[:-1]), _Block(batch.slice(s, e - s), tables, probes)
            if not cols[-1][s]:
                held_key, held = key, block
                if key[2] != key[3]:
                    continue
            elif key != held_key:
                continue
            m, n = _links(held, block, int(key[0]), int(key[1]), least)
            if not len(m):
                continue
            more = 0 if block is held else len(held.node)
            node = held.node if block is held else np.concatenate([held.node, block.node])
            size = held.size if block is held else np.concatenate([held.size, block.size])
            n = n + more
            many = np.zeros(len(node), np.int64)
            np.add.at(many, m, size[n])
            np.add.at(many, n, size[m])
            span, some = _spanning(m, n, len(node)), np.flatnonzero(many)
            none = [pa.nulls(len(x), pa.int64()) for x in (span, some)]
            yield record(schema, node[m[span]], node[n[span]], none[0])
            yield record(schema, node[some], none[1], many[some])


def near_duplicates(vectors: DataFrame, *, least: float = LEAST_COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE,
                    seed: int = SEED, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows link when their labels are equal and not null, their vectors have the same length
    and their cosine is at least ``least``. Vectors that are null, empty or zero, or hold
    null or non-finite components, link with nothing, nor do rows with a null label or
    id. ``n_links`` counts the other rows linked directly (rows that repeat an id and
    vector count as others); ``component_id`` is the smallest id reachable, itself
    included; ``kept`` tells whether that is the row's own id (a row with a null id is
    kept). Other columns are not read; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.expr(
        "exists(embedding, x -> x <> 0) and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"), F.lit(False))
    rows = rows.withColumn("good", good)
    classes = rows.where("good").groupBy("label", "embedding").agg(F.min("id").alias("node"), F.count("*").alias("size"))
    # ids may repeat, so a class is named by a hash of its label and vector
    classes = classes.select(F.xxhash64("label", "embedding").alias("class"), "label", "embedding", "node", "size")
    classes = written(classes.mapInArrow(partial(_signed, tables=tables, probes=probes, scale=scale, seed=seed),
                                         "class long, label long, embedding array<double>, node long, size long, own array<long>, near array<long>"), "classes")
    entries = classes.select("class", "own", "near").mapInArrow(partial(_entries, tables=tables, probes=probes), "table int, cell long, node long, probe boolean")
    entries = written(entries, "entries")
    # cells where an entry meets another member, and the blocks of their entries and probes
    own = F.count(F.when(~F.col("probe"), 1))
    met = entries.groupBy("table", "cell").agg(own.alias("own"), F.count("*").alias("all")).where("own > 0 and all > 1")
    met = met.select(F.col("table").alias("t_"), F.col("cell").alias("c_"), F.ceil(F.col("own") / block).cast("int").alias("e_"),
                     F.ceil((F.col("all") - F.col("own")) / block).cast("int").alias("p_"))
    live = entries.join(met, (F.col("table") == F.col("t_")) & (F.col("cell") == F.col("c_"))).drop("t_", "c_")
    # a group (i, k) compares the entries of block i with those of block k >= i, or with probes: the first
    # block of probes joins the group (i, i), block j > 0 is k = e_ + j
    dealt = live.withColumn("mine", F.pmod(F.xxhash64("node"), F.when(F.col("probe"), F.col("p_")).otherwise(F.col("e_"))).cast("int"))
    entry = dealt.where("not probe").withColumn("other", F.explode(F.expr(
        "concat(sequence(0, e_ - 1), if(p_ > 1, sequence(e_ + 1, e_ + p_ - 1), cast(array() as array<int>)))")))
    entry = entry.select("table", "cell", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("k"),
                         F.expr("cast(mine > other as int)").alias("side"), F.col("node").alias("n_"))
    probe = dealt.where("probe").withColumn("i", F.explode(F.expr("sequence(0, e_ - 1)")))
    probe = probe.select("table", "cell", "i", F.expr("if(mine = 0, i, e_ + mine)").alias("k"), F.lit(1).alias("side"), F.col("node").alias("n_"))
    group = ["table", "cell", "i", "k"]
    keyed = classes.select(F.col("class").alias("node"), "label", "embedding", "size", "own", "near")
    looked = entry.unionByName(probe).join(keyed, F.col("n_") == F.col("node")).drop("n_")
    found = (looked.repartition(*group).sortWithinPartitions(*group, "side")
             .mapInArrow(partial(_verify, least=least, group=group, tables=tables, probes=probes), "a long, b long, many long"))
    found = written(found, "links")
    links = found.where("b is not null").select("a", "b")
    linked = found.where("b is null").groupBy("a").agg(F.sum("many").alias("others"))
    parts = connected_components(links).withColumnRenamed("node", "node_")
    known = classes.join(linked, F.col("class") == F.col("a"), "left").join(parts, F.col("class") == F.col("node_"), "left")
    known = known.select("label", "embedding", "node", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "class").alias("root"))
    least_id = known.groupBy("root").agg(F.min("node").alias("component_id"))
    known = known.join(least_id, "root").select(F.col("label").alias("l_"), F.col("embedding").alias("e_"), "n_links", "component_id")
    out = rows.join(known, F.col("good") & (F.col("label") == F.col("l_")) & (F.col("embedding") == F.col("e_")), "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
