"""Best-fit packing planned on the histogram of lengths (operator 4).

Documents become token pieces of at most ``capacity`` tokens. Only the *counts* per
length (at most ``capacity`` numbers) reach the driver: there best-fit decreasing
runs over counts, so that bins with the same content are one line of the plan. The
plan gives, for each length, ranges of ranks and the sequence and offset of each
rank; its size depends on the capacity, not on the documents. Pieces then take the
planned slots by a join on length and rank within length.

Pieces of full length need no plan: each is a sequence by itself and is not shuffled. Ranks of the
others are dealt without a sort of a whole length: every piece has a number of its own, by a hash of
which the pieces of one length are spread over salts, as many as their count asks for; they are numbered
within (length, salt) and shifted by the counts of the salts before. So a length that holds a third of
all pieces is numbered by many tasks at any size, and so are pieces with equal or no ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import free_names, prepare, slices, written
from fleetlake.llm.tokens import VOCABULARY, encoder

CAPACITY = 1024
END_ID = 2
#: Salts of a length at least, and pieces to a salt of a length with more.
SALTS, PER_SALT = 64, 500_000


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    enc, end = encoder(vocabulary, "ids"), np.array([end_id], "<u4").tobytes()
    for batch in slices(batches, "text", 4 << 20):
        texts = [x or "" for x in batch.column(1).to_pylist()]
        rows, piece, start, ids = [], [], [], []
        for r, got in enumerate(enc.encode(texts)):
            got += end
            n = len(got) // 4
            head = n % capacity or min(n, capacity)
            cuts = [0, *range(head, n + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                rows.append(r)
                piece.append(k)
                start.append(a)
                ids.append(got[4 * a : 4 * b])
        length = pa.array([len(x) // 4 for x in ids], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), length, pa.array(ids, pa.binary())],
            names=["id", "piece", "start", "length", "ids"])


def token_pieces(docs: DataFrame, *, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids)``: every document's token ids followed by ``end_id``,
    little-endian 32-bit in ``ids``; one longer than ``capacity`` is cut into pieces of
    ``capacity``, the first of which may be shorter. A null text is empty: one piece that
    holds the end id alone."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(partial(_pieces, vocabulary=vocabulary, capacity=capacity, end_id=end_id),
                          f"id {kind}, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("id", id_col)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows ``(length, first rank, end rank, first sequence,
    offset)``. The pieces of a length with rank r in [first, end) go to sequence
    ``first sequence + r - first`` at ``offset``.

    Open bins are kept by remaining room; each entry ``(room) -> [(first, how many)]`` stands
    for consecutive sequences of one room. A length fills the tightest room it fits, whole
    entries at a time; what fits nowhere opens bins. Every step uses up an entry or the
    length's count, so steps are bounded by capacity and bins' sizes, not by the pieces.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = min((r for r in open_bins if r >= length), default=None)
            if room is None:
                if not 0 < length <= capacity:
                    raise ValueError(f"a piece of {length} does not fit {capacity}")
                per = capacity // length
                room = capacity
                open_bins[room] = [(sequences, -(-left // per))]
                sequences += open_bins[room][0][1]
                # per pieces to a bin: full bins first, then one with the rest
                first, many = open_bins.pop(room)[0]
                full, rest = divmod(left, per)
                for k in range(per):
                    n = full + (k < rest)
                    if n:
                        rows.append((length, rank, rank + n, first, k * length))
                        rank += n
                for used, start, n in ((per, first, full), (rest, first + full, many - full)):
                    if n and capacity - used * length:
                        open_bins.setdefault(capacity - used * length, []).append((start, n))
                left = 0
                break
            first, many = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
            n = min(left, many)
            rows.append((length, rank, rank + n, first, capacity - room))
            rank, left = rank + n, left - n
            if room > length:
                open_bins.setdefault(room - length, []).append((first, n))
            if many > n:
                open_bins.setdefault(room, []).append((first + n, many - n))
    return rows


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, salts: int = SALTS, per_salt: int = PER_SALT) -> DataFrame:
    """``pieces`` (with a column ``length`` in 1..capacity) and for each its ``sequence_id`` and
    ``offset``; sequences are gapless from offset 0. All columns of ``pieces`` are kept;
    those named ``sequence_id`` or ``offset`` are replaced. Rows may repeat: each has its
    own slot. An empty table gives an empty table."""
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    columns = [F.col(f"`{c}`") for c in pieces.columns]
    row, salt, many, n, before, rank, slot = free_names(pieces, "_row", "_salt", "_many", "_n", "_before", "_rank", "_slot")
    # tokenized once, numbered once: ranks must not move between jobs
    pieces = written(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    total = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity numbers
    total.pop(capacity, 0)
    lines = plan(total, capacity)
    planned = max((first + end - begin for _, begin, end, first, _ in lines), default=0)
    whole = pieces.where(F.col("length") == capacity).select(*columns, (F.col(row) + planned).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    spread = spark.createDataFrame([(k, max(salts, -(-v // per_salt))) for k, v in total.items()], f"length long, {many} long")
    salted = pieces.where(F.col("length") < capacity).join(F.broadcast(spread), "length").withColumn(salt, F.pmod(F.xxhash64(row), F.col(many)))
    of = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)  # a row per salt
    shift = salted.groupBy("length", salt).agg(F.count("*").alias(n)).select("length", salt, F.coalesce(F.sum(n).over(of), F.lit(0)).alias(before))
    # the join has the keys of the window, so the pieces are shuffled once
    ranked = salted.withColumn(rank, F.row_number().over(Window.partitionBy("length", salt).orderBy(row)).cast("long") - 1).join(shift, ["length", salt])
    ranked = ranked.withColumn(rank, F.col(rank) + F.col(before))
    # The plan has at most a few lines for each length and bin content: a few thousand rows.
    slots = spark.createDataFrame(lines, "s_length long, s_from long, s_to long, s_sequence long, s_offset long")
    slots = slots.select(F.struct("*").alias(slot))
    inside = (F.col("length") == F.col(f"{slot}.s_length")) & (F.col(rank) >= F.col(f"{slot}.s_from")) & (F.col(rank) < F.col(f"{slot}.s_to"))
    placed = ranked.join(F.broadcast(slots), inside)
    placed = placed.select(*columns, (F.col(f"{slot}.s_sequence") + F.col(rank) - F.col(f"{slot}.s_from")).alias("sequence_id"), F.col(f"{slot}.s_offset").alias("offset"))
    return placed.unionByName(whole)
