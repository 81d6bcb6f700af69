"""Repeated passages by suffix sorting: deep-shallow (operator 5).

A byte is removed when a string of ``span`` bytes that covers it also starts
elsewhere, in the same document or another. Texts are UTF-8 bytes; a match never
crosses documents.

*Which suffixes are sorted.* Sorting every suffix of the corpus would shuffle each
byte hundreds of times. So every document marks *anchors*: for each window of
``span // 2`` starting places the one with the least hash of its next 8 bytes (the
leftmost of equals). Equal strings of ``span`` bytes have an anchor at the same place
inside, so only anchors' suffixes need to be compared: to the right up to ``span``
bytes, to the left (the reversed prefix) up to ``span // 2 - 1``. Anchors whose first
``span - span // 2 + 1`` bytes occur once in the corpus cannot be part of a repeat and go
no further; equal contexts are counted and sorted once.

*How they are sorted.* Groups that share those first bytes are ordered by
``deep_shallow``: multikey quicksort over 8-byte characters down to a shallow depth,
then a blind trie (it stores branching bytes only, and compares whole text once per
insertion) orders each group that still agrees. From the two orders with their
longest common prefixes it follows which strings of ``span`` bytes around an anchor,
at each offset, occur twice: those whose left parts are neighbours with a common prefix
of at least the offset and whose right parts with one of at least the rest.

A group of more than ``most_sorted`` different contexts (the edges of a passage that a
large part of the corpus shares) would be one task's work; there every string of
``span`` bytes is counted by digest instead, in Spark, with partial sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.blocks import runs
from fleetlake.llm.common import prepare, record, slices, utf8, written

SPAN = 400
SHALLOW = 32
CHARACTER = 8
MOST_SORTED = 20_000
_CHUNK = 1 << 20
#: Cells of a class matrix (an int64 each, eight at once), and bytes of unpacked rows that leave a task together.
_CELLS, _OUT_BYTES = 500_000, 4 << 20


def lcp(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix; the first ``start`` bytes are known to be equal."""
    n = min(len(a), len(b))
    x, y = a[start:n], b[start:n]
    if x == y:
        return n
    diff = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return start + (8 * len(x) - diff.bit_length()) // 8


class _Trie:
    """Blind trie over strings that agree up to ``depth``: inner nodes hold a depth and
    children by the byte there (-1: the string ends); leaves hold the items of one string."""

    def __init__(self, strings: list[bytes], depth: int):
        self.strings, self.depth, self.root = strings, depth, None

    def _byte(self, s: bytes, d: int) -> int:
        return s[d] if d < len(s) else -1

    def insert(self, item: int) -> None:
        s = self.strings[item]
        if self.root is None:
            self.root = [item]
            return
        node, path = self.root, []
        while isinstance(node, tuple):  # blind: only the branching bytes are looked at
            path.append(node)
            d, children = node
            node = children.get(self._byte(s, d)) or next(iter(children.values()))
        t = self.strings[node[0]]
        common = lcp(s, t, self.depth)
        if common == len(s) == len(t):
            node.append(item)
            return
        parent, key, node = None, None, self.root
        for step in path:  # down to the edge that holds the common depth
            if step[0] >= common:
                break
            parent, key = step, self._byte(s, step[0])
            node = step[1].get(key)
        if isinstance(node, tuple) and node[0] == common:
            node[1][self._byte(s, common)] = [item]
        elif node is None:
            parent[1][key] = [item]
        else:
            branch = (common, {self._byte(t, common): node, self._byte(s, common): [item]})
            if parent is None:
                self.root = branch
            else:
                parent[1][key] = branch

    def items(self) -> Iterator[int]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                yield from node


def deep_shallow(strings: list[bytes], known: int = 0, shallow: int = SHALLOW) -> tuple[list[int], np.ndarray]:
    """Order of ``strings`` that agree in the first ``known`` bytes, and for each place in
    the order the longest common prefix with the one before (0 at the first)."""
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), known)]
    while stack:
        group, depth = stack.pop()
        if len(group) <= 1 or depth < 0:
            out += group
        elif depth - known >= shallow:  # deep: they agree so far, and perhaps much further
            trie = _Trie(strings, depth)
            for i in group:
                trie.insert(i)
            out += trie.items()
        else:
            chars = [strings[i][depth : depth + CHARACTER] for i in group]
            some = sorted(chars[:: 1 + len(chars) // 9])
            pivot = some[len(some) // 2]
            stack.append(([i for i, c in zip(group, chars, strict=True) if c > pivot], depth))
            same = [i for i, c in zip(group, chars, strict=True) if c == pivot]
            stack.append((same, depth + CHARACTER if len(pivot) == CHARACTER else -1))  # -1: equal to their ends
            stack.append(([i for i, c in zip(group, chars, strict=True) if c < pivot], depth))
    common = np.zeros(len(out), dtype=np.int64)
    for k in range(1, len(out)):
        common[k] = lcp(strings[out[k - 1]], strings[out[k]], known)
    return out, common


def repeats(lefts: list[bytes], rights: list[bytes], counts: list[int], span: int = SPAN, known: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For anchors with reversed left contexts, right contexts and how often each context
    occurs: the least and the largest offset (bytes before the anchor) at which the
    string of ``span`` bytes occurs twice or more; -1 where none does."""
    n = len(rights)
    low = np.array([max(0, span - len(r)) for r in rights])
    high = np.array([len(x) for x in lefts])
    whole = (np.array(counts) > 1) & (low <= high)
    lowest, highest = np.where(whole, low, -1), np.where(whole, high, -1)
    if n == 1 or whole.all():
        return lowest, highest
    right_order, right_common = deep_shallow(rights, known)
    left_order, left_common = deep_shallow(lefts)
    first, last = max(0, span - int(right_common.max())), int(left_common.max())
    if first > last:
        return lowest, highest
    step = max(1, _CELLS // n)
    for a in range(first, last + 1, step):
        offsets = np.arange(a, min(a + step, last + 1))[:, None]
        right_class, left_class = (np.empty((len(offsets), n), np.int64) for _ in "rl")
        right_class[:, right_order] = np.cumsum(right_common[None, :] < span - offsets, axis=1)
        left_class[:, left_order] = np.cumsum(left_common[None, :] < offsets, axis=1)
        key = left_class * (n + 1) + right_class
        order = np.argsort(key, axis=1, kind="stable")
        ranked = np.take_along_axis(key, order, axis=1)
        same = ranked[:, 1:] == ranked[:, :-1]
        twice = np.zeros(key.shape, bool)
        twice[:, 1:] |= same
        twice[:, :-1] |= same
        found = np.empty_like(twice)
        np.put_along_axis(found, order, twice, axis=1)
        # a class of one offset may hold contexts too short for it: they are alone there by their common prefixes
        any_found = found.any(axis=0) & ~whole
        low_here = offsets[found.argmax(axis=0), 0]
        high_here = offsets[len(offsets) - 1 - found[::-1].argmax(axis=0), 0]
        lowest = np.where(any_found & (lowest < 0), low_here, lowest)
        highest = np.where(any_found, high_here, highest)
    return lowest, highest


def anchors(text: bytes, span: int = SPAN) -> np.ndarray:
    """Places of the anchors of a text: for each window of ``span // 2`` places at which
    a string of ``span`` bytes can have its anchor, the leftmost with the least hash."""
    width, n = span // 2, len(text)
    starts = n - span + 1
    if starts <= 0:
        return np.empty(0, np.int64)
    places = []
    for a in range(0, starts, _CHUNK):  # long texts in overlapping parts
        many = min(_CHUNK, starts - a)
        part = np.frombuffer(text, np.uint8, count=many + width - 1 + 7, offset=a).astype(np.uint64)
        x = part[:-1] | (part[1:] << np.uint64(8))
        x = x[:-2] | (x[2:] << np.uint64(16))
        x = x[:-4] | (x[4:] << np.uint64(32))
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x &= np.uint64(~((1 << 24) - 1) & (1 << 64) - 1)
        x |= np.arange(len(x), dtype=np.uint64)  # of equal hashes the leftmost
        size = 1
        while size * 2 <= width:
            x = np.minimum(x[:-size], x[size:])
            size *= 2
        if size < width:
            x = np.minimum(x[: size - width], x[width - size :])
        at = (x & np.uint64((1 << 24) - 1)).astype(np.int64) + a
        places.append(at[np.concatenate([[True], at[1:] != at[:-1]])])
    return places[0] if len(places) == 1 else np.unique(np.concatenate(places))


def _anchor_rows(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    width, digest = span // 2, xxhash.xxh3_64_intdigest
    for batch in slices(batches, "text", 2 << 20):
        rows, key, context, pos = [], [], [], []
        for r, text in enumerate(utf8(batch.column(2))):
            at = anchors(text, span)
            for a in at.tolist():
                left = min(a, width - 1)
                key.append(digest(text[a : a + span - width + 1]))
                context.append(digest(text[a - left : a + span], left))
            rows.append(np.full(len(at), r))
            pos.append(at)
        if key:
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.array(key, np.uint64).view(np.int64)),
                 pa.array(np.array(context, np.uint64).view(np.int64)), pa.array(np.concatenate(pos))],
                names=["id", "h", "key", "context", "pos"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, as compressed bytes in ``packed``: texts are shuffled twice."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        n = batch.num_columns - 1
        yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array([pack(t) for t in utf8(batch.column(n))], pa.binary())],
                                         names=[*batch.schema.names[:n], "packed"])


def _pack(df: DataFrame) -> DataFrame:
    """``df`` whose last column is ``text``, with ``packed`` in its place."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema[:-1])
    return df.mapInArrow(_packed, f"{fields}, packed binary")


_CONTEXT = pa.schema([("key", pa.int64()), ("context", pa.int64()), ("n", pa.int64()), ("big", pa.bool_()), ("lhs", pa.binary()), ("rhs", pa.binary())])


def _contexts(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    width, unpack = span // 2, zstandard.ZstdDecompressor().decompress
    for batch in slices(batches, "packed", 1 << 20):
        out: list[list] = [[] for _ in _CONTEXT]
        size = 0  # of unpacked contexts: a text that repeats itself is far longer than its packed form
        for text, wanted in zip(map(unpack, utf8(batch.column(0))), batch.column(1).to_pylist(), strict=True):
            for w in wanted:
                a = w["pos"]
                for column, v in zip(out, (w["key"], w["context"], w["n"], w["big"], text[max(0, a - width + 1) : a][::-1], text[a : a + span]), strict=True):
                    column.append(v)
                size += width + span
                if size > _OUT_BYTES:
                    yield record(_CONTEXT, *out)
                    out, size = [[] for _ in _CONTEXT], 0
        if out[0]:
            yield record(_CONTEXT, *out)


_FOUND = pa.schema([("key", pa.int64()), ("context", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])


def _sorted_repeats(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    known = span - span // 2 + 1
    for batch in runs(batches, ["key"]):
        key, context = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (context[1:] != context[:-1])])
        if not once.all():  # looked up in two rows of the same id and text
            batch = batch.filter(pa.array(once))
            key, context = key[once], context[once]
        counts, lefts, rights = batch.column(2).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist()
        low, high = np.full(len(key), -1, np.int32), np.full(len(key), -1, np.int32)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            agree = len({r[:known] for r in rights[a:b]}) == 1  # always, unless two keys collide
            low[a:b], high[a:b] = repeats(lefts[a:b], rights[a:b], counts[a:b], span, known if agree else 0)
        at = high >= 0
        if at.any():
            yield record(_FOUND, key[at], context[at], low[at], high[at])


def repeated_spans(docs: DataFrame, *, span: int = SPAN, most_sorted: int = MOST_SORTED) -> DataFrame:
    """``(id, h, spans)`` of ``docs(id, h, text)`` that hold repeats: maximal runs of bytes
    covered by strings of ``span`` bytes that start twice or more."""
    prepare(docs.sparkSession)
    kind = docs.schema["id"].dataType.simpleString()
    found = written(docs.select("id", "h", "text").mapInArrow(
        partial(_anchor_rows, span=span), f"id {kind}, h long, key long, context long, pos long"), "anchors")
    often = found.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("key").alias("key_"))
    often = written(often, "often")  # a plain side, so that a hot key's rows can be split in the join
    found = written(found.join(often, F.col("key") == F.col("key_")).drop("key_"), "anchors")
    # one place of every context, and how often it occurs; groups too large for one sort are marked
    places = found.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(F.struct("id", "h", "pos")).alias("at"))
    places = written(places, "contexts")
    large = places.groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > most_sorted).select(F.col("key").alias("key_"), F.lit(True).alias("_big"))
    large = written(large, "large")
    places = places.join(large, F.col("key") == F.col("key_"), "left")
    wanted = places.groupBy("at.id", "at.h").agg(F.collect_list(F.struct(
        "at.pos", "key", "context", "n", F.coalesce("_big", F.lit(False)).alias("big"))).alias("wanted"))
    # Rows that repeat id and text are one text to look in.
    texts = _pack(docs.select("id", "h", "text")).join(wanted.select(F.col("id").alias("id_"), F.col("h").alias("h_"), "wanted"),
                      F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_")))
    contexts = texts.select("packed", "wanted").mapInArrow(
        partial(_contexts, span=span), "key long, context long, n long, big boolean, lhs binary, rhs binary")
    contexts = written(contexts, "contexts")
    small = contexts.where("not big").repartition("key").sortWithinPartitions("key", "context").mapInArrow(
        partial(_sorted_repeats, span=span), "key long, context long, low int, high int")
    marks = small.unionByName(_counted_repeats(contexts.where("big").dropDuplicates(["key", "context"]), span))
    marks = marks.groupBy("key", "context").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    marks = written(marks.select(F.col("key").alias("key_"), F.col("context").alias("context_"), "low", "high"), "marks")  # a plain side, as above
    covered = found.join(marks, (F.col("key") == F.col("key_")) & (F.col("context") == F.col("context_"))).select(
        "id", "h", (F.col("pos") - F.col("high")).alias("a"), (F.col("pos") - F.col("low") + span).alias("b")).distinct()  # rows that repeat id and text: once
    w = Window.partitionBy("id", "h").orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs_ = covered.withColumn("_new", F.coalesce((F.col("a") > reach).cast("int"), F.lit(1)))
    runs_ = runs_.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs_ = runs_.groupBy("id", "h", "_run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return runs_.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))


def _counted_repeats(contexts: DataFrame, span: int) -> DataFrame:
    """The same marks for groups too large to sort: every string of ``span`` bytes around the
    anchor is counted by its digest."""
    each = contexts.select("key", "context", "n", "lhs", "rhs", F.explode(F.expr(
        f"if(length(lhs) >= greatest(0, {span} - length(rhs)), sequence(greatest(0, {span} - length(rhs)), length(lhs)), array())")).alias("o"))
    # lhs is reversed, so the string is told apart by its reversed left part and its right part
    each = each.select("key", "context", "n", "o", F.md5(F.concat(
        F.expr("substring(lhs, 1, o)"), F.expr(f"substring(rhs, 1, {span} - o)"))).alias("digest"))
    twice = each.groupBy("key", "o", "digest").agg(F.sum("n").alias("_n")).where("_n > 1")
    twice = twice.select(F.col("key").alias("k_"), F.col("o").alias("o_"), F.col("digest").alias("d_"))
    both = each.join(twice, (F.col("key") == F.col("k_")) & (F.col("o") == F.col("o_")) & (F.col("digest") == F.col("d_")))
    return both.groupBy("key", "context").agg(F.min("o").cast("int").alias("low"), F.max("o").cast("int").alias("high"))


_COUNTS = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]


def _cut(batches: Iterator[pa.RecordBatch], as_text: bool, least_words: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([*_COUNTS, ("text", pa.string()) if as_text else ("kept", pa.binary())])
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches, "packed", 2 << 20):
        n = batch.num_columns
        names = pa.schema([*list(batch.schema)[: n - 2], *schema])
        out: list[list] = [[] for _ in schema]
        first = size = 0
        for row, (packed, spans) in enumerate(zip(utf8(batch.column(n - 2)), batch.column(n - 1).to_pylist(), strict=True)):
            text = unpack(packed)
            spans = [(s["a"], s["b"]) for s in spans or () if not least_words or len(text[s["a"] : s["b"]].split()) >= least_words]
            at, parts = 0, []
            for a, b in spans:
                parts.append(text[at:a])
                at = b
            parts.append(text[at:])
            rest = b"".join(parts)
            for column, v in zip(out, (len(text), len(text) - len(rest), len(spans), rest.decode("utf-8", "ignore") if as_text else rest), strict=True):
                column.append(v)
            size += len(rest)
            if size > _OUT_BYTES or row == batch.num_rows - 1:  # a text that repeats itself is far longer than its packed form
                part = batch.slice(first, row + 1 - first)
                yield pa.RecordBatch.from_arrays([*part.columns[: n - 2], *[pa.array(c, f.type) for c, f in zip(out, schema, strict=True)]], schema=names)
                out, first, size = [[] for _ in schema], row + 1, 0


def remove_repeats(docs: DataFrame, *, span: int = SPAN, least_words: int = 0, most_sorted: int = MOST_SORTED, id_col: str = "doc_id",
                   text_col: str = "text", keep: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """For every row of ``docs``: the id, the columns named in ``keep``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs) and ``kept`` (the remaining bytes, put together), or with
    ``as_text`` the column ``text`` (the same, without bytes of characters cut in two). With ``least_words``
    a run of fewer words (between white space, those cut at its ends included) stays.

    Strings are judged on the input, so every copy of a passage goes. A null text is
    empty, and texts shorter than ``span`` bytes lose nothing. Rows that repeat an id are
    told apart by their text; rows that repeat both are copies of one another, so both
    lose what is long enough. Null ids are allowed. Columns are matched by position, so
    names of ``keep`` cannot clash with this function's. An empty table gives an empty table.
    """
    base = docs.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("h", F.xxhash64("text"))
    spans = repeated_spans(base.select("id", "h", "text").where(F.octet_length("text") >= span), span=span, most_sorted=most_sorted)
    joined = _pack(base.select("id", *[f"_k{i}" for i in range(len(keep))], "h", "text")).join(spans.select(F.col("id").alias("id_"), F.col("h").alias("h_"), "spans"),
                       F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_")), "left")
    first = joined.select("id", *[f"_k{i}" for i in range(len(keep))], "packed", "spans")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in first.schema[:-2])
    last = "text" if as_text else "kept"
    out = first.mapInArrow(partial(_cut, as_text=as_text, least_words=least_words), f"{fields}, n_bytes long, n_removed long, n_spans long, {last} {'string' if as_text else 'binary'}")
    return out.select(F.col("id").alias(id_col), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                      "n_bytes", "n_removed", "n_spans", last)
