"""Periodic runs of words: seed and extend on diagonals (operator 12).

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``max(least, 2 * q)`` words long, that no neighbouring word extends.
On the diagonal of lag q it is an unbroken row of at least ``max(least - q, q)`` matches.

Lags are taken in classes from q to 2q - 1. Every run of a class holds a match of the
class's *guaranteed overlap*, the least such number. The k-grams of all places are
indexed; a seed stands at every t-th place, with k + t - 1 equal to that overlap, so each
run holds a seed. A seed is paired with the same k-gram's occurrences in the same document
that lie a lag of the class further on: at most 4 n pairs a class, however often one k-gram
occurs. Pairs inside one found run whose period divides the lag lead back to that run and are
left out. Of the rest, each is extended both ways on its diagonal unless the table of
the furthest place covered per lag says that its stretch was walked before.

A document is one row and its work is n log n, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, record, slices, utf8

#: Words of the shortest run.
LEAST = 12
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def _gram_hashes(code: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k words from each place on, put together from those of powers of two."""
    out, done, base = None, 0, _BASE
    power, size = code, 1
    while True:
        if k & size:
            if out is None:
                out, done = power, size
            else:
                n = len(code) - done - size + 1
                out = out[:n] * np.uint64(base) + power[done : done + n]
                done += size
        if done == k:
            return out
        power = power[:-size] * np.uint64(base) + power[size:]
        base, size = base * base & (1 << 64) - 1, size * 2


def _matches(ids: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and from j on agree, forward (step 1) or, before them, backward (-1)."""
    n, size, most = 0, 16, len(ids) - j if step > 0 else i
    while n < most:
        m = min(size, most - n)
        a, b = (ids[i + n : i + n + m], ids[j + n : j + n + m]) if step > 0 else (ids[i - n - m : i - n][::-1], ids[j - n - m : j - n][::-1])
        differ = a != b
        if differ.any():
            return n + int(differ.argmax())
        n, size = n + m, size * 4
    return n


def _pairs(code: np.ndarray, places: np.ndarray, k: int, t: int, lo: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds (every t-th place) and lags in [lo, 2 lo) at which the same k-gram stands again."""
    n = len(code)
    places = places[places <= n - k]
    if not len(places):
        return places, places
    hashes = _gram_hashes(code, k)[places]
    order = np.argsort(hashes, kind="stable")  # by k-gram, then place
    hashes, places = hashes[order], places[order]
    rank = np.cumsum(np.concatenate([[False], hashes[1:] != hashes[:-1]]))
    key = rank * (n + 1) + places
    seeds = np.flatnonzero(places % t == 0)
    base = rank[seeds] * (n + 1)
    first = np.searchsorted(key, base + np.minimum(places[seeds] + lo, n))
    last = np.searchsorted(key, base + np.minimum(places[seeds] + 2 * lo, n))
    many = last - first
    at = np.repeat(places[seeds], many)
    other = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    return at, places[other] - at


def periodic_runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run in a sequence of word numbers, by start, then period."""
    n = len(ids)
    if n < least:
        return []
    code = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    code ^= code >> np.uint64(31)
    short = -(-least // 2)  # the least overlap that any lag guarantees
    hashes = _gram_hashes(code, short)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return []
    again = np.zeros(n, bool)  # only these places can begin a longer k-gram that occurs twice
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    repeated = np.flatnonzero(again)
    found: dict[tuple[int, int], int] = {}
    lo = 1
    while 2 * lo <= n:
        overlap = min(max(least - q, q) for q in range(lo, min(2 * lo, max(lo, least) + 1)))
        t = max(1, (overlap - short + 1) // 4)
        k = overlap - t + 1
        at, lag = _pairs(code, repeated, k, t, lo)
        order = np.argsort(at, kind="stable")
        at, lag = at[order], lag[order]
        fresh = np.ones(len(at), bool)
        for (s, e), q in found.items():
            if e - s >= lo + k:
                a, b = np.searchsorted(at, [s, e])
                fresh[a:b] &= (at[a:b] + lag[a:b] + k > e) | (lag[a:b] % q != 0)
        at, lag = at[fresh], lag[fresh]
        order = np.lexsort((at, lag))
        furthest: dict[int, int] = {}
        for i, q in zip(at[order].tolist(), lag[order].tolist(), strict=True):
            if i < furthest.get(q, 0):
                continue
            ahead = _matches(ids, i, i + q, 1)
            furthest[q] = i + ahead
            s, e = i - _matches(ids, i, i + q, -1), i + ahead + q
            if e - s >= max(least, 2 * q):
                found.setdefault((s, e), q)  # the same stretch at a smaller lag has the smaller period
        lo *= 2
    return sorted((s, e - s, q) for (s, e), q in found.items())


_OUT = pa.schema([("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                  ("exponent_milli", pa.int64()), ("runs", pa.string()), ("collapsed", pa.binary())])


def _runs(batches: Iterator[pa.RecordBatch], least: int, digests: bool) -> Iterator[pa.RecordBatch]:
    sha = (lambda b: hashlib.sha256(b).hexdigest()) if digests else None
    schema = _OUT if not digests else pa.schema([*list(_OUT)[:-2], ("runs", pa.string()), ("collapsed", pa.string())])
    for batch in slices(batches, "text", 4 << 20):
        rows = []
        for text in utf8(batch.column(batch.num_columns - 1)):
            words = text.split()
            numbers: dict[bytes, int] = {}
            runs = periodic_runs(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)), least)
            best = min(((-length, s, q) for s, length, q in runs), default=None)
            top = (None,) * 4 if best is None else (best[1], -best[0], best[2], -1000 * best[0] // best[2])
            kept = words
            if runs:
                edge = np.zeros(len(words) + 1, np.int64)
                for s, length, q in runs:
                    edge[s + q] += 1
                    edge[s + length] -= 1
                kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            told, rest = "".join(f"{s},{length},{q}\n" for s, length, q in runs), b" ".join(kept)
            rows.append((len(words), len(runs), *top, *((sha(told.encode()), sha(rest)) if digests else (told, rest))))
        out = record(schema, *map(list, zip(*rows, strict=True)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out.columns], schema=pa.schema([*list(batch.schema)[:-1], *schema]))


def collapse_runs(docs: DataFrame, *, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                  digests: bool = False) -> DataFrame:
    """For every row of ``docs``: the id, the columns named in ``keep``, ``n_words``, ``n_runs``; ``start``
    (a word's number from 0), ``length``, ``period`` and ``exponent_milli`` of the longest run (of equal
    lengths the first, then the one of the smaller period; null without a run); ``runs`` (a line
    ``start,length,period`` for each run, by start, then period) and ``collapsed`` (the words that are in no
    run after its first period, joined by one space, as UTF-8 bytes). With ``digests`` the last two are
    lower-case SHA-256 digests, so that they need not be stored.

    Words are what stands between ASCII white space, compared byte by byte. A null or empty
    text has no words, no run and empty ``runs`` and ``collapsed``. Ids may be null or repeat: each
    row is judged by itself. Columns are matched by position, so names of ``keep`` cannot clash with
    this function's. An empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text_col).cast("string").alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])
    out = rows.mapInArrow(partial(_runs, least=least, digests=digests), f"{fields}, n_words long, n_runs long, start long, length long, period long, "
                          f"exponent_milli long, runs string, collapsed {'string' if digests else 'binary'}")
    return out.select(F.col("_id").alias(id_col), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *[f.name for f in _OUT])
