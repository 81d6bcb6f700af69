"""Licence scan: Dice coefficient over word bigrams against licence templates (operator 2).

Texts and templates are normalised alike: A-Z lower-cased, everything but letters and
digits a separator. A *passage* of a document is any run of words, wherever its lines
end; lines only tell where it is. The Dice
coefficient of two multisets of bigrams of sizes a and b is 2 |common| / (a + b); for it to
reach t, the smaller must be at least t / (2 - t) of the larger, so a template is
compared only with passages inside these size bounds, and only where the document has
enough of the template's bigrams at all. A best passage begins and ends with a bigram of
the template (one word less would be better otherwise). ``Scanner.scan`` compares whole lines only.

Templates are a small parameter (their size does not depend on the corpus) that goes to
the Arrow function; each document is scanned by itself, whole.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, slices, utf8
from fleetlake.llm.license_texts import TEMPLATES

LEAST = 0.8
#: ASCII letters and digits stay (A-Z lower-cased), so do bytes of other characters; the rest separates.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))

_NORMAL_LINES = _NORMAL[:10] + b"\n" + _NORMAL[11:]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def bigrams(words: list[bytes]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


def dice(a: Counter, b: Counter) -> float:
    """Dice coefficient of two multisets (0 if either is empty)."""
    sizes = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / sizes if sizes else 0.0


class Scanner:
    """Finds the best passage of a text for each licence."""

    def __init__(self, templates: dict[str, tuple[str, ...]], least: float):
        self.least, self.templates = least, []
        for name, texts in sorted(templates.items()):
            for text in texts:
                grams = bigrams(words_of(text.encode()))
                size = sum(grams.values())
                if size:
                    low, high = math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)
                    self.templates.append((name, grams, size, low, high, math.ceil(least * (low + size) / 2 - 1e-9)))
        self.by_gram: dict[tuple, list[int]] = {}
        for k, t in enumerate(self.templates):
            for g in t[1]:
                self.by_gram.setdefault(g, []).append(k)
        self.firsts = {g[0] for g in self.by_gram}

    def _hits(self, text: bytes) -> tuple[list[bytes], list[int], dict[int, list[int]]]:
        """Words of a text, words up to and with each line, and for templates the word places of their bigrams."""
        words: list[bytes] = []
        ends: list[int] = []
        for line in text.translate(_NORMAL_LINES).split(b"\n"):
            words += line.split()
            ends.append(len(words))
        firsts, by_gram = self.firsts, self.by_gram
        hits: dict[int, list[int]] = {}
        for i, w in enumerate(words[:-1]):
            if w in firsts:
                for k in by_gram.get((w, words[i + 1]), ()):
                    hits.setdefault(k, []).append(i)
        return words, ends, hits

    def passages(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """``(licence, Dice, first line, last line)`` of the best run of words for each licence that reaches
        the least Dice (the earliest, then the shortest of equals), in order of names."""
        words, ends, hits = self._hits(text)
        best: dict[str, tuple[float, int, int]] = {}  # Dice, first word, last word
        for k, at in sorted(hits.items()):
            name, grams, size, _, high, need = self.templates[k]
            if len(at) < need:
                continue
            places: dict[tuple, list[int]] = {}
            back = []  # a hit counts in a passage that begins after its n-th last equal, if the template has n
            for j, i in enumerate(at):
                g = (words[i], words[i + 1])
                same = places.setdefault(g, [])
                back.append(same[-grams[g]] if len(same) >= grams[g] else -1)
                same.append(j)
            if sum(min(len(same), grams[g]) for g, same in places.items()) < need:
                continue
            after = {b: j for j, b in enumerate(back) if b >= 0}
            starts, common, stop = [], 0, 0
            for x, i in enumerate(at):  # what the longest passage from here has in common bounds all of them
                while stop < len(at) and at[stop] < i + high:
                    common += back[stop] < x
                    stop += 1
                if common >= need:
                    starts.append((-common, x, stop))
                common += (x in after and after[x] < stop) - 1
            if not starts:
                continue
            at_, back_ = np.array(at), np.array(back)
            for less, x, stop in sorted(starts):
                bound = 2 * -less / (size - less)
                if bound < self.least or (name in best and (-bound, at[x]) > (-best[name][0], best[name][1])):
                    continue
                scores = 2 * np.cumsum(back_[x:stop] < x) / (at_[x:stop] - (at[x] - 1 - size))
                y = int(scores.argmax())
                found = (float(scores[y]), at[x], at[x + y] + 1)
                if found[0] >= self.least and (name not in best or (-found[0], *found[1:]) < (-best[name][0], *best[name][1:])):
                    best[name] = found
        return [(name, score, bisect_right(ends, a), bisect_right(ends, b)) for name, (score, a, b) in sorted(best.items())]

    def scan(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """``passages`` of whole lines only."""
        words, ends, hits = self._hits(text)
        best: dict[str, tuple[float, int, int]] = {}
        line_of: list[int] = []
        for k, at in sorted(hits.items()):
            name, grams, size, low, high, need = self.templates[k]
            if len(at) < need or sum((Counter((words[i], words[i + 1]) for i in at) & grams).values()) < need:
                continue
            if not line_of:
                line_of = [n for n, (a, b) in enumerate(zip([0, *ends], ends, strict=False)) for _ in range(b - a)]
            begins, stops = sorted({line_of[i] for i in at}), sorted({line_of[i + 1] for i in at})
            for first in begins:  # a best passage begins and ends in lines that share with the template
                a = ends[first - 1] if first else 0
                found: Counter = Counter()
                common, j = 0, 0
                while j < len(at) and at[j] < a:
                    j += 1
                for last in stops:
                    if last < first:
                        continue
                    many = ends[last] - a - 1  # bigrams of the passage
                    if many > high:
                        break
                    while j < len(at) and at[j] + 1 < ends[last]:
                        g = (words[at[j]], words[at[j] + 1])
                        found[g] += 1
                        common += found[g] <= grams[g]
                        j += 1
                    if many < low or common < need:
                        continue
                    score = 2 * common / (many + size)
                    if score >= self.least and (name not in best or (-score, first, last) < (-best[name][0], *best[name][1:])):
                        best[name] = (score, first, last)
        return [(name, *best[name]) for name in sorted(best)]


_SCANNERS: dict[tuple, Scanner] = {}
_MATCHES = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch], templates: dict, least: float) -> Iterator[pa.RecordBatch]:
    key = (least, tuple(sorted(templates.items())))
    if key not in _SCANNERS:
        _SCANNERS[key] = Scanner(templates, least)
    scan = _SCANNERS[key].passages
    for batch in slices(batches, "text"):
        found = [[dict(zip(("license", "dice", "first_line", "last_line"), m, strict=True)) for m in scan(t)] for t in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _MATCHES)], names=["id", "matches"])


def scan_licenses(docs: DataFrame, *, templates: dict[str, tuple[str, ...]] | None = None, least: float = LEAST,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, license, dice, n_licenses, matches)`` for every row of ``docs``: the licence whose passage has
    the largest Dice (the first by name of equals; null if none reaches ``least``), and for each
    licence found its best passage as line numbers from 0. A null or empty text has none;
    ids may be null or repeat; other columns are not read."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(partial(_scan, templates=templates or TEMPLATES, least=least),
                          f"id {docs.schema[id_col].dataType.simpleString()}, matches array<struct<license:string,dice:double,first_line:int,last_line:int>>")
    top = F.expr("aggregate(matches, cast(null as struct<license:string,dice:double,first_line:int,last_line:int>), "
                 "(best, m) -> if(best is null or m.dice > best.dice, m, best))")
    out = out.withColumn("_top", top)
    return out.select(F.col("id").alias(id_col), F.col("_top.license").alias("license"), F.col("_top.dice").alias("dice"),
                      F.size("matches").alias("n_licenses"), "matches")
