"""Quality rules on repetition (operator 9).

Rolling hashes of word n-grams of several lengths, in numpy, find the n-grams that a
text holds more than once; the rule measures which share of the text's characters lies
inside later occurrences of them, and inside lines that repeat an earlier line. A text
is a run of documents' rows, so each is measured by itself: no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, record, slices, utf8

#: Largest share of word characters inside later occurrences of n-grams of this many words.
GRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of the lines, and of the word characters, in lines that repeat an earlier one.
LINE_LIMIT, LINE_CHARS_LIMIT = 0.30, 0.20
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEAT_PERCENT = 50, 50
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _later(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which repeat an earlier one."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    many, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    later[order[1:][same]] = True
    return many, later


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in the windows of ``width`` words that begin where ``starts`` is true."""
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.cumsum(edge[:n]) > 0


def measure(text: bytes, grams: tuple[int, ...] = tuple(GRAM_LIMITS)) -> tuple:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, dup_line_chars,
    [characters inside later occurrences of n-grams, per length])`` of a text's UTF-8 bytes."""
    words = text.split()
    n = len(words)
    ascii_only = text.isascii()
    points = (len if ascii_only else lambda w: len(w.decode("utf-8", "replace")))
    sizes = np.fromiter(map(points, words), np.int64, n)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = dup_lines = dup_chars = 0
    for line in text.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        lines += 1
        if line in seen:
            dup_lines += 1
            dup_chars += sum(map(points, parts))
        else:
            seen.add(line)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    repeat_words = 0
    if n >= 4:  # exact: pairs are numbered, then pairs with a third word
        k = len(numbers)
        pair = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1]
        repeat_words = int(_covered(_later(pair[:-1] * k + ids[2:])[0], 3, n).sum())
    inside, code = [], (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    code ^= code >> np.uint64(31)
    rolling = code.copy()
    width = 1
    for length in grams:
        while width < length and len(rolling) > 1:  # one word more: hash * base + its code
            rolling = rolling[:-1] * _BASE + code[width:]
            width += 1
        if n <= length:
            inside.append(0)
        else:
            inside.append(int(sizes[_covered(_later(rolling)[1], length, n)].sum()))
    return n, int(sizes.sum()), symbols, dup_lines, repeat_words, lines, dup_chars, inside


_OUT = pa.schema([(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars")]
                 + [("dup_gram_chars", pa.list_(pa.int64()))])


def _measure(batches: Iterator[pa.RecordBatch], grams: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = zip(*(measure(t, grams) for t in utf8(batch.column(1))), strict=True)
        out = record(_OUT, *map(list, rows))
        yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], schema=pa.schema([pa.field("id", batch.schema.field(0).type), *_OUT]))


def quality_rules(docs: DataFrame, *, gram_limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT,
                  line_chars_limit: float = LINE_CHARS_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the base measures (``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``), ``base_failed``, ``kept``, and what ``kept`` rests on:
    ``n_lines``, ``dup_line_chars`` and, for each n-gram length n, ``dup_chars_n`` (characters inside
    later occurrences of n-grams).

    ``base_failed``: fewer than 50 words, or over half the words in repeated 3-word windows.
    ``kept``: not that, and no share above its limit. A null or empty text has no words and
    fails; ids may be null or repeat; other columns are not read.
    """
    limits = dict(sorted((gram_limits or GRAM_LIMITS).items()))
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = ", ".join(f"{f.name} long" for f in list(_OUT)[:-1])
    out = rows.mapInArrow(partial(_measure, grams=tuple(limits)),
                          f"id {docs.schema[id_col].dataType.simpleString()}, {fields}, dup_gram_chars array<long>")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    over = (F.col("n_dup_lines") > line_limit * F.col("n_lines")) | (F.col("dup_line_chars") > line_chars_limit * F.col("word_chars"))
    for k, limit in enumerate(limits.values()):
        over = over | (F.col("dup_gram_chars")[k] > limit * F.col("word_chars"))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & ~over).alias("kept"), "n_lines", "dup_line_chars",
                      *[F.col("dup_gram_chars")[k].alias(f"dup_chars_{length}") for k, length in enumerate(limits)])
