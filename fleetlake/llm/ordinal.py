"""Quality classifier: ordinal cumulative-link regression on graded ratings (operator 10).

A text is a sparse row of hashed features. One weight vector is shared by all
grades, and ordered thresholds cut its score: P(grade <= k) = sigmoid(t_k - score).
From it follow the expected grade and the tail probability P(grade >= top) by which
documents are selected.

The model is fitted on the driver over a *bounded sample* of rated documents (the
``sample`` with the least hash of the id; the bound is a parameter) by Fisher
scoring; only the features that tell a grade apart best get a weight, so that
thousands of ordinary words of a long text do not add up to a verdict. Scoring covers every whole text in
Arrow functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, slices, utf8

BUCKETS = 1 << 16
SAMPLE = 8192
_EDGE = b".,;:!?\"'()[]{}#*$%&|<>-_=+/\\~^@`"
_MEMO = 400_000


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... (columns)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


class Features:
    """Hashed features of texts. Each distinct word counts once, under its lower-case core and
    under the core's first four characters (stems of inflected words); the marks around
    words and capitals count as shares of the words, and a few figures (repeated lines,
    distinct words, digits, lengths) are features of their own."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.memo = buckets, {}

    def _bucket(self, kind: bytes, what: bytes) -> int:
        return xxhash.xxh3_64_intdigest(kind + what) % self.buckets

    def _word(self, word: bytes) -> tuple[int, int, int, int]:
        core = word.strip(_EDGE)
        marks = word.replace(core, b"", 1) if core else word
        text = core.decode("utf-8", "replace")
        return (self._bucket(b"w", text.lower().encode()) if core else -1, self._bucket(b"s", text[:4].lower().encode()) if core else -1,
                self._bucket(b"m", marks) if marks else -1,
                self._bucket(b"c", b"upper") if len(text) > 1 and text.isupper() else -1)

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and values of a text's features."""
        every = text.split()
        words = set(every)
        if len(self.memo) > _MEMO:
            self.memo.clear()
        memo = self.memo
        for w in words:
            if w not in memo:
                memo[w] = self._word(w)
        found = np.array([memo[w] for w in words], dtype=np.int64).reshape(-1, 4)
        core, shape = np.unique(found[:, :2]), found[:, 2:]
        core = core[core >= 0]
        shape, many = np.unique(shape[shape >= 0], return_counts=True)
        lines = [x for x in text.split(b"\n") if x.strip()]
        again = 1 - len(set(lines)) / len(lines) if lines else 0.0
        n, size = max(1, len(every)), max(1, len(text))
        counts = {b"again": again, b"distinct": len(words) / n, b"words": np.log1p(len(every)) / 8, b"length": size / n / 16,
                  b"digits": sum(text.count(d) for d in b"0123456789") / size, b"line": n / max(1, len(lines)) / 64}
        at = np.concatenate([core, shape, [self._bucket(b"l", k) for k in counts]])
        value = np.concatenate([np.ones(len(core)), 8.0 * many / max(1, len(words)), [8.0 * min(1.0, x) for x in counts.values()]])
        return at, value


_FEATURES = pa.schema([("grade", pa.int32()), ("place", pa.int64()), ("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])


def _featurize(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    features = Features(buckets)
    for batch in slices(batches, "text"):
        got = [features.of(t) for t in utf8(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([a.astype(np.int32) for a, _ in got], _FEATURES[2].type),
                                          pa.array([v.astype(np.float32) for _, v in got], _FEATURES[3].type)], schema=_FEATURES)


def _parts(n: int, size: int = 1 << 19) -> Iterator[slice]:
    return (slice(a, a + size) for a in range(0, n, size))


def _screen(row: np.ndarray, at: np.ndarray, value: np.ndarray, grades: np.ndarray, buckets: int, k: int, most: int, support: int) -> np.ndarray:
    """The ``most`` buckets whose mean value in some grade departs most (in standard errors) from
    the mean over all, among those that at least ``support`` rows have."""
    n = len(grades)
    square, rows, by_grade = np.zeros(buckets), np.zeros(buckets, np.int64), np.zeros(k * buckets)
    for part in _parts(len(at)):  # sums of parts, so that no copy of all entries is made
        a, v = at[part].astype(np.int64), value[part].astype(np.float64)
        square += np.bincount(a, v * v, buckets)
        rows += np.bincount(a, minlength=buckets)
        by_grade += np.bincount(grades[row[part]] * buckets + a, v, k * buckets)
    by_grade = by_grade.reshape(k, buckets)
    mean = by_grade.sum(axis=0) / n
    spread = np.sqrt(np.maximum(square / n - mean * mean, 1e-12))
    best = np.zeros(buckets)
    for g in range(k):
        if many := int((grades == g).sum()):
            best = np.maximum(best, np.abs(by_grade[g] / many - mean) / spread * np.sqrt(many))
    best[rows < support] = 0
    return np.sort(np.argsort(-best, kind="stable")[: min(most, int((best > 3).sum()))])


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, *, buckets: int = BUCKETS, n_grades: int | None = None,
                most_weights: int = 512, support: int = 4, ridge: float = 3e-4, steps: int = 30) -> OrdinalModel:
    """Fits shared weights and ordered thresholds to feature rows and grades 0, 1, ... by Fisher
    scoring on the mean log-likelihood with a ridge. ``most_weights`` buckets get a weight:
    those that tell some grade apart best; the rest stay zero."""
    sizes = np.array([len(a) for a, _ in rows], np.int64)
    at, value = (np.concatenate([r[j] for r in rows]) if rows else np.empty(0) for j in (0, 1))
    return _fit(sizes, at, value, grades, buckets, n_grades, most_weights, support, ridge, steps)


def _fit(sizes: np.ndarray, at: np.ndarray, value: np.ndarray, grades: np.ndarray, buckets: int = BUCKETS, n_grades: int | None = None,
         most_weights: int = 512, support: int = 4, ridge: float = 3e-4, steps: int = 30) -> OrdinalModel:
    """:func:`fit_ordinal` on the rows' features one after the other, ``sizes`` of them a row."""
    k = int(n_grades if n_grades is not None else grades.max(initial=0) + 1)
    if not len(grades) or k < 2:
        return OrdinalModel(np.zeros(buckets), np.full(max(k - 1, 1), -4.0))  # nothing to tell apart: all are of the top grade
    n = len(sizes)
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    chosen = _screen(row, at, value, grades, buckets, k, most_weights, support)
    place = np.full(buckets, -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen)))
    for part in _parts(len(at)):
        to = place[at[part]]
        own = to >= 0
        np.add.at(x, (row[part][own], to[own]), value[part][own])
    del row, at, value
    below = np.clip(np.cumsum(np.bincount(grades, minlength=k))[:-1] / n, 1e-3, 1 - 1e-3)
    t = np.maximum.accumulate(np.log(below / (1 - below)) + 0.01 * np.arange(k - 1))
    w, i = np.zeros(len(chosen)), np.arange(n)

    def probabilities(w: np.ndarray, t: np.ndarray):
        edge = 1 / (1 + np.exp(np.clip((x @ w)[:, None] - t[None, :], -60, 60)))  # P(grade <= j)
        edge = np.concatenate([np.zeros((n, 1)), edge, np.ones((n, 1))], axis=1)
        return edge, np.maximum(np.diff(edge, axis=1), 1e-9)

    def loss(w: np.ndarray, t: np.ndarray) -> float:
        return np.inf if (np.diff(t) <= 0).any() else -np.log(probabilities(w, t)[1][i, grades]).mean() + 0.5 * ridge * (w @ w)

    now = loss(w, t)
    for _ in range(steps):
        edge, p = probabilities(w, t)
        slope = edge * (1 - edge)  # of P(grade <= j) in its threshold
        d_score = -np.diff(slope, axis=1)  # of P(grade = j) in the score
        d_t = np.zeros((k - 1, n, k))  # of P(grade = j) in threshold m
        for m in range(k - 1):
            d_t[m, :, m] = slope[:, m + 1]
            d_t[m, :, m + 1] = -slope[:, m + 1]
        one = 1 / p[i, grades] / n
        gradient = np.concatenate([-x.T @ (d_score[i, grades] * one) + ridge * w, [-(d_t[m, i, grades] * one).sum() for m in range(k - 1)]])
        information = np.zeros((len(w) + k - 1,) * 2)
        information[: len(w), : len(w)] = x.T @ (x * ((d_score**2 / p).sum(axis=1) / n)[:, None]) + ridge * np.eye(len(w))
        for m in range(k - 1):
            cross = x.T @ ((d_score * d_t[m] / p).sum(axis=1) / n)
            information[: len(w), len(w) + m] = information[len(w) + m, : len(w)] = cross
            for j in range(k - 1):
                information[len(w) + m, len(w) + j] = (d_t[m] * d_t[j] / p).sum() / n
        move, size = np.linalg.solve(information + 1e-9 * np.eye(len(information)), gradient), 1.0
        while (then := loss(w - size * move[: len(w)], t - size * move[len(w) :])) > now and size > 1e-4:
            size /= 2
        if then >= now - 1e-7:
            break
        w, t, now = w - size * move[: len(w)], t - size * move[len(w) :], then
    weights = np.zeros(buckets)
    weights[chosen] = w
    return OrdinalModel(weights, t)


def train(docs: DataFrame, ratings: DataFrame, *, sample: int = SAMPLE, buckets: int = BUCKETS, id_col: str = "doc_id",
          text_col: str = "text", **options) -> OrdinalModel:
    """Model from ``ratings(id, grade)``: the ``sample`` rated rows with the least hash of the id
    (rows without id or grade are passed over) and their documents' whole texts."""
    prepare(docs.sparkSession)
    rated = ratings.select(F.col(id_col).alias("_id"), F.col("grade").cast("int").alias("grade")).where("_id is not null and grade >= 0")
    rated = rated.orderBy(F.xxhash64("_id"), "_id", "grade").limit(sample)  # bounded: may be sent to every executor
    found = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(rated), F.col("_doc") == F.col("_id"))
    # features are made where the texts lie; rows that repeat an id are cut to the sample after that
    made = found.select("grade", F.xxhash64("_doc", "text").alias("place"), "text").mapInArrow(
        partial(_featurize, buckets=buckets), "grade int, place long, at array<int>, value array<float>")
    got = made.orderBy("place", "grade").limit(sample).drop("place").toArrow()
    grades = got.column("grade").to_numpy().astype(np.int64)
    at, value = (got.column(c).combine_chunks() for c in ("at", "value"))
    sizes = np.diff(at.offsets.to_numpy()).astype(np.int64) if len(at) else np.empty(0, np.int64)
    del got
    return _fit(sizes, at.flatten().to_numpy(), value.flatten().to_numpy(), grades, buckets, **options)


def _score(batches: Iterator[pa.RecordBatch], model: OrdinalModel, text: str) -> Iterator[pa.RecordBatch]:
    features = Features(len(model.weights))
    new = pa.schema([("expected_grade", pa.float64()), ("p_top", pa.float64())])
    for batch in slices(batches, text):
        k = batch.schema.get_field_index(text)
        score = np.array([float(model.weights[a] @ v) for a, v in map(features.of, utf8(batch.column(k)))])
        tails = model.tails(score)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])], schema=pa.schema([*batch.schema, *new]))


def _scored(docs: DataFrame, model: OrdinalModel, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """Columns ``_k0, _k1, ...`` (those of ``keep``), ``expected_grade`` and ``p_top``."""
    prepare(docs.sparkSession)
    rows = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                       *([] if text_col in keep else [F.col(text_col).cast("string").alias("_text")]))
    text = f"_k{keep.index(text_col)}" if text_col in keep else "_text"
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(partial(_score, model=model, text=text), f"{fields}, expected_grade double, p_top double")


def classify(docs: DataFrame, model: OrdinalModel, *, least: float = 0.5, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``docs`` named in ``keep``, with ``expected_grade``, ``p_top`` (probability of
    the top grade) and ``kept`` (``p_top >= least``) for every row. A null or empty text has
    no words, so little but the thresholds decides. Columns are matched by position, so
    names cannot clash; an empty table gives an empty table."""
    out = _scored(docs, model, text_col, keep)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "expected_grade", "p_top", (F.col("p_top") >= least).alias("kept"))


def select_documents(docs: DataFrame, model: OrdinalModel, *, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that ``classify`` keeps."""
    out = _scored(docs, model, text_col, tuple(docs.columns)).where(F.col("p_top") >= least)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(docs.columns)])


def grades_from_labels(labels: DataFrame) -> DataFrame:
    """Grades of ``labels(doc_id, quality, toxic)``: 0 toxic, 1 low quality, 2 clean. Rows where
    either mark is null have no grade. (Toxic texts get the open end of the scale: their
    score falls with every toxic word.)"""
    return labels.select("doc_id", F.when(F.col("quality").isNull() | F.col("toxic").isNull(), None).when(F.col("toxic") == 1, 0)
                         .when(F.col("quality") == 0, 1).otherwise(2).alias("grade"))
