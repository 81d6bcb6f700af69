"""Token counts and token ids of whole texts with a byte-level BPE (operator 6, and
the encoder of operator 4).

A text is cut only at *safe boundaries*: places where the vocabulary's splitting
pattern always starts a new piece, so that the pieces' tokens are the text's tokens.
Two such places are used. A single space between two characters that are not white
space begins a piece (`` ?X+`` takes at most one leading space, and nothing ends
with one there). A single line feed between such characters is a piece of its own.
Where white space meets white space the text stays whole around it.

Pieces repeat, so each worker keeps a bounded memo of pieces already encoded; the
pieces it lacks are gathered over a batch of texts (batches are balanced by bytes)
and given to the library in one batch, many pieces to a string. ``<|endoftext|>`` holds no
white space, so a special string is always inside one piece, and the library treats
it as it does by default.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, slices

VOCABULARY = "byte_bpe_50k.json"
_MEET = re.compile(r"\s\s")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Pieces in each of the two generations of a worker's memo.
MEMO = 500_000
#: Pieces that are put together into one string for the library.
TOGETHER = 128


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed public vocabulary file ``name`` is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class SegmentEncoder:
    """Encodes texts piece by piece. ``value`` turns the ids of a piece into what the memo
    keeps, ``values`` the ids of many pieces that end at given places; ``join`` puts the
    values of a text's pieces together.

    A piece is kept under its text without the leading space; one that begins a line
    keeps its line feed; one that begins the text is encoded as if a line feed stood
    before it, and the line feed's token is taken away again (``unfeed``).
    """

    def __init__(self, path: str, value: Callable, values: Callable, join: Callable, unfeed: Callable):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.pieces, self.split = None, False
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.split = self._byte_level()
        self.value, self.values, self.join, self.unfeed = value, values, join, unfeed
        self.memo: dict = {}
        self.old: dict = {}

    def _byte_level(self) -> bool:
        """Whether the safe boundaries hold: byte-level splitting, no normalizer, no added
        prefix, added tokens without white space. Also notes every token's bytes."""
        state = json.loads(self.tokenizer.to_str())
        pre, added = state.get("pre_tokenizer") or {}, state.get("added_tokens", [])
        held = (state.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                and not pre.get("add_prefix_space") and state["model"]["type"] == "BPE"
                and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        if held:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.bytes_of = np.zeros(max([*vocabulary.values(), *(t["id"] for t in added)]) + 1, dtype=np.int64)
            for token, i in vocabulary.items():  # a byte-level token has a character for each byte
                self.bytes_of[i] = len(token)
            for t in added:
                self.bytes_of[t["id"]] = len(t["content"].encode())
        return held

    def _ids(self, texts: list[str]) -> list:
        if self.pieces is not None:
            return self.pieces.encode(texts, num_threads=1)
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: list[str]) -> dict:
        """Values of pieces: those that begin and end without white space are encoded together."""
        alone = sorted(k for k in keys if not k or k[-1].isspace())
        rest = [k for k in keys if k and not k[-1].isspace()] if alone else keys
        out = dict(zip(alone, map(self.value, self._ids([k if k[:1] == "\n" else " " + k for k in alone])), strict=True))
        whole = [k if k[0] == "\n" else " " + k for k in rest]
        starts = range(0, len(rest), TOGETHER)
        joined = ["".join(whole[a : a + TOGETHER]) for a in starts]
        for a, text, ids in zip(starts, joined, self._ids(joined), strict=True):
            group = whole[a : a + TOGETHER]
            ids = np.asarray(ids, dtype=np.int64)
            ends = np.cumsum(list(map(len, group)) if text.isascii() else [len(k.encode()) for k in group])
            has = np.cumsum(self.bytes_of[ids])
            at = np.searchsorted(has, ends)
            if np.array_equal(has[np.minimum(at, len(has) - 1)], ends):
                out.update(zip(rest[a : a + TOGETHER], self.values(ids, at + 1), strict=True))
            else:  # a token across two pieces would end here; by the boundaries' rule there is none
                out.update(zip(rest[a : a + TOGETHER], map(self.value, self._ids(group)), strict=True))
        return out

    def _cut(self, text: str) -> list[str]:
        """Keys of the pieces of ``text``; the first is its beginning."""
        if _MEET.search(text):
            return _SAFE.split(text)
        return text.replace("\n", " \n").split(" ")

    def encode(self, texts: list[str]) -> list:
        """The joined value of every text of one batch."""
        if not self.split:
            return [self.join([self.value(x)]) for x in self._ids(texts)]
        cut, heads = [], []
        for text in texts:
            keys = self._cut(text)
            first = keys[0]
            plain = bool(first) and not first[0].isspace() and not first[-1].isspace()
            heads.append(None if plain else self.join([self.value(x) for x in self._ids([first])]) if first else self.join([]))
            keys[0] = "\n" + first if plain else "\n."
            cut.append(keys)
        if len(self.memo) > MEMO:
            self.old, self.memo = self.memo, {}
        memo, old = self.memo, self.old
        found = [list(map(memo.get, keys)) for keys in cut]
        gaps = [[i for i, v in enumerate(values) if v is None] if None in values else () for values in found]
        lacking = {keys[i] for keys, at in zip(cut, gaps, strict=True) for i in at}
        new = {k: old[k] for k in lacking if k in old} if old else {}
        new |= self._learn([k for k in lacking if k not in new] if new else list(lacking))
        memo.update(new)
        for k in [k for k in new if len(k) > 64]:  # long pieces are rare: not worth their room
            del memo[k]
        out = []
        for keys, values, at, head in zip(cut, found, gaps, heads, strict=True):
            for i in at:
                values[i] = new[keys[i]]
            values[0] = self.unfeed(values[0]) if head is None else head
            out.append(self.join(values))
        return out


def ids_value(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def ids_values(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw, ends = ids.astype("<u4").tobytes(), (4 * ends).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def count_values(ids: np.ndarray, ends: np.ndarray) -> list[int]:
    return np.diff(ends, prepend=0).tolist()


_ENCODERS: dict[tuple, SegmentEncoder] = {}


def encoder(vocabulary: str, kind: str) -> SegmentEncoder:
    """This worker's encoder: ``kind`` is ``count`` (token counts) or ``ids`` (little-endian 32-bit ids)."""
    key = (vocabulary, kind)
    if key not in _ENCODERS:
        path = vocabulary if "/" in vocabulary else vocabulary_path(vocabulary)
        _ENCODERS[key] = (SegmentEncoder(path, len, count_values, sum, lambda n: n - 1) if kind == "count"
                           else SegmentEncoder(path, ids_value, ids_values, b"".join, lambda ids: ids[4:]))
    return _ENCODERS[key]


def _count(batches: Iterator[pa.RecordBatch], vocabulary: str, text: str) -> Iterator[pa.RecordBatch]:
    enc = encoder(vocabulary, "count")
    for batch in slices(batches, text, 4 << 20):
        k = batch.schema.get_field_index(text)
        texts = [x or "" for x in batch.column(k).to_pylist()]
        counts = pa.array(enc.encode(texts), pa.int64())
        sizes = pa.array([len(x.encode()) for x in texts], pa.int64())
        rest = [(f, batch.column(i)) for i, f in enumerate(batch.schema) if i != k]
        schema = pa.schema([*[f for f, _ in rest], pa.field("n_bytes", pa.int64()), pa.field("n_tokens", pa.int64())])
        yield pa.RecordBatch.from_arrays([*[c for _, c in rest], sizes, counts], schema=schema)


def count_tokens(docs: DataFrame, *, vocabulary: str = VOCABULARY, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``: UTF-8 bytes and
    tokens of the whole text without begin, end or added special tokens.

    ``vocabulary`` is a file name among the installed public vocabularies, or a path
    that every executor has. A null text counts as empty (0 bytes, 0 tokens); ids may
    be null or repeat, every row is counted by itself; other columns of ``docs`` are
    not read, so their names cannot clash. An empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long"
    out = rows.mapInArrow(partial(_count, vocabulary=vocabulary, text="text"), schema)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
