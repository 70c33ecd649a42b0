"""Byte-level BPE encoding and decoding in linear time.

Bytes are read as Latin-1 characters, so that one Aho-Corasick automaton finds every vocabulary entry in a piece.  The
encoder takes the longest entry at a place, and a shorter prefix of it where two neighbours could not have stood side by
side in a run of merges; where nothing fits it steps back and marks the place as dead, so each place is left at most once.

Two neighbours fit if no merge across their border would have come first.  That is seen by taking the later-made of the
two apart again and again: while the border lies between parts a | b, a merge of a and b must not rank before the merge
that ends this state.  Compatibility of neighbours is remembered.

The ranks must come from merging, lowest first: every entry is made by merges of lower ranks (``read_ranks`` makes sure of
it).  As in the public library for such rank files, a piece that is an entry itself is that entry.  Encoded ids are binary:
little-endian unsigned 32-bit integers.

Defined cases: null and empty texts have no ids and decode to no bytes; repeated rows are encoded alike; ids outside the
vocabulary, or binary whose length is no multiple of four, are an error.  Texts are encoded whole; the memo of pieces is
bounded and only saves work.
"""

from __future__ import annotations

import base64
import functools
import weakref
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vitalis.llm.pieces import Memo, _Store
from vitalis.llm.scratch import map_arrow, ship

NONE = -1
PAIRS_KEPT = 200_000
PIECES_KEPT = 1_600_000
ROWS_AT_ONCE = 256


class Vocabulary:
    """Entries by id, and how each is made by a merge."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.id_of = {e: i for i, e in enumerate(entries)}
        self.made: dict[tuple[int, int], int] = {}
        self.left, self.right = [NONE] * len(entries), [NONE] * len(entries)
        self._fits: dict[int, bool] = {}
        for i, e in enumerate(entries):
            for k in range(1, len(e)):
                a, b = self.id_of.get(e[:k], i), self.id_of.get(e[k:], i)
                if a < i and b < i and self._reachable(a) and self._reachable(b) and self.fits(a, b):
                    self.left[i], self.right[i] = a, b
                    self.made[a, b] = i
                    break
        self._fits.clear()  # later merges were not known yet

    def _reachable(self, i: int) -> bool:
        return len(self.entries[i]) == 1 or self.left[i] != NONE

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("entries", "left", "right", "made")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.id_of = {e: i for i, e in enumerate(self.entries)}
        self._fits = {}

    @functools.cached_property
    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for i, e in enumerate(self.entries):
            if self._reachable(i):
                out.add_word(e.decode("latin-1"), (i, len(e)))
        out.make_automaton()
        return out

    @functools.cached_property
    def shorter(self) -> list[int]:
        """The longest reachable entry that is a proper prefix of each."""
        out = []
        for e in self.entries:
            found = (self.id_of.get(e[:k], NONE) for k in range(len(e) - 1, 0, -1))
            out.append(next((i for i in found if i != NONE and self._reachable(i)), NONE))
        return out

    @functools.cached_property
    def memo(self) -> Memo:
        own = weakref.ref(self)  # no cycle: a worker's memo goes with its broadcast, not at some later collection
        return Memo(lambda found: map(own().encode_piece, map(str.encode, found)), PIECES_KEPT, "<u4")

    @functools.cached_property
    def bytes_of(self) -> _Store:
        out = _Store("u1")
        out.add(np.frombuffer(b"".join(self.entries), np.uint8), np.array(list(map(len, self.entries)), np.int64))
        return out

    def fits(self, a: int, b: int) -> bool:
        """Whether entries a and b can be neighbours in an encoding."""
        key = a << 32 | b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= PAIRS_KEPT:
                self._fits.clear()
            known = self._fits[key] = self._undone(a, b)
        return known

    def _undone(self, a: int, b: int) -> bool:
        """Merges rank as the id they make.  Going back in time, the border a | b lasts until the merge that makes the
        later of the two; equal merges run from left to right, so one across the border precedes an equal one inside b."""
        left, right, made = self.left, self.right, self.made
        until = len(self.entries)  # ranks below this one had their chance to merge across the border
        while True:
            if made.get((a, b), until) < until:
                return False
            a_parts, b_parts = left[a] != NONE, left[b] != NONE
            if not a_parts and not b_parts:
                return True
            if a_parts and (a > b or not b_parts):
                until, a = a, right[a]
            else:
                until, b = b + 1, left[b]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.id_of.get(piece)
        if whole is not None:
            return [whole]
        longest, shorter, entries = [NONE] * len(piece), self.shorter, self.entries
        for end, (i, n) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - n + 1] = i  # of one place, longer entries end later
        out: list[int] = []
        dead = set()
        at, here = 0, longest[0]
        while True:
            if here == NONE:
                dead.add(at)
                here = out.pop()
                at -= len(entries[here])
                here = shorter[here]
                continue
            end = at + len(entries[here])
            if end not in dead and (not out or self.fits(out[-1], here)):
                out.append(here)
                if end == len(piece):
                    return out
                at, here = end, longest[end]
            else:
                here = shorter[here]

    def encode(self, text: str) -> bytes:
        return self.memo.ids(text)

    def decode(self, ids: bytes) -> bytes:
        return self.decoded(np.frombuffer(ids, "<u4"))[0].tobytes()

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ``ids`` one behind the other, and where those of each end."""
        if len(ids) and int(ids.max()) >= len(self.entries):
            raise IndexError("id outside the vocabulary")
        return self.bytes_of.gather(ids.astype(np.int64))


def read_ranks(path: str) -> Vocabulary:
    """A rank file: a base64 entry and its rank on each line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, f)}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    out = Vocabulary(sorted(ranks, key=ranks.__getitem__))
    if odd := [e for i, e in enumerate(out.entries) if not out._reachable(i)]:
        raise ValueError(f"no merges of lower rank make these entries: {odd[:5]}")
    return out


def broadcast(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary for all executors; its size is fixed by the file."""
    ship(spark)
    return spark.sparkContext.broadcast(read_ranks(path))


def _binary(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary values that lie one behind the other, ``at`` their bounds in bytes; in blocks of less than 2 GB by the caller."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def with_ids(docs: DataFrame, vocabulary: Broadcast, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the encoded ``text`` as binary column ``ids``; with ``decoded``, in the same pass, what these ids decode to
    (``with_decoded`` does so for stored ids)."""
    new = [ids, *([decoded] if decoded else [])]
    if set(new) & set(docs.columns):
        raise ValueError(f"columns already there: {sorted(set(new) & set(docs.columns))}")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.BinaryType()) for n in new)])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary.value
        for batch in batches:
            for i in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(i, ROWS_AT_ONCE)
                found, counts = voc.memo.ids_of([t or "" for t in part.column(at).to_pylist()])
                ends = np.concatenate([[0], np.cumsum(counts)])
                made = [_binary(found, ends * 4)]
                if decoded:
                    back, upto = voc.decoded(found)
                    made.append(_binary(back, np.concatenate([[0], upto])[ends]))
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.fieldNames())

    return map_arrow(docs, run, schema)


def with_decoded(encoded: DataFrame, vocabulary: Broadcast, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that ``ids`` stand for as binary column ``decoded``."""
    if decoded in encoded.columns:
        raise ValueError(f"column already there: {decoded}")
    schema = T.StructType([*encoded.schema.fields, T.StructField(decoded, T.BinaryType())])
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = vocabulary.value.decode
        for batch in batches:
            for i in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(i, ROWS_AT_ONCE)
                found = pa.array([decode(x or b"") for x in part.column(at).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=schema.fieldNames())

    return map_arrow(encoded, run, schema)
