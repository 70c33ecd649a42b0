"""Benchmark decontamination by winnowing.

Training texts and benchmark items are cut into k-grams of words; in each run of ``WINDOW - k + 1`` consecutive k-grams only
the one with the least hash (the rightmost of equals) is kept as a fingerprint.  Any shared span of ``WINDOW`` words therefore
shares a fingerprint, at about 2 / (WINDOW - k + 2) of the places.  A training fingerprint found among the benchmark's is a
hit; it is extended to every ``WINDOW``-word window around it, and each window is looked up in full, so the result is exactly
the set of windows that occur.  Items shorter than a window are one window of their own length n: there k = n and every
n-gram is a fingerprint.

The benchmark is a stated query set.  It is taken in blocks of at most ``BLOCK_WORDS`` words (or one item), whose index
(sorted 64-bit hashes) is broadcast; beyond one block the training texts pass block after block, with a written table
between.  No training text, fingerprint or hit leaves its task: there is no shuffle.

Defined cases: null and empty texts or items have no words and never match; repeated rows are judged alike; items with
equal texts are each counted, and several texts of one id are one item; items with a null id are ignored; an empty benchmark leaves every text clean.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm import wordhash
from vitalis.llm.scratch import map_arrow, written

WINDOW = 13
K = 7
BLOCK_WORDS = 2_000_000

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
_HITS = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


class HashSet:
    """Membership in a sorted hash array, with a bit table in front that turns most strangers away."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = max(10, min(24, math.ceil(math.log2(len(self.values) + 1)) + 5))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.values >> np.uint64(64 - self.bits)] = True

    def where(self, hashes: np.ndarray) -> np.ndarray:
        """Places of ``hashes`` that are members."""
        at = np.flatnonzero(self.seen[hashes >> np.uint64(64 - self.bits)])
        if not len(at) or not len(self.values):
            return at[:0]
        found = np.minimum(np.searchsorted(self.values, hashes[at]), len(self.values) - 1)
        return at[self.values[found] == hashes[at]]


class Windows:
    """All windows of one length of a block: sorted hashes, and the items of each."""

    def __init__(self, hashes: np.ndarray, items: np.ndarray):
        pairs = np.unique(np.rec.fromarrays([hashes, items], names="h,i"))
        self.hashes, self.first = np.unique(pairs.h, return_index=True)
        self.items, self.last = pairs.i.copy(), np.append(self.first[1:], len(pairs))
        self.members = HashSet(self.hashes)

    def items_of(self, hashes: np.ndarray) -> np.ndarray:
        """Items that have any of these windows; all of them must be members."""
        at = np.searchsorted(self.hashes, np.unique(hashes))
        return np.unique(np.concatenate([self.items[self.first[j] : self.last[j]] for j in at])) if len(at) else self.items[:0]


def winnowed(grams: np.ndarray, whole: np.ndarray, width: int) -> np.ndarray:
    """Places of the fingerprints: the rightmost least gram of each run of ``width`` grams that lie in one text."""
    n = len(grams)
    if n < width:
        return np.flatnonzero(whole)[:0]
    least, place = grams[:n - width + 1].copy(), np.arange(n - width + 1)
    inside = whole[: n - width + 1].copy()
    for j in range(1, width):
        other = grams[j : n - width + 1 + j]
        take = other <= least
        least[take] = other[take]
        place[take] = np.flatnonzero(take) + j
        inside &= whole[j : n - width + 1 + j]
    return np.unique(place[inside])


class Block:
    """Index of some benchmark items."""

    def __init__(self, ids: list[str], texts: list[str]):
        self.ids = ids
        self.windows: dict[int, Windows] = {}
        found: dict[int, tuple[list, list]] = {}
        marks = []
        for w in wordhash.words(pa.array(texts, pa.string()), wordhash.ALNUM_FOLDED):
            item = w.first + np.repeat(np.arange(len(w.count)), w.count)
            for n in np.unique(np.minimum(w.count, WINDOW)):
                if n:
                    grams, whole = w.grams(int(n))
                    fits = np.minimum(w.count, WINDOW)[item[: len(grams)] - w.first] == n
                    at = np.flatnonzero(whole & fits)
                    hs, its = found.setdefault(int(n), ([], []))
                    hs.append(grams[at])
                    its.append(item[at])
            grams, whole = w.grams(K)
            marks.append(grams[winnowed(grams, whole, WINDOW - K + 1)])
        for n, (hs, its) in found.items():
            self.windows[n] = Windows(np.concatenate(hs), np.concatenate(its))
        self.marks = HashSet(np.concatenate(marks) if marks else np.zeros(0, np.uint64))

    def find(self, w: wordhash.Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window length, places of windows in ``w`` that occur in the block, their hashes)."""
        for n, windows in self.windows.items():
            grams, whole = w.grams(n)
            if n < WINDOW:
                at = windows.members.where(grams)
            else:
                small, fit = w.grams(K)
                marks = winnowed(small, fit, WINDOW - K + 1)
                hits = marks[self.marks.where(small[marks])]
                # the windows that hold the hit's k-gram
                at = np.unique((hits[:, None] - np.arange(WINDOW - K + 1)[None, :]).ravel())
                at = at[(at >= 0) & (at < len(grams))]
                at = at[windows.members.where(grams[at])]
            at = at[whole[at]]
            if len(at):
                yield n, at, grams[at]


def _merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges, sorted; touching ranges are joined."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(new[1:], True)]


def search(column: pa.Array, block: Block, before: pa.Array | None = None) -> pa.Array:
    """HITS of every text against a block, added to the hits ``before`` with earlier blocks."""
    counts, spans, items = np.zeros(len(column), np.int64), {}, {}
    for w in wordhash.words(column, wordhash.ALNUM_FOLDED):
        counts[w.first : w.first + len(w.count)] = w.count
        for n, at, hashes in block.find(w):
            text = np.searchsorted(w.at, at, side="right") - 1
            cuts = np.flatnonzero(np.diff(text)) + 1
            for part in np.split(np.arange(len(at)), cuts):
                t = int(text[part[0]])
                begin = at[part] - w.at[t]
                spans.setdefault(w.first + t, []).append((begin, begin + n))
                items.setdefault(w.first + t, set()).update(block.windows[n].items_of(hashes[part]).tolist())
    rows = before.to_pylist() if before is not None else [None] * len(column)
    for i, row in enumerate(rows):
        row = row or {"spans": [], "items": []}
        if i in spans:
            old = np.array([(s["start"], s["stop"]) for s in row["spans"]], np.int64).reshape(-1, 2)
            a, b = _merged(np.concatenate([*(x for x, _ in spans[i]), old[:, 0]]), np.concatenate([*(y for _, y in spans[i]), old[:, 1]]))
            row = {"spans": [{"start": int(x), "stop": int(y)} for x, y in zip(a, b, strict=True)], "items": sorted({*row["items"], *(block.ids[j] for j in items[i])})}
        rows[i] = {"n_words": int(counts[i]), "spans": row["spans"], "items": row["items"]}
    return pa.array(rows, _HITS)


def blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """Indexes of the benchmark, a block at a time; the driver holds one block of items."""
    rows = benchmark.where(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    ids, texts, size = [], [], 0
    for r in rows.toLocalIterator():
        n = len(r.text) // 2 + 1  # no text has more words
        if ids and size + n > block_words:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r.id)
        texts.append(r.text)
        size += n
    if ids:
        yield Block(ids, texts)


def with_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", hits: str = "hits", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a struct column ``hits``: n_words, spans (merged word ranges that occur in the benchmark; start, stop) and
    items (ids as strings of the items with an occurring window)."""
    if hits in docs.columns:
        raise ValueError(f"column already there: {hits}")
    out = docs
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(hits, HITS)])
    names = schema.fieldNames()

    def passed(df: DataFrame, block: Broadcast) -> DataFrame:
        later = hits in df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = search(b.column(at), block.value, b.column(len(names) - 1) if later else None)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(names) - 1], found], names=names)

        return map_arrow(df, run, schema)

    for i, block in enumerate(blocks(benchmark, item, item_text, block_words)):
        if i:
            out = written(out, "decontaminate")
        out = passed(out, docs.sparkSession.sparkContext.broadcast(block))
    if out is docs:
        out = passed(docs, docs.sparkSession.sparkContext.broadcast(Block([], [])))
    return out


def n_hit(hits: str = "hits") -> Column:
    """Words of the text inside any occurring window."""
    return F.aggregate(F.col(f"{hits}.spans"), F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])


def contaminated(hits: str = "hits") -> Column:
    """At least a twentieth of the words, and at least one, lies inside occurring windows."""
    return (n_hit(hits) > 0) & (20 * n_hit(hits) >= F.col(f"{hits}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    return with_hits(docs, benchmark, text, item, item_text, "__hits").where(~contaminated("__hits")).drop("__hits")
