"""Canonical Huffman codes of limited length, and vectorised bit packing with checkpoints.

Codes come from global counts by package-merge (optimal under the limit).  A packed block is a run of code words, most
significant bit first, with the bit offset of every ``EVERY``-th symbol; decoding looks the next ``limit`` bits up in one
table and runs all stretches between checkpoints side by side.
"""

from __future__ import annotations

import functools

import numpy as np

LIMIT = 20
EVERY = 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (0 for symbols that do not occur)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    # Each level, the deepest first, has the symbols and the pairs of items of the level below, by weight.  Of the items
    # taken from a level, the leaves are its least symbols; the others stand for twice as many items of the level below.
    leaf_first = [np.ones(len(weights), bool)]
    items = weights
    for _ in range(limit - 1):
        pairs = len(items) // 2
        packed = items[: 2 * pairs].reshape(pairs, 2).sum(1)
        merged = np.concatenate([weights, packed])
        rank = np.argsort(merged, kind="stable")
        leaf_first.append(rank < len(weights))
        items = merged[rank]
    lengths = np.zeros(len(order), np.int64)
    take = 2 * len(order) - 2
    for is_leaf in reversed(leaf_first):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = lengths
    return out


class Code:
    """The canonical code of some lengths: shorter codes first, ties by symbol."""

    def __init__(self, lengths: np.ndarray, limit: int = LIMIT):
        self.lengths, self.limit = lengths.astype(np.uint8), limit

    @functools.cached_property
    def _canonical(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbols in code order, and where each begins in the space of ``limit`` bits."""
        used = np.flatnonzero(self.lengths)
        order = used[np.argsort(self.lengths[used], kind="stable")]
        width = np.int64(1) << (self.limit - self.lengths[order].astype(np.int64))
        return order, np.cumsum(width) - width

    @functools.cached_property
    def words(self) -> np.ndarray:
        order, first = self._canonical
        out = np.zeros(len(self.lengths), np.uint64)
        out[order] = (first >> (self.limit - self.lengths[order].astype(np.int64))).astype(np.uint64)
        return out

    @functools.cached_property
    def table(self) -> np.ndarray:
        """The symbol that any ``limit`` bits begin with."""
        order, first = self._canonical
        out = np.zeros(1 << self.limit, np.uint32)
        for i, symbol in enumerate(order.tolist()):
            out[first[i] : first[i] + (1 << (self.limit - int(self.lengths[symbol])))] = symbol
        return out

    def pack(self, symbols: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The code words of ``symbols``, and the bit offset of every EVERY-th."""
        if not len(symbols):
            return b"", np.zeros(0, np.int64)
        bits = self.lengths[symbols].astype(np.int64)
        if not bits.all():
            raise ValueError("a symbol without a code")
        ends = np.cumsum(bits)
        at = ends - bits
        word, shift = at >> 6, 64 - (at & 63) - bits
        code = self.words[symbols]
        over = np.flatnonzero(shift < 0)
        head = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
        new = np.append(0, np.flatnonzero(np.diff(word)) + 1)
        out = np.zeros(int((ends[-1] + 63) >> 6), np.uint64)
        out[word[new]] = np.add.reduceat(head, new)
        out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[: int(ends[-1] + 7) >> 3], at[::EVERY]

    def unpack(self, packed: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` symbols of a packed block."""
        lanes = len(checkpoints)
        if lanes != -(-n // EVERY):
            raise ValueError("checkpoints do not fit the number of symbols")
        padded = np.frombuffer(packed + b"\0" * 8, np.uint8)
        window = np.ndarray(len(padded) - 3, ">u4", padded, strides=(1,))
        out = np.zeros((EVERY, lanes), np.uint32)
        at, last = checkpoints.astype(np.int64), 8 * len(packed)
        drop = np.uint32(32 - self.limit)
        for i in range(EVERY if lanes > 1 else n):
            seen = (window[at >> 3].astype(np.uint32) << (at & 7).astype(np.uint32)) >> drop
            out[i] = self.table[seen]
            at = np.minimum(at + self.lengths[out[i]], last)  # the last stretch may be short
        return out.T.ravel()[:n]
