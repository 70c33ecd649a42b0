"""Word and shingle hashes of whole Arrow string columns, vectorised with numpy.

A batch of texts is hashed straight from its Arrow buffer: every maximal run of word bytes gets a 64-bit polynomial
hash (prefix sums, so the cost is linear in bytes and no Python object is made per word).  Texts are taken in chunks
of about ``CHUNK_BYTES``; a longer text is a chunk of its own, so memory is bounded by the longest text.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: One random 64-bit value per byte and odd factors for the places of a shingle.
_RNG = np.random.default_rng(20240601)
_BYTE = _RNG.integers(1, 1 << 64, 256, dtype=np.uint64)
_PLACE = _RNG.integers(1, 1 << 64, 64, dtype=np.uint64) | _U(1)


def _byte_map(is_word, fold: bool) -> np.ndarray:
    """256 entries: 0 for a byte between words, else the byte that stands for it."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        if is_word(b):
            out[b] = b + 32 if fold and 65 <= b <= 90 else b
    return out


def _alnum(b: int) -> bool:
    return b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122


def _visible(b: int) -> bool:
    return not (b == 0x20 or 0x09 <= b <= 0x0D)


#: Words of letters, digits and non-ASCII characters, A-Z lowered.
ALNUM_FOLDED = _byte_map(_alnum, True)
#: Words between white space.  The byte 0 is a word byte too; it is moved to 0xFF, which UTF-8 never uses.
SPACED = _byte_map(_visible, False)
SPACED[0] = 0xFF
SPACED_FOLDED = _byte_map(_visible, True)
SPACED_FOLDED[0] = 0xFF

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES * 2)
        for i, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x = x * _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def per_text(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` over each range ``at[i]:at[i + 1]`` (empty ranges give 0)."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


@dataclass
class Words:
    """Hashes of the words of consecutive texts; text i has words ``at[i]:at[i + 1]``."""

    first: int
    hashes: np.ndarray
    at: np.ndarray
    starts: np.ndarray  # byte offset of each word in ``data``
    ends: np.ndarray
    data: np.ndarray
    bytes_at: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.at)

    def grams(self, k: int, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they all lie in one text."""
        h = self.hashes
        n = len(h)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = h[: n - k + 1] * _PLACE[0]
        for j in range(1, k):
            out += h[j : n - k + 1 + j] * _PLACE[j]
        text = np.repeat(np.arange(len(self.at) - 1), self.count)
        return mix(out + _U(k)), text[: n - k + 1] == text[k - 1 :]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) of runs of texts of about CHUNK_BYTES."""
    if not len(column):
        return
    data, offsets = buffers(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges of bytes, none of which is empty."""
    n = len(data)
    up, down = _powers(max(n, 1))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n] if n else np.zeros(0, np.uint64), out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def words(column: pa.Array, byte_map: np.ndarray) -> Iterator[Words]:
    for first, data, at in chunks(column):
        n = len(data)
        b = byte_map[data]
        inside = b != 0
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        heads = at[:-1][at[:-1] < at[1:]]
        begin[heads] = inside[heads]
        starts = np.flatnonzero(begin)
        stop = np.empty(n, bool)
        if n:
            stop[:-1] = inside[:-1] & (~inside[1:] | begin[1:])
            stop[-1] = inside[-1]
        ends = np.flatnonzero(stop) + 1
        hashes = ranges(b, starts, ends)
        yield Words(first, hashes, np.searchsorted(starts, at), starts, ends, data, at)
