"""Splitting of texts into the pieces that byte-level BPE merges within, and a bounded memo of pieces.

The pattern is fixed by the vocabularies:

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

A text is split by the classes of its code points (letter, number, space, other) with numpy: a piece begins where the class
changes, except that the last blank before a piece joins it; of a longer run of spaces, all but the last are one piece; the
seven contractions are found where an apostrophe begins a piece.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

from vitalis.llm import wordhash

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_SAFE = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, points):
            a, b = ord(points[m.start()]), ord(points[m.end() - 1])
            out[a : b + 1] = kind  # a run across the surrogates would mark only code points that no text has
    # code points younger than this Python's Unicode tables: as the tokenizers library has them
    young = [c for c in np.flatnonzero((out == LETTER) | (out == NUMBER)).tolist() if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"]
    cuts = {a for _, (a, _) in ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str("".join(f"a{chr(c)}1" for c in young))}
    for i, c in enumerate(young):
        out[c] = LETTER if 3 * i + 1 not in cuts else NUMBER if 3 * i + 2 not in cuts else OTHER
    return out


_ONE = np.frombuffer("stmd".encode("utf-32-le"), np.uint32)
_TWO = [tuple(map(ord, t)) for t in ("re", "ve", "ll")]


def _begins(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Marks where a piece begins, for sections of text that lie one behind the other from ``heads`` on; none is empty."""
    n = len(points)
    kind = classes()[points]
    begin = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=begin[1:])
    head = np.zeros(n + 1, bool)
    head[heads] = True
    begin |= head[:n]
    space = kind == SPACE
    # the last space of a run, when a non-space follows: a blank goes to that piece, another space stands alone
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~head[1:n])
    begin[last] = True
    begin[last[points[last] == 0x20] + 1] = False
    quotes = np.flatnonzero((points == 0x27) & begin)
    if len(quotes):
        first, second = quotes + 1, quotes + 2
        inside = (first < n) & ~head[np.minimum(first, n)]
        c1 = points[np.minimum(first, n - 1)]
        one = inside & np.isin(c1, _ONE)
        inside &= (second < n) & ~head[np.minimum(second, n)]
        c2 = points[np.minimum(second, n - 1)]
        two = np.zeros(len(quotes), bool)
        for a, b in _TWO:
            two |= (c1 == a) & (c2 == b)
        two &= inside
        begin[first[one | two]] = False
        after = np.concatenate([quotes[one] + 2, quotes[two] + 3])
        begin[after[after < n]] = True
    return begin


def starts(text: str) -> list[int]:
    """Where the pieces of ``text`` begin."""
    if not text:
        return []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.flatnonzero(_begins(points, np.zeros(1, np.int64))).tolist()


def split(text: str) -> list[str]:
    at = starts(text)
    return [text[a:b] for a, b in zip(at, [*at[1:], len(text)], strict=True)] if at else []


def _room(x: np.ndarray, used: int, need: int) -> np.ndarray:
    """``x`` with places for ``need`` values; new places are not written, so they take no memory yet."""
    if need <= len(x):
        return x
    out = np.empty(max(need, 2 * len(x)), x.dtype)
    out[:used] = x[:used]
    return out


class _Store:
    """Byte strings or ids of many entries in one array that grows; entry i is ``flat[at[i]:at[i + 1]]``."""

    def __init__(self, unit: str):
        self.flat, self.at, self.count = np.zeros(1 << 12, unit), np.zeros(1 << 10, np.int64), 0

    def add(self, new: np.ndarray, sizes: np.ndarray) -> None:
        """Entries that lie one behind the other in ``new``."""
        used, count = int(self.at[self.count]), self.count + len(sizes)
        self.flat = _room(self.flat, used, used + len(new))
        self.at = _room(self.at, self.count + 1, count + 1)
        self.flat[used : used + len(new)] = new
        self.at[self.count + 1 : count + 1] = used + np.cumsum(sizes)
        self.count = count

    def sizes(self, entries: np.ndarray) -> np.ndarray:
        return self.at[entries + 1] - self.at[entries]

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``entries`` one behind the other, and where each ends."""
        sizes = self.sizes(entries)
        return _ranges(self.flat, self.at[entries], sizes), np.cumsum(sizes)


def _ranges(data: np.ndarray, lo: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of ranges of ``data`` one behind the other."""
    ends = np.cumsum(sizes)
    return data[np.repeat(lo - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Memo:
    """piece -> ids, computed by ``encode`` (pieces to a sequence of ids each) for pieces not seen yet.

    Pieces of many texts are found, hashed and looked up with numpy: a hash table with open places from a hash of the
    piece's bytes to its entry, widened as pieces come.  The bytes of an entry are compared with those of the piece, so a hash that two pieces
    share changes nothing.  Emptied when more than ``limit`` pieces would be held, so that it stays bounded; every piece is
    encoded in full either way.  ``unit``: the type of an id.  ``special``: strings that are one piece wherever they stand;
    the leftmost, then the longest one counts."""

    CHUNK, SECTION = 1 << 17, 1 << 20

    def __init__(self, encode: Callable[[list[str]], Iterable[Sequence[int]]], limit: int = 400_000, unit: str = "u1", special: Iterable[str] = ()):
        self.encode, self.limit, self.unit = encode, limit, unit
        self.special = sorted(special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._clear()

    def _clear(self) -> None:
        self.held = 0
        self._open(10)
        self.pieces, self.values = _Store("u1"), _Store(self.unit)
        self.odd: dict[str, int] = {}  # pieces whose hash another piece has

    def _open(self, bits: int) -> None:
        self.bits = bits
        self.slot_hash, self.slot_entry = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def ids(self, text: str) -> bytes:
        return self.ids_of([text])[0].tobytes()

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``texts`` one behind the other, and how many each text has."""
        counts = np.zeros(len(texts), np.int64)
        out, held, owners, forced, total = [], [], [], [], 0

        def flush() -> None:
            nonlocal held, owners, forced, total
            if held:
                ids, sizes = self._chunk(held, np.array(forced, bool))
                np.add.at(counts, owners, sizes)
                out.append(ids)
            held, owners, forced, total = [], [], [], 0

        for i, t in enumerate(texts):
            for section, special in self._sections(t):
                held.append(section)
                owners.append(i)
                forced.append(special)
                total += len(section)
                if total >= self.CHUNK:
                    flush()
        flush()
        return np.concatenate(out) if out else np.zeros(0, self.unit), counts

    def _sections(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of a text that can be split on their own: special strings, and long texts cut before a blank between two letters
        or digits, where a piece always ends."""
        cut = self._cut is not None and any(s in text for s in self.special)
        for k, part in enumerate(self._cut.split(text) if cut else (text,)):
            if k % 2:
                yield part, True
                continue
            at = 0
            while len(part) - at > self.SECTION and (m := _SAFE.search(part, at + self.SECTION)):
                yield part[at : m.start()], False
                at = m.start()
            if at < len(part):
                yield part[at:] if at else part, False

    def _chunk(self, sections: list[str], forced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sections one behind the other, and how many each has."""
        text = "".join(sections)
        sizes = np.fromiter(map(len, sections), np.int64, len(sections))
        ends = np.cumsum(sizes)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        begin = _begins(points, ends - sizes)
        for k in np.flatnonzero(forced):
            begin[ends[k] - sizes[k] + 1 : ends[k]] = False
        at = np.flatnonzero(begin)
        at = np.append(at, len(points))
        if len(data) == len(points):
            byte_at = at
        else:
            width = np.ones(len(points), np.int64)
            for least in (0x80, 0x800, 0x10000):
                width += points >= least
            byte_at = np.concatenate([[0], np.cumsum(width)])[at]
        hashes = self._hashes(data, byte_at)
        entries = self._found(hashes)
        self._compare(entries, data, byte_at)
        new = np.flatnonzero(entries < 0)
        if len(new):
            self._learn(text, at, data, byte_at, hashes, entries, new)
        ids, id_ends = self.values.gather(entries)
        upto = np.concatenate([[0], id_ends])[np.searchsorted(at, ends)]
        return ids, np.diff(upto, prepend=0)

    @staticmethod
    def _hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return wordhash.ranges(data, at[:-1], at[1:])

    def _found(self, hashes: np.ndarray) -> np.ndarray:
        """The entry with each hash, -1 for none."""
        mask = np.uint64((1 << self.bits) - 1)
        slot = (hashes & mask).astype(np.int64)
        entries = self.slot_entry[slot].astype(np.int64)
        open_ = np.flatnonzero((entries >= 0) & (self.slot_hash[slot] != hashes))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & int(mask)
            entries[open_] = self.slot_entry[slot[open_]]
            open_ = open_[(entries[open_] >= 0) & (self.slot_hash[slot[open_]] != hashes[open_])]
        return entries

    def _compare(self, entries: np.ndarray, data: np.ndarray, at: np.ndarray) -> None:
        """Sets entries whose bytes are not the piece's to -1."""
        sizes = np.diff(at)
        entries[(entries >= 0) & (self.pieces.sizes(entries) != sizes)] = -1
        known = np.flatnonzero(entries >= 0)
        held, ends = self.pieces.gather(entries[known])
        if len(known) < len(entries):
            data = data[np.repeat(entries >= 0, sizes)]
        wrong = np.flatnonzero(held != data)
        if len(wrong):
            entries[known[np.unique(np.searchsorted(ends, wrong, side="right"))]] = -1

    def _learn(self, text: str, at: np.ndarray, data: np.ndarray, byte_at: np.ndarray, hashes: np.ndarray, entries: np.ndarray, new: np.ndarray) -> None:
        """Encodes the pieces at ``new`` that are not known, keeps them and sets their entries."""
        names = [text[a:b] for a, b in zip(at[new].tolist(), at[new + 1].tolist(), strict=True)]
        if self.odd:
            kept = np.array([self.odd.get(p, -1) for p in names])
            entries[new[kept >= 0]] = kept[kept >= 0]
            new, names = new[kept < 0], [p for p, k in zip(names, kept, strict=True) if k < 0]
        place: dict[str, int] = {}
        which = np.fromiter((place.setdefault(p, len(place)) for p in names), np.int64, len(names))
        if self.held + len(place) > self.limit and self.held:
            self._clear()
            return self._learn(text, at, data, byte_at, hashes, entries, np.arange(len(entries)))
        first = np.zeros(len(place), np.int64)
        first[which[::-1]] = new[::-1]
        found = list(self.encode(list(place)))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.values.add(np.fromiter(chain.from_iterable(found), self.unit, int(sizes.sum())), sizes)
        sizes = byte_at[first + 1] - byte_at[first]
        self.pieces.add(_ranges(data, byte_at[first], sizes), sizes)
        entries[new] = self.held + which
        self._insert(list(place), hashes[first], self.held + np.arange(len(place)))
        self.held += len(place)

    def _insert(self, names: list[str], hashes: np.ndarray, entry: np.ndarray) -> None:
        taken = self._found(hashes) >= 0
        _, first = np.unique(hashes, return_index=True)
        again = np.ones(len(names), bool)
        again[first] = False
        for k in np.flatnonzero(taken | again):
            self.odd[names[k]] = int(entry[k])
        fresh = ~taken & ~again
        if (bits := (2 * (self.held + len(names))).bit_length()) > self.bits:
            full = np.flatnonzero(self.slot_entry >= 0)
            known, at = self.slot_hash[full], self.slot_entry[full]
            self._open(bits)
            self._place(known, at)
        self._place(hashes[fresh], entry[fresh])

    def _place(self, hashes: np.ndarray, entry: np.ndarray) -> None:
        """Gives each entry the next free slot from its hash on."""
        waiting = np.arange(len(entry))
        slot = (hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        while len(waiting):
            free = waiting[self.slot_entry[slot[waiting]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            free = free[first]
            self.slot_entry[slot[free]], self.slot_hash[slot[free]] = entry[free], hashes[free]
            waiting = waiting[self.slot_entry[slot[waiting]] != entry[waiting]]
            slot[waiting] = (slot[waiting] + 1) & ((1 << self.bits) - 1)
