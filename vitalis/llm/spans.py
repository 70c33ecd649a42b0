"""Regular-expression matches with their places, as DataFrame functions only.

A span is a struct (start, stop, text) in code points, end exclusive.  Spark's regex functions give the matches and the pieces
between them; a running sum of their lengths gives the places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,stop:int,text:string>>"


def none() -> Column:
    return F.array().cast(SPAN)


#: A running sum over an array copies what it has at each element; over blocks of so many, and over their totals, that stays linear.
BLOCK = 256


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: an expression that is written into a lambda is evaluated at each element."""
    return F.transform(F.array(value), body)[0]


def carried(items: Column, zero: Column, step: Callable[[Column, Column], Column], both: Callable[[Column, Column], Column], make: Callable[[Column, Column], Column], kind: str) -> Column:
    """``make(state, item)``, an array of ``kind``, of all items one behind the other, where ``state`` is ``step`` over the items
    before, from ``zero`` on; ``both`` puts two states together.  Linear in the number of items: blocks are folded, their
    states put together in order, then each block is walked from its own."""

    def blocks_of(held: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(held) - 1) / BLOCK)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(held, i * BLOCK + 1, BLOCK))

    def walked(block: Column, begin: Column) -> Column:
        start = F.struct(begin.alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(block, start, lambda s, x: F.struct(step(s["at"], x).alias("at"), F.concat(s["out"], make(s["at"], x).cast(kind)).alias("out")), lambda s: s["out"])

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, zero, step))
        first = F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out"))
        begins = F.aggregate(totals, first, lambda s, n: F.struct(both(s["at"], n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])
        return F.flatten(F.zip_with(blocks, begins, walked))

    return _bound(_bound(items, blocks_of), joined)


def along(items: Column, measure: Callable[[Column], Column], make: Callable[[Column, Column], Column], kind: str) -> Column:
    """``carried`` with the sum of ``measure`` over the items before."""
    return carried(items, F.lit(0), lambda at, x: at + measure(x), lambda a, b: a + b, make, kind)


def find(text: Column, pattern: str, group: int = 0) -> Column:
    """Spans of all leftmost non-overlapping matches (Java syntax); their ``text`` is the match, or one of its groups.

    The pattern must not match the empty string.  Guard it with a cheap test of the text where matches are rare."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    texts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    items = F.filter(F.arrays_zip(matches.alias("match"), texts.alias("text"), F.split(text, pattern, -1).alias("before")), lambda x: x["match"].isNotNull())

    def span(at: Column, x: Column) -> Column:
        begin = at + F.length(x["before"])
        return F.array(F.struct(begin.alias("start"), (begin + F.length(x["match"])).alias("stop"), x["text"].alias("text")))

    return along(items, lambda x: F.length(x["before"]) + F.length(x["match"]), span, SPAN)


def found(text: Column, gate: Column, pattern: str, keep=None, group: int = 0) -> Column:
    """``find`` where ``gate`` holds, else no spans; ``keep`` filters them."""
    spans = find(text, pattern, group)
    return F.when(gate, F.filter(spans, keep) if keep else spans).otherwise(none())


def listed(kinds: dict[str, Column]) -> Column:
    """kind:start:end of all spans by start, then in the order of ``kinds``, comma-joined."""
    parts = [_tagged(spans, n, kind) for n, (kind, spans) in enumerate(kinds.items())]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _tagged(spans: Column, n: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("n"), s["stop"].alias("stop"), F.lit(kind).alias("kind")))
