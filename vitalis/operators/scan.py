"""Ordered scan: what a window over a whole key computes, in segments of about equal size.

``Window.partitionBy(key).orderBy(time)`` makes one task of each key, and a calendar segment (a day) one task of each day.
Here the order of all rows, by key and then by the order columns, is cut at sampled splitters into ``2 ** bits``
segments.  A window runs inside each (segment, key); each (segment, key) is folded to one carry (its last row, its sum, its
count); the carries of a key are put together in order; and the rows take what all earlier segments of their key carry.

* The splitters are a scalar subquery over the rows with the least hashes of (key, order columns): a bounded sample that is
  the same however the rows lie, so every part of a plan cuts alike, and no job runs while a plan is built.  A row finds
  its segment by a search in ``bits / 2`` steps of three comparisons, inside generated code.
* Rows are moved once, by (segment, key).  Only folds are grouped besides.
* A boundary lies inside one key at most, so at most ``2 ** bits - 1`` pairs of segment and key have anything carried to
  them: the join with the carries is a broadcast of a proven size, whatever the number of rows or keys.

Rows that are equal in key and all order columns share a segment (they are interchangeable; drop duplicates first if most rows
are one row).  Order columns ascend, nulls first; pass ``-column`` for a descending number.  Null keys are a key.  Empty input
gives empty output.  Names beginning with ``_scan`` are used inside.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 8
#: Sampled rows for each segment.
SAMPLE = 16
SEG = "_scan_segment"


def _keys(key: Sequence[str] | str) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def splitters(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column | str], bits: int = BITS) -> DataFrame:
    """One row, one array of ``2 ** bits - 1`` points (key and order columns), ascending; the last may be null."""
    point = _point(_keys(key), _columns(order))
    sample = df.select(point.alias("p")).withColumn("h", F.xxhash64("p")).orderBy("h").limit(SAMPLE << bits)
    held = sample.agg(F.array_sort(F.collect_list("p")).alias("s"))
    at = F.transform(F.sequence(F.lit(1), F.lit((1 << bits) - 1)), lambda i: F.get("s", F.shiftright(i * F.size("s"), bits)))
    return held.select(at.alias("s"))


def _point(keys: Sequence[str], order: Sequence[Column]) -> Column:
    return F.struct(*(c.alias(f"c{i}") for i, c in enumerate([*map(F.col, keys), *order])))


def segmented(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column | str], bits: int = BITS, name: str = SEG) -> DataFrame:
    """``df`` with the number of its segment: how many splitters are before the row."""
    cuts = splitters(df, key, order, bits)
    out = df.withColumn("_scan_point", _point(_keys(key), _columns(order))).withColumn("_scan_cuts", cuts.scalar()).withColumn(name, F.lit(0))
    left = bits
    while left:  # four ways at a time
        ways = 2 if left % 2 else 4
        left -= ways // 2
        here = F.col(name)
        for i in range(1, ways):
            before = F.get("_scan_cuts", F.col(name) + ((i << left) - 1)) < F.col("_scan_point")
            here = here + F.when(before, 1 << left).otherwise(0)
        out = out.withColumn(name, here)
    return out.drop("_scan_point", "_scan_cuts")


def _carried(folds: DataFrame, keys: Sequence[str], carry: Mapping[str, Column], bits: int) -> DataFrame:
    """``folds`` has a row for each segment and key; the rows to which ``carry`` (expressions over the key's segments in order)
    brings something, for a broadcast: at most one for each splitter."""
    ranked = folds.select(*keys, SEG, *(c.alias(n) for n, c in carry.items()))
    some = F.coalesce(*(F.when(F.col(n).isNotNull(), True) for n in carry))
    return F.broadcast(ranked.where(some).select(*(F.col(k).alias(f"_scan_k{i}") for i, k in enumerate(keys)), F.col(SEG).alias("_scan_at"), *carry))


def _applied(rows: DataFrame, keys: Sequence[str], carried: DataFrame) -> DataFrame:
    on = F.col(SEG) == F.col("_scan_at")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_scan_k{i}"))
    return rows.join(carried, on, "left").drop("_scan_at", *(f"_scan_k{i}" for i in range(len(keys))))


def shift(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column | str], cols: Sequence[str], direction: str = "lag", prefix: str | None = None, bits: int = BITS) -> DataFrame:
    """``LAG`` or ``LEAD`` of ``cols`` OVER (PARTITION BY key ORDER BY order), as ``prefix`` + name."""
    keys, by, lag = _keys(key), _columns(order), direction == "lag"
    prefix = prefix if prefix is not None else ("prev_" if lag else "next_")
    payload = F.struct(*cols)
    rows = segmented(df, keys, by, bits)
    folds = rows.groupBy(SEG, *keys).agg((F.max_by if lag else F.min_by)(payload, F.struct(*(c.alias(f"c{i}") for i, c in enumerate(by)))).alias("_scan_edge"))
    along = Window.partitionBy(*keys).orderBy(F.col(SEG))
    carried = _carried(folds, keys, {"_scan_carry": (F.lag if lag else F.lead)("_scan_edge").over(along)}, bits)
    inside = Window.partitionBy(SEG, *keys).orderBy(*by)
    rows = rows.withColumn("_scan_own", (F.lag if lag else F.lead)(payload).over(inside))
    rows = _applied(rows, keys, carried).withColumn("_scan_own", F.coalesce("_scan_own", "_scan_carry"))
    return rows.select(*(F.col(c) for c in df.columns), *(F.col("_scan_own")[c].alias(prefix + c) for c in cols))


@dataclass(frozen=True)
class Fold:
    """A running value: ``kind`` is sum, count, min, max or last (the last value that is not null); ``value`` what is folded.
    ``own``: whether a row's own value is in its result."""

    kind: str
    value: Column
    own: bool = True

    def over(self) -> Column:
        return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "last": lambda v: F.last(v, ignorenulls=True)}[self.kind](self.value)

    def total(self, point: Column) -> Column:
        """The fold of a whole segment."""
        return F.max_by(self.value, F.when(self.value.isNotNull(), point)) if self.kind == "last" else self.over()

    def ahead(self, name: str, along) -> Column:
        """The totals of all earlier segments together; null if there are none."""
        c = F.col(name)
        together = {"sum": F.sum(c), "count": F.sum(c), "min": F.min(c), "max": F.max(c), "last": F.last(c, ignorenulls=True)}[self.kind]
        return together.over(along.rowsBetween(Window.unboundedPreceding, -1))

    def joined(self, carry: Column, inside: Column) -> Column:
        if self.kind == "count":
            return F.coalesce(carry, F.lit(0)) + inside
        both = {"sum": carry + inside, "min": F.least(carry, inside), "max": F.greatest(carry, inside), "last": inside}[self.kind]
        return F.coalesce(both, inside, carry)


def running(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column | str], folds: Mapping[str, Fold], bits: int = BITS) -> DataFrame:
    """``df`` with running values by name: each ``fold(...) OVER (PARTITION BY key ORDER BY order ROWS UNBOUNDED PRECEDING)``, up to
    the row before where the fold leaves its own row out."""
    keys, by = _keys(key), _columns(order)
    point = F.struct(*(c.alias(f"c{i}") for i, c in enumerate(by)))
    rows = segmented(df, keys, by, bits)
    totals = rows.groupBy(SEG, *keys).agg(*(f.total(point).alias(f"_scan_{n}") for n, f in folds.items()))
    along = Window.partitionBy(*keys).orderBy(F.col(SEG))
    carried = _carried(totals, keys, {f"_scan_{n}": f.ahead(f"_scan_{n}", along) for n, f in folds.items()}, bits)
    inside = Window.partitionBy(SEG, *keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = _applied(rows.select("*", *(f.over().over(inside if f.own else before).alias(f"_scan_own_{n}") for n, f in folds.items())), keys, carried)
    return rows.select(*(F.col(c) for c in df.columns), *(f.joined(F.col(f"_scan_{n}"), F.col(f"_scan_own_{n}")).alias(n) for n, f in folds.items()))


def ranked(df: DataFrame, key: Sequence[str] | str, order: Sequence[Column | str], name: str = "rank", kind: str = "rank", bits: int = BITS) -> DataFrame:
    """``RANK`` or ``ROW_NUMBER`` OVER (PARTITION BY key ORDER BY order): the rows of all earlier segments of the key, and the
    rank inside.  Equal rows share a segment, so a rank never crosses one."""
    keys, by = _keys(key), _columns(order)
    rows = segmented(df, keys, by, bits)
    counts = rows.groupBy(SEG, *keys).agg(F.count(F.lit(1)).alias("_scan_n"))
    along = Window.partitionBy(*keys).orderBy(F.col(SEG)).rowsBetween(Window.unboundedPreceding, -1)
    carried = _carried(counts, keys, {"_scan_ahead": F.sum("_scan_n").over(along)}, bits)
    inside = {"rank": F.rank, "row_number": F.row_number}[kind]().over(Window.partitionBy(SEG, *keys).orderBy(*by))
    rows = _applied(rows.withColumn("_scan_own", inside), keys, carried)
    return rows.select(*(F.col(c) for c in df.columns), (F.coalesce("_scan_ahead", F.lit(0)) + F.col("_scan_own")).alias(name))


def sessions_from(df: DataFrame, key: Sequence[str] | str, ts: str, opens, tiebreak: Sequence[Column | str] = (), previous: str = "previous_time", start: str = "session_start", bits: int = BITS) -> DataFrame:
    """Islands: ``df`` with the time of the row before (``previous``) and the first time of the row's island (``start``).  ``opens``
    says from (previous time, own time) whether a row begins an island.  Both come from one segmentation: the island
    starts inside a segment need only the carried last time and the carried last start, where that is not the segment's own."""
    keys, by = _keys(key), _columns([ts, *tiebreak])
    rows = segmented(df, keys, by, bits)
    inside = Window.partitionBy(SEG, *keys).orderBy(*by)
    rows = rows.withColumn("_scan_prev", F.lag(ts).over(inside)).withColumn("_scan_head", F.row_number().over(inside) == 1)
    # a segment's first row opens an island or not once the time before it is known; all others are settled here
    own = F.when(~F.col("_scan_head") & opens(F.col("_scan_prev"), F.col(ts)), F.col(ts))
    rows = rows.withColumn("_scan_start", F.last(own, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    folds = rows.groupBy(SEG, *keys).agg(F.min(ts).alias("_scan_first"), F.max(ts).alias("_scan_last"), F.max("_scan_start").alias("_scan_latest"))
    along = Window.partitionBy(*keys).orderBy(F.col(SEG))
    folds = folds.withColumn("_scan_edge", F.lag("_scan_last").over(along))
    opened = F.when(F.col("_scan_edge").isNull() | opens(F.col("_scan_edge"), F.col("_scan_first")), F.col("_scan_first"))
    folds = folds.withColumn("_scan_opened", opened)
    # the start that holds at the segment's first row
    entry = F.last("_scan_so_far", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))
    folds = folds.withColumn("_scan_so_far", F.coalesce("_scan_latest", "_scan_opened")).withColumn("_scan_entry", F.coalesce("_scan_opened", entry))
    # (a key's first segment has no edge: its first row opens an island, which needs no carry)
    carried = _carried(folds.where(F.col("_scan_edge").isNotNull()), keys, {"_scan_edge_": F.col("_scan_edge"), "_scan_entry_": F.col("_scan_entry")}, bits)
    rows = rows.withColumn("_scan_lead", F.first(ts).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = _applied(rows, keys, carried)
    previous_time = F.when(F.col("_scan_head"), F.col("_scan_edge_")).otherwise(F.col("_scan_prev"))
    return rows.select(*(F.col(c) for c in df.columns), previous_time.alias(previous), F.coalesce("_scan_start", "_scan_entry_", "_scan_lead").alias(start))


def asof(left: DataFrame, right: DataFrame, key: Sequence[str] | str, left_ts: str, right_ts: str, values: Sequence[str], strict: bool = True, prefix: str = "prev_", bits: int = BITS) -> DataFrame:
    """For each left row the latest right row of its key with ``right_ts < left_ts`` (``<=`` unless ``strict``); of right rows of one
    time the one with the largest values.  Both sides are one ordered union, the last right row is the running value."""
    keys, cols = _keys(key), [right_ts, *values]
    lcols = [c for c in left.columns if c not in keys]
    seen = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(cols)))
    nothing = F.lit(None)
    l = left.select(*keys, F.struct(*lcols).alias("_scan_left"), F.col(left_ts).alias("_scan_t"), F.lit(0 if strict else 1).alias("_scan_side"), nothing.cast(right.select(seen.alias("x")).schema["x"].dataType).alias("_scan_right"))
    r = right.select(*keys, nothing.cast(l.schema["_scan_left"].dataType).alias("_scan_left"), F.col(right_ts).alias("_scan_t"), F.lit(1 if strict else 0).alias("_scan_side"), seen.alias("_scan_right"))
    u = running(l.unionByName(r), keys, ["_scan_t", "_scan_side", "_scan_right"], {"_found": Fold("last", F.col("_scan_right"))}, bits)
    # among left rows of one time only the order of their right-hand sides is fixed, and that is null for all
    u = u.where(F.col("_scan_left").isNotNull())
    back = [F.col(c) if c in keys else F.col("_scan_left")[c].alias(c) for c in left.columns]
    return u.select(*back, *(F.col("_found")[f"c{i}"].alias(prefix + c) for i, c in enumerate(cols)))
