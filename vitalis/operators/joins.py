"""Time-aware joins between sensor streams and events.

Spark has no range-join strategy: a join on ``patient AND t BETWEEN a AND b``
plans as a hash join on the patient alone followed by a filter over every pair
of that patient's rows.  With a handful of heavy patients that is both a
quadratic blow-up and a skewed shuffle.  The operators below keep the join an
equi-join on a well-spread key and apply the exact predicate afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitalis.functions.time import micros_between, trunc_hour
from vitalis.operators import scan
from vitalis.operators.windows import segment_of


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(ts) -> Column:
    return micros_between(_epoch(), F.col(ts) if isinstance(ts, str) else ts)


def _us(d: timedelta) -> int:
    return int(d / timedelta(microseconds=1))


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _window_pred(d: Column, lo: int, hi: int, closed: str) -> Column:
    left = d >= lo if closed in ("both", "left") else d > lo
    right = d <= hi if closed in ("both", "right") else d < hi
    return left & right


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str] | str,
    left_ts: str,
    right_ts: str,
    lo: timedelta,
    hi: timedelta,
    closed: str = "both",
) -> DataFrame:
    """Rows of ``right`` whose ``right_ts`` lies in ``[left_ts+lo, left_ts+hi]``.

    Both sides get a bucket number with bucket length = window length, so a
    window touches at most two buckets: each left row is emitted into those
    (<= 2 copies), each right row sits in exactly one, the join is an
    equi-join on ``(key, bucket)`` and the exact predicate runs after it.  No
    pair is produced twice, no pair is missed.  Column names other than
    ``key`` must differ between the two sides.
    """
    keys = _keys(key)
    lo_us, hi_us = _us(lo), _us(hi)
    width = max(hi_us - lo_us, 1)
    lm = epoch_micros(left_ts)
    lb = F.explode(F.sequence(F.floor((lm + lo_us) / width), F.floor((lm + hi_us) / width)))
    lx = left.withColumn("_bkt", lb)
    rx = right.withColumn("_bkt", F.floor(epoch_micros(right_ts) / width))
    j = lx.join(rx, on=keys + ["_bkt"], how="inner")
    d = micros_between(F.col(left_ts), F.col(right_ts))
    return j.where(_window_pred(d, lo_us, hi_us, closed)).drop("_bkt")


def anti_join_within(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str] | str,
    left_ts: str,
    right_ts: str,
    lo: timedelta,
    hi: timedelta,
    closed: str = "both",
) -> DataFrame:
    """Rows of ``left`` with *no* ``right`` row in ``[left_ts+lo, left_ts+hi]``.

    Two steps (W4): the bucketed interval join finds the (key, left_ts) that
    do have a partner; a ``left_anti`` on those removes them.  Anti-joining the
    exploded rows directly would be wrong: the bucket copy without a partner
    would survive.
    """
    keys = _keys(key)
    probe = left.select(*keys, left_ts).distinct()
    r = right.select(*keys, F.col(right_ts).alias("_rts"))
    hit = interval_join(probe, r, keys, left_ts, "_rts", lo, hi, closed).select(*keys, left_ts).distinct()
    return left.join(hit, on=keys + [left_ts], how="left_anti")


def hour_bin_join(facts: DataFrame, bins: DataFrame, key, ts: str, bin_col: str, how: str = "left") -> DataFrame:
    """``ts >= h AND ts < h + 1 hour`` for an hour-truncated ``h``
    is the same predicate as ``date_trunc('hour', ts) = h``; written that way
    it becomes an equi-join on (key, hour) instead of a per-patient filter."""
    keys = _keys(key)
    f = facts.withColumn("_hour", trunc_hour(ts))
    b = bins.withColumnRenamed(bin_col, "_hour")
    return f.join(b, on=keys + ["_hour"], how=how).drop("_hour")


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str] | str,
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    strict: bool = True,
    prefix: str = "prev_",
    segment: str | None = None,
) -> DataFrame:
    """For each left row, the latest right row with ``right_ts < left_ts``
    (``<=`` when ``strict`` is False) of the same key - a LATERAL ... ORDER BY
    ... DESC LIMIT 1 without the nested loop.  Among right rows with equal
    times the one with the largest values is taken.  NULL keys match nothing.

    By default one ordered scan over the union of both sides (``scan.asof``).  With ``segment``, day-segmented: (1) within each
    (key, day) the left and right rows are merged in time order and the last
    right value is carried forward; (2) left rows that found nothing that day
    take the last right row of the nearest earlier day that has one, read from
    a small per-(key, day) summary.  Output: left columns + ``prefix``+values
    and ``prefix``+right_ts.
    """
    keys = _keys(key)
    right = right.dropna(subset=keys)
    if segment is None:
        return scan.asof(left, right, keys, left_ts, right_ts, values, strict, prefix)
    cols = [right_ts, *values]
    out_names = [prefix + c for c in cols]
    lcols = left.columns
    # side: strict -> left row sorts before an equal-time right row (not visible); else after
    lside, rside = (0, 1) if strict else (1, 0)
    l = left.select(
        *[F.col(c) for c in lcols],
        F.col(left_ts).alias("_t"),
        F.lit(lside).alias("_side"),
        *[F.lit(None).alias("_v_" + c) for c in cols],
    )
    r_payload = right.select(*keys, *[F.col(c).alias("_v_" + c) for c in cols], F.col(right_ts).alias("_t"))
    rr = r_payload.select(
        *[(F.col(c) if c in keys else F.lit(None).cast(left.schema[c].dataType)).alias(c) for c in lcols],
        "_t",
        F.lit(rside).alias("_side"),
        *["_v_" + c for c in cols],
    )
    u = l.unionByName(rr).withColumn("_day", segment_of("_t", segment))

    # equal-time right rows: the one with the largest values counts as latest (documented tie-break)
    vcols = [F.col("_v_" + c) for c in cols]
    w = W.partitionBy(*keys, "_day").orderBy("_t", "_side", *vcols).rowsBetween(W.unboundedPreceding, -1)
    # carry the whole right row as one struct so all values come from the same row
    u = u.withColumn("_rv", F.when(F.col("_side") == rside, F.struct(*["_v_" + c for c in cols])))
    u = u.withColumn("_prev", F.last("_rv", ignorenulls=True).over(w))
    lefts = u.where(F.col("_side") == lside)
    # previous-day carry from a per-(key, day) summary of the right side
    per_day = r_payload.groupBy(*keys, segment_of("_t", segment).alias("_day")).agg(
        F.max_by(F.struct(*["_v_" + c for c in cols]), F.struct("_t", *["_v_" + c for c in cols])).alias("_last")
    )
    # query days sort before the same day's summary row, so "preceding rows" are
    # exactly the earlier days: one small window, no extra aggregation
    days = lefts.select(*keys, "_day").distinct()
    days = days.withColumn("_last", F.lit(None).cast(per_day.schema["_last"].dataType)).withColumn("_q", F.lit(0))
    grid = per_day.withColumn("_q", F.lit(1)).unionByName(days)
    wd = W.partitionBy(*keys).orderBy("_day", "_q").rowsBetween(W.unboundedPreceding, -1)
    carry = grid.withColumn("_carry", F.last("_last", ignorenulls=True).over(wd)).where(F.col("_q") == 0)
    carry = carry.select(*keys, "_day", "_carry")
    res = lefts.join(carry, on=keys + ["_day"], how="left")
    pick = F.coalesce(F.col("_prev"), F.col("_carry"))
    return res.select(*[F.col(c) for c in lcols], *[pick["_v_" + c].alias(n) for c, n in zip(cols, out_names)])


def first_in_window(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str] | str,
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    lo: timedelta,
    hi: timedelta,
    closed: str = "both",
    prefix: str = "next_",
    last: bool = False,
) -> DataFrame:
    """First (or last) right row inside ``[left_ts+lo, left_ts+hi]``,
    LEFT-joined back to every left row (NULL when none) - the LATERAL ... ORDER
    BY ... ASC LIMIT 1 with a bounded tolerance.  Bounded window -> bucketed
    interval join + ``min_by`` per left row.  ``left`` must be unique on
    (key, left_ts) plus its other columns."""
    keys = _keys(key)
    lk = left.select(*keys, left_ts).distinct()
    r = right.select(*keys, F.col(right_ts).alias("_rts"), *[F.col(v).alias("_v_" + v) for v in values])
    j = interval_join(lk, r, keys, left_ts, "_rts", lo, hi, closed)
    pick_fn = F.max_by if last else F.min_by
    order = F.struct("_rts", *["_v_" + v for v in values])
    best = j.groupBy(*keys, left_ts).agg(
        pick_fn(F.struct("_rts", *["_v_" + v for v in values]), order).alias("_b")
    )
    best = best.select(
        *keys, left_ts, F.col("_b._rts").alias(prefix + right_ts), *[F.col("_b._v_" + v).alias(prefix + v) for v in values]
    )
    return left.join(best, on=keys + [left_ts], how="left")


def around_events(events: DataFrame, readings: DataFrame, key, event_ts: str, ts: str, value: str, grain, after: timedelta, salts: int = 16,
                  before_name: str = "before", after_name: str = "after") -> DataFrame:
    """O36 and O37 for a few events per key in one pass: ``events`` with the mean ``value`` of the last ``grain`` bin that begins before
    ``event_ts`` and of the first that begins in ``[event_ts, event_ts + after]``; NULL where there is none.

    Every reading meets its key's events, so ``events`` must be distinct and hold a handful per key (the product is never larger than that
    times the readings).  A key's readings are dealt over ``salts`` parts by their bin and its events are copied to each, so a heavy
    key is ``salts`` tasks; a part keeps one bin before and one after for each event, and only these meet."""
    keys = _keys(key)
    e = events.withColumn("_event", F.struct(*events.columns))
    copies = e.select(*keys, "_event", F.col(event_ts).alias("_t"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    r = readings.select(*keys, grain(ts).alias("_bin"), F.col(value).alias("_v")).withColumn("_salt", F.pmod(F.xxhash64("_bin"), F.lit(salts)).cast("int"))
    gap = micros_between(F.col("_t"), F.col("_bin"))
    met = r.join(copies, [*keys, "_salt"]).where(gap <= _us(after))
    # grouping by what the join is partitioned by: no further shuffle up to here
    bins = met.groupBy(*keys, "_salt", "_event", "_t", "_bin").agg(F.avg("_v").alias("_v"))
    early, late = gap < 0, gap >= 0
    one = bins.groupBy(*keys, "_salt", "_event").agg(
        F.max(F.when(early, F.struct("_bin", "_v"))).alias("_b"), F.min(F.when(late, F.struct("_bin", "_v"))).alias("_a"))
    # events that no reading meets come in by themselves
    none = e.select(*keys, "_event", *(F.lit(None).cast(one.schema[c].dataType).alias(c) for c in ("_b", "_a")))
    best = one.select(none.columns).unionByName(none).groupBy(*keys, "_event").agg(F.max("_b").alias("_b"), F.min("_a").alias("_a"))
    return best.select("_event.*", F.col("_b._v").alias(before_name), F.col("_a._v").alias(after_name))
