"""Window operators: lag/lead, gaps, streaks, moving averages, ranks and top-n.

Per-patient windows over raw readings are the skew hazard of this domain: a
handful of patients own all rows, so ``Window.partitionBy(patient)`` puts a
third of the data in one task.  Lag, gaps, sessions and row frames therefore run
over the even segments of ``operators.scan`` - same result as the plain per-key
window.  With ``segment="day"`` or ``"hour"`` they run in calendar segments
instead and repair the first row of each from a small summary: a cheaper plan
where no calendar unit of a key is large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis.functions.time import micros_between, trunc_hour
from vitalis.operators import scan


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, cols)`` in which NULL equals NULL, as it does for a window's partitions."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols]
    return left.join(other, cond, how).drop(*(f"_r_{c}" for c in cols))


def segment_of(ts, segment: str = "day") -> Column:
    """Segment unit of the segmented windows: calendar day (default) or hour.
    Smaller units bound the largest task more tightly at the cost of more
    segment edges to repair."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return {"day": F.to_date(c), "hour": trunc_hour(c)}[segment]


def shift_over_time(
    df: DataFrame,
    key: Sequence[str] | str,
    ts: str,
    cols: Sequence[str],
    direction: str = "lag",
    prefix: str | None = None,
    tiebreak: Sequence[str] = (),
    segment: str | None = None,
) -> DataFrame:
    """``LAG(c) / LEAD(c) OVER (PARTITION BY key ORDER BY ts, tiebreak)`` for each c.

    Exact equivalent of the per-key window, computed in even segments
    (``scan.shift``) or, with ``segment``, in calendar segments: inside a segment a plain lag/lead; for the first (lag) or last (lead) row
    of a segment the value comes from the nearest non-empty neighbouring day,
    found with a window over the per-(key, day) summary (a few rows per key).
    Equal timestamps are ordered by ``tiebreak`` then by the shifted columns,
    which makes the result deterministic.
    """
    keys = _keys(key)
    lag = direction == "lag"
    prefix = prefix if prefix is not None else ("prev_" if lag else "next_")
    order_cols = [ts, *tiebreak, *[c for c in cols if c != ts and c not in tiebreak]]
    if segment is None:
        return scan.shift(df, keys, order_cols, cols, direction, prefix)
    seg = "_seg_day"
    d = df.withColumn(seg, segment_of(ts, segment))
    w = Window.partitionBy(*keys, seg).orderBy(*order_cols)
    payload = F.struct(*[F.col(c).alias(c) for c in cols])
    # the segment edge comes from the same window as the shift: with a second,
    # reversed ordering, fully equal rows could be picked differently by the two
    edge = (F.lag if lag else F.lead)(F.lit(1)).over(w).isNull()
    inner = (F.lag if lag else F.lead)(payload).over(w)
    d = d.withColumn("_inner", inner).withColumn("_edge", edge)
    # per-day boundary row: last row of the day (for lag) or first row (for lead)
    order_struct = F.struct(*order_cols)
    pick = F.max_by if lag else F.min_by
    summary = df.groupBy(*keys, segment_of(ts, segment).alias(seg)).agg(pick(payload, order_struct).alias("_b"))
    ws = Window.partitionBy(*keys).orderBy(seg)
    carry = summary.select(*keys, seg, (F.lag if lag else F.lead)("_b").over(ws).alias("_carry"))
    out = join_null_safe(d, carry, keys + [seg], "left")
    val = F.when(F.col("_edge"), F.col("_carry")).otherwise(F.col("_inner"))
    out = out.withColumn("_val", val)
    for c in cols:
        out = out.withColumn(prefix + c, F.col("_val")[c])
    return out.drop(seg, "_inner", "_edge", "_carry", "_val")


def time_gaps(
    df: DataFrame, key, ts: str, min_gap_minutes: float, strict: bool = True, prev_name: str = "previous_time",
    segment: str | None = None,
) -> DataFrame:
    """Rows whose distance to the previous reading exceeds ``min_gap_minutes``.
    Adds ``prev_name`` and ``gap_seconds``."""
    g = shift_over_time(df, key, ts, [ts], "lag", prefix="_p_", segment=segment)
    g = g.withColumnRenamed("_p_" + ts, prev_name)
    g = g.withColumn("gap_seconds", micros_between(F.col(prev_name), F.col(ts)) / F.lit(1e6))
    lim = min_gap_minutes * 60.0
    return g.where(F.col("gap_seconds") > lim if strict else F.col("gap_seconds") >= lim)


def streaks(
    df: DataFrame,
    key,
    day: str,
    flag: Column,
    min_len: int = 2,
    group_name: str = "streak_group",
    len_name: str = "consecutive_days",
) -> DataFrame:
    """O65 gaps-and-islands on daily rows: a row opens a new group unless it
    is flagged and the previous row is the calendar day before; groups are
    the running sum of openings.  Returns (key, group, length) of flagged
    groups with length >= ``min_len``.  Input is one row per (key, day) -
    already aggregated, so the per-key window is small."""
    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy(day)
    d = df.withColumn("_flag", flag)
    cont = (F.col("_flag") == 1) & (F.lag(day).over(w) == F.date_sub(F.col(day), 1))
    d = d.withColumn("_brk", F.when(cont, 0).otherwise(1))
    d = d.withColumn(group_name, F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = d.where(F.col("_flag") == 1).groupBy(*keys, group_name).agg(F.count(F.lit(1)).alias(len_name))
    return g.where(F.col(len_name) >= min_len)


def moving_avg_rows(df: DataFrame, key, order: Sequence, value: str, preceding: int, name: str) -> DataFrame:
    """``AVG(value) OVER (PARTITION BY key ORDER BY order ROWS BETWEEN n PRECEDING AND CURRENT ROW)``."""
    w = Window.partitionBy(*_keys(key)).orderBy(*order).rowsBetween(-preceding, 0)
    return df.withColumn(name, F.avg(value).over(w))


def moving_avg_rows_blocked(
    df: DataFrame, key, ts: str, value: str, preceding: int, name: str, tiebreak: Sequence[str] = (),
    block: int | None = None,
    segment: str | None = None,
) -> DataFrame:
    """O63 on raw readings without one task per key.

    Rows get a row number within the key (``scan.ranked``; with ``segment``, the
    offset of earlier days from a small per-day count table + the row number
    inside the day); blocks of
    ``block`` consecutive row numbers are windowed independently, and the
    last ``preceding`` rows of each block are copied into the next block so
    every frame is complete.  Result equals the per-key ROWS frame.
    """
    keys = _keys(key)
    order_cols = [ts, *tiebreak, value]
    seg = "_seg_day"
    if segment is None:
        d = scan.ranked(df, keys, order_cols, "_rn", "row_number").withColumn("_rn", F.col("_rn") - 1)
    else:
        d = df.withColumn(seg, segment_of(ts, segment))
        counts = d.groupBy(*keys, seg).agg(F.count(F.lit(1)).alias("_n"))
        wc = Window.partitionBy(*keys).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wc), F.lit(0))).drop("_n")
        d = join_null_safe(d, counts, keys + [seg])
        d = d.withColumn("_rn", F.col("_off") + F.row_number().over(Window.partitionBy(*keys, seg).orderBy(*order_cols)) - 1)
    block = block or max(preceding * 64, 4096)
    block = max(block, preceding + 1)
    d = d.withColumn("_blk", F.floor(F.col("_rn") / block))
    tail = F.when(F.col("_rn") % block >= block - preceding, F.array(F.col("_blk"), F.col("_blk") + 1)).otherwise(
        F.array(F.col("_blk"))
    )
    d = d.withColumn("_home", F.col("_blk")).withColumn("_blk", F.explode(tail))
    w = Window.partitionBy(*keys, "_blk").orderBy("_rn").rowsBetween(-preceding, 0)
    d = d.withColumn(name, F.avg(value).over(w)).where(F.col("_blk") == F.col("_home"))
    return d.drop(seg, "_off", "_rn", "_blk", "_home")


def rank_within(df: DataFrame, key, order: Sequence[Column], name: str, kind: str = "rank") -> DataFrame:
    """row_number / rank / dense_rank over (key, order)."""
    w = Window.partitionBy(*_keys(key)).orderBy(*order) if key else Window.orderBy(*order)
    fn = {"rank": F.rank, "row_number": F.row_number, "dense_rank": F.dense_rank}[kind]
    return df.withColumn(name, fn().over(w))


def top_n_per_group(df: DataFrame, key, order: Sequence[Column], n: int, name: str = "_rk", kind: str = "rank") -> DataFrame:
    """Keep rank <= n per group (ties kept for ``rank``)."""
    return rank_within(df, key, order, name, kind).where(F.col(name) <= n)


def first_per_key(df: DataFrame, key, order: Sequence[Column]) -> DataFrame:
    """O72 ``DISTINCT ON (key) ... ORDER BY order``: one row per key.  Uses
    ``max_by``-style aggregation rather than a window so it partial-aggregates."""
    keys = _keys(key)
    others = [c for c in df.columns if c not in keys]
    ordk = F.struct(*order)
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordk).alias("_r"))
    return g.select(*keys, *[F.col("_r")[c].alias(c) for c in others])


def ntile_over_values(df: DataFrame, key, value: str, tiebreak: Sequence[str], n: int, name: str = "ntile", segment: Column | None = None) -> DataFrame:
    """``NTILE(n) OVER (PARTITION BY key ORDER BY value ASC NULLS LAST, tiebreak)``
    without sorting a whole key in one task.

    Rows are counted by (key, value, segment of the first tie-breaker) first; a
    running sum over these counts gives each such group its offset, and only
    the rows of one group are numbered together.  A value that repeats a lot
    is split by the segments (days, for a timestamp tie-breaker; ``segment``
    must not decrease along the tie-breakers, NULL first).  The bucket
    follows Spark/PostgreSQL NTILE: the first N mod n buckets hold one extra row.
    """
    keys = _keys(key)
    if segment is None:
        timed = bool(tiebreak) and str(df.schema[tiebreak[0]].dataType.typeName()).startswith("timestamp")
        segment = segment_of(tiebreak[0]) if timed else F.lit(0)
    part = [*keys, value, "_seg"]
    d = df.withColumn("_seg", segment)
    counts = d.groupBy(*part).agg(F.count(F.lit(1)).alias("_c"))
    wk = Window.partitionBy(*keys)
    ahead = wk.orderBy(F.col(value).asc_nulls_last(), F.col("_seg").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*part, F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_off"), F.sum("_c").over(wk).alias("_n"))
    d = join_null_safe(d, counts, part)
    order = [F.col(c).asc() for c in tiebreak] or [F.col(value)]
    d = d.withColumn("_r", F.col("_off") + F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    q, m = (F.col("_n") / n).cast("long"), F.col("_n") % n
    big = m * (q + 1)
    bucket = F.when(F.col("_r") <= big, F.floor((F.col("_r") - 1) / (q + 1)) + 1).otherwise(
        F.floor((F.col("_r") - big - 1) / q) + m + 1
    )
    return d.withColumn(name, bucket.cast("int")).drop("_seg", "_off", "_n", "_r")


def top_n_rows(df: DataFrame, key, order: Sequence[Column], n: int, segment: Column, name: str = "_rk") -> DataFrame:
    """O68 for raw rows: ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order) <= n``
    in two phases - top n inside each (key, segment), then top n per key over
    the at most n x segments survivors.  Exact for a total order; no task ever
    sorts a whole key."""
    keys = _keys(key)
    pre = df.withColumn("_seg", segment)
    pre = pre.withColumn("_r0", F.row_number().over(Window.partitionBy(*keys, "_seg").orderBy(*order))).where(F.col("_r0") <= n)
    out = pre.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return out.drop("_seg", "_r0")


def session_starts(df: DataFrame, key, ts: str, gap_minutes: float, inclusive: bool = False, segment: str | None = None) -> DataFrame:
    """``df`` with ``previous_time`` and ``session_start``: the first time of the row's session.  A session ends where the
    next reading is more than ``gap_minutes`` away (or, ``inclusive``, that far or more).

    By default one pass over even segments (``scan.sessions_from``).  With ``segment``, gaps come from the segmented lag; a row's session is the last start in its
    segment, or the last one of the segments before (a small table), so no
    task holds a whole key.  Rows without a time belong to no session."""
    keys = _keys(key)
    if segment is None:
        limit = int(gap_minutes * 60_000_000)
        opens = lambda before, at: (micros_between(before, at) >= limit) if inclusive else (micros_between(before, at) > limit)
        return scan.sessions_from(df.where(F.col(ts).isNotNull()), keys, ts, opens)
    seg = "_seg_day"
    d = shift_over_time(df.where(F.col(ts).isNotNull()), keys, ts, [ts], "lag", prefix="_p_", segment=segment)
    d = d.withColumnRenamed("_p_" + ts, "previous_time")
    gap, limit = micros_between("previous_time", ts), int(gap_minutes * 60_000_000)
    new = F.col("previous_time").isNull() | ((gap >= limit) if inclusive else (gap > limit))
    d = d.withColumn(seg, segment_of(ts, segment)).withColumn("_new", F.when(new, F.col(ts)))
    inside = F.last("_new", ignorenulls=True).over(Window.partitionBy(*keys, seg).orderBy(ts).rangeBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("_inside", inside)
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1))
    carry = d.groupBy(*keys, seg).agg(F.max("_new").alias("_last")).select(*keys, seg, before.alias("_carry"))
    d = join_null_safe(d, carry, [*keys, seg]).withColumn("session_start", F.coalesce("_inside", "_carry"))
    return d.drop(seg, "_new", "_inside", "_carry")


def sessions(df: DataFrame, key, ts: str, gap_minutes: float, aggs: Sequence[Column] = (), segment: str | None = None) -> DataFrame:
    """O80 islands of readings separated by more than ``gap_minutes``: one row
    per session with its start, end and row count."""
    d = session_starts(df, key, ts, gap_minutes, segment=segment)
    return d.groupBy(*_keys(key), "session_start").agg(F.count(F.lit(1)).alias("readings"), F.max(ts).alias("last_reading"), *aggs)


def stream_sessions(df: DataFrame, key, ts: str, gap_minutes: float, aggs: Sequence[Column] = ()) -> DataFrame:
    """O80 on a stream (with a watermark): ``session_window`` per key."""
    keys = _keys(key)
    ev = F.col(ts).cast("timestamp")
    g = df.groupBy(*keys, F.session_window(ev, f"{int(gap_minutes * 60)} seconds").alias("_s")).agg(
        F.count(F.lit(1)).alias("readings"), F.min(ts).alias("session_start"), F.max(ts).alias("last_reading"), *aggs
    )
    return g.drop("_s")


def rank_over_values(df: DataFrame, value: str, name: str = "rank", descending: bool = True, segments: int = 64) -> DataFrame:
    """``RANK() OVER (ORDER BY value DESC NULLS FIRST)`` (or ASC NULLS LAST) of a numeric column
    with no single-partition sort, and no job while the plan is built: ``scan.ranked`` over 64 or so even segments of
    values (rows of one value share a segment)."""
    v = F.col(value)
    order = [v.isNotNull(), -v] if descending else [v.isNull(), v]
    return scan.ranked(df, [], order, name, "rank", bits=max(segments - 1, 0).bit_length())
