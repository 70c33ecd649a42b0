"""Interval-merging state: sync gaps and streaks on a stream, exact for any order of arrival.

The state of a key is not its rows but the intervals they cover: times closer than a limit belong to one interval.  A
late row lengthens an interval, joins two, or begins one.  Rows come to the processor as an iterator of Arrow batches; each
is sorted, cut into its own intervals with numpy and merged, so a backfill of any number of rows of one key needs memory for
a batch and for the intervals only.  Intervals live in a map state, and an event-time timer wakes the key when the watermark has
passed what can be told: rows up to the watermark come no more (Spark drops them), so what lies before it is final.

The jobs use ``transformWithState``, whose timers and map state need the RocksDB state store:
``spark.sql.streaming.stateStore.providerClass`` must name it (``ROCKSDB`` below; ``use_rocksdb`` sets it for a session).
The processors are classes of this package, so it must be importable where Python workers run (installed, or ``--py-files``).

Defined cases: rows with a NULL time are left out; repeated rows change nothing; a NULL key is a key; an empty stream gives
nothing.  Times are told in microseconds; the watermark has milliseconds, so rows that share its millisecond may still arrive
after what lies before them was told, and then move an interval's begin by less than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vitalis.functions.time import micros_between

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> None:
    """Opt-in for a session that runs these jobs."""
    spark.conf.set(_PROVIDER, ROCKSDB)


def merged(starts: np.ndarray, ends: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Intervals that lie at most ``reach`` apart become one; in ascending order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] - ends[:-1] > reach)
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


class _Intervals(StatefulProcessor):
    """Keeps a key's intervals and calls ``settle`` with those that the watermark has reached.

    The handlers work when they are called and return what they have; a generator would run later, when Spark may have
    turned the state to another key."""

    def __init__(self, reach: int, unit_us: int):
        self.reach, self.unit_us = reach, unit_us  # in units of the times; microseconds of a unit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getMapState("spans", "start long", "stop long")
        self.head = handle.getValueState("head", "start long")

    def _load(self) -> tuple[np.ndarray, np.ndarray]:
        found = sorted((k[0], v[0]) for k, v in self.spans.iterator())
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    def _save(self, before: tuple[np.ndarray, np.ndarray], after: tuple[np.ndarray, np.ndarray]) -> None:
        old, new = dict(zip(*(x.tolist() for x in before), strict=True)), dict(zip(*(x.tolist() for x in after), strict=True))
        for k in old.keys() - new.keys():
            self.spans.removeKey((k,))
        for k, v in new.items():
            if old.get(k) != v:
                self.spans.updateValue((k,), (v,))

    def _wake(self, at_units: list[int]) -> None:
        """Timers just before these times, and no others: they fire once the watermark reaches them."""
        wanted = {u * self.unit_us // 1000 - 1 for u in at_units}
        for t in [t for t in self.handle.listTimers() if t not in wanted]:
            self.handle.deleteTimer(t)
        for t in wanted:
            self.handle.registerTimer(t)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = starts, ends = self._load()
        head = self.head.get()[0] if self.head.exists() else None
        for batch in rows:
            t = np.unique(batch["t"].dropna().to_numpy(np.int64))
            if head is not None:
                t = t[t >= head]
            if len(t):
                cut = np.flatnonzero(np.diff(t) > self.reach)
                starts, ends = merged(np.concatenate([starts, t[np.append(0, cut + 1)]]), np.concatenate([ends, t[np.append(cut, len(t) - 1)]]), self.reach)
        self._save(held, (starts, ends))
        self._wake(self.wakes(starts, ends))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = starts, ends = self._load()
        mark = timerValues.getCurrentWatermarkInMs() * 1000 // self.unit_us
        head = self.head.get()[0] if self.head.exists() else None
        kept, out = self.settle(key, starts, ends, mark, head)
        self._save(held, (starts[kept:], ends[kept:]))
        self._wake(self.wakes(starts[kept:], ends[kept:]))
        return iter([out] if len(out) else [])

    def close(self) -> None:
        pass


class _Gaps(_Intervals):
    """A gap is final once the watermark has reached its end: the interval behind it becomes the head, all before it go."""

    def __init__(self, reach: int, idle: int | None):
        super().__init__(reach, 1)
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.warned = handle.getValueState("warned", "at long")

    def wakes(self, starts: np.ndarray, ends: np.ndarray) -> list[int]:
        head = self.head.get()[0] if self.head.exists() else None
        ahead = starts[starts > head] if head is not None else starts
        out = ahead[:1].tolist()
        if self.idle is not None and len(ends) and not (self.warned.exists() and self.warned.get()[0] == int(ends[-1])):
            out.append(int(ends[-1]) + self.idle)
        return out

    def settle(self, key, starts, ends, mark, head) -> tuple[int, pd.DataFrame]:
        n = int(np.searchsorted(starts, mark + 999, side="right"))  # the watermark's millisecond
        first = 1 if head is None else int(np.searchsorted(starts, head, side="right"))
        rows = [(ends[i - 1], starts[i], (starts[i] - ends[i - 1]) / 60e6) for i in range(max(first, 1), n)]
        if n:
            self.head.update((int(starts[n - 1]),))
        if self.idle is not None and len(ends) and mark + 999 >= ends[-1] + self.idle and not (self.warned.exists() and self.warned.get()[0] == int(ends[-1])):
            self.warned.update((int(ends[-1]),))
            rows.append((ends[-1], None, None))
        out = pd.DataFrame(rows, columns=["previous", "at", "gap_minutes"]).astype({"previous": "Int64", "at": "Int64", "gap_minutes": "float64"})
        out.insert(0, "key", key[0])
        return max(n - 1, 0), out


class _Streaks(_Intervals):
    """A streak is final once the watermark has passed the day after it, and goes."""

    def __init__(self):
        super().__init__(1, 86_400_000_000)

    def wakes(self, starts: np.ndarray, ends: np.ndarray) -> list[int]:
        return (ends[:1] + 2).tolist()

    def settle(self, key, starts, ends, mark, head) -> tuple[int, pd.DataFrame]:
        n = int(np.searchsorted(ends + 2, mark, side="right"))
        out = pd.DataFrame({"first": starts[:n], "days": ends[:n] - starts[:n] + 1})
        out.insert(0, "key", key[0])
        return n, out


def named(key: str) -> Column:
    """The key as a string without nulls.  Rows reach a processor through pandas, which makes floats of an integer key as soon as a
    batch has a null one, and a key of 1.0 is another state than 1."""
    return F.when(F.col(key).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(key).cast("string")))


def unnamed(text: Column, kind: str) -> Column:
    return F.when(text != "", F.substring(text, F.lit(2), F.length(text))).cast(kind)


def _ready(stream: DataFrame, keep: Column | list, ts: str, unit: Column, watermark: str) -> DataFrame:
    """The columns ``keep``, the time in units as ``t`` and the watermarked event time."""
    spark = stream.sparkSession
    if spark.conf.get(_PROVIDER, "") != ROCKSDB:
        raise ValueError(f"set {_PROVIDER} to the RocksDB provider (use_rocksdb)")
    marked = stream.select(*(keep if isinstance(keep, list) else [keep]), unit.alias("t"), F.col(ts).cast("timestamp").alias("event_time")).where(F.col("t").isNotNull())
    return marked.withWatermark("event_time", watermark)


def _micros(ts: str):
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))


def _time(us: str):
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.expr("INTERVAL '0.000001' SECOND") * F.col(us)


def stream_sync_gaps(readings: DataFrame, min_gap_minutes: float = 10, idle_minutes: float | None = None, watermark: str = "2 hours", key: str = "patientid", ts: str = "date_time") -> DataFrame:
    """One row for each reading more than ``min_gap_minutes`` after the key's previous one (key, previous_time, ``ts``,
    gap_minutes), told when the watermark has reached it; the same rows as ``operators.windows.time_gaps`` over all that arrived
    in time.  ``idle_minutes``: a key without a reading for so long behind the watermark is told once with an open end
    (NULL ``ts`` and gap_minutes); the gap itself follows when the key returns."""
    idle = None if idle_minutes is None else int(idle_minutes * 60e6)
    ready = _ready(readings, named(key).alias("key"), ts, _micros(ts), watermark)
    kind = readings.schema[key].dataType.simpleString()
    out = ready.groupBy("key").transformWithStateInPandas(
        statefulProcessor=_Gaps(int(min_gap_minutes * 60e6), idle), outputStructType="key string, previous long, at long, gap_minutes double", outputMode="Append", timeMode="eventTime")
    return out.select(unnamed(F.col("key"), kind).alias(key), _time("previous").alias("previous_time"), _time("at").alias(ts), "gap_minutes")


def stream_streaks(days: DataFrame, min_len: int = 2, watermark: str = "2 days", key: str = "patientid", day: str = "day") -> DataFrame:
    """Runs of consecutive days (rows of ``days``: a key and a date, once or more) as key, first_day, consecutive_days, told when
    the watermark has passed the day after a run; a late day joins two runs until then."""
    ready = _ready(days, named(key).alias("key"), day, F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).cast("long"), watermark)
    kind = days.schema[key].dataType.simpleString()
    out = ready.groupBy("key").transformWithStateInPandas(statefulProcessor=_Streaks(), outputStructType="key string, first long, days long", outputMode="Append", timeMode="eventTime")
    return out.where(F.col("days") >= min_len).select(unnamed(F.col("key"), kind).alias(key), F.date_add(F.lit("1970-01-01").cast("date"), F.col("first").cast("int")).alias("first_day"), F.col("days").alias("consecutive_days"))
