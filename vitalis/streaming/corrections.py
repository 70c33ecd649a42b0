"""Streams that take back or wait: status corrections as a change log (O81 as intended), exact row frames.

``stream_status_changes`` gives, for each (patient, day), what its status becomes as rows arrive in any order: a first insert (+1) and,
whenever the status turns, a pair of the old status taken back (-1) and the new one put in (+1).  The log is append-only, so a file
sink writes it exactly once; ``folded`` adds it up, which leaves one status a day, and ``reflagged`` puts it on the readings,
the earlier ones included.  The state of a day is three moments and its status, however many readings it has, and goes when
the watermark passes the day.

``stream_moving_avg`` is ``AVG(value) OVER (PARTITION BY key ORDER BY time, value ROWS n PRECEDING)``: rows wait in the state until the
watermark has reached them (no row before them can come any more, Spark drops those), are put in order, and are told with the mean of
the last n + 1 rows; behind them the state keeps the last n values.  What waits is what the watermark's delay holds.

Both need the RocksDB state store (``intervals.use_rocksdb``).  Defined cases: rows with a NULL time are left out; a NULL value is a
row without a value (a day of such rows is stable; a mean of no values is NULL); a NULL key is a key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vitalis.operators.windows import join_null_safe
from vitalis.streaming.intervals import _micros, _ready, _time, named, unnamed

_DAY_US = 86_400_000_000


class _Status(StatefulProcessor):
    def __init__(self, limit: float):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("moments", "n long, mean double, m2 double, status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, mean, m2, old = self.held.get() if self.held.exists() else (0, 0.0, 0.0, None)
        for batch in rows:
            x = batch["v"].to_numpy(np.float64)
            x = x[~np.isnan(x)]
            if len(x):
                shift, total = x.mean() - mean, n + len(x)
                m2 += ((x - x.mean()) ** 2).sum() + shift * shift * n * len(x) / total
                mean += shift * len(x) / total
                n = total
        status = "unstable" if n and math.sqrt(m2 / n) > self.limit else "stable"
        self.held.update((int(n), float(mean), float(m2), status))
        day = int(key[0].partition("|")[0])
        self.handle.registerTimer((day + 1) * _DAY_US // 1000)
        if status == old:
            return iter(())
        out = [(s, c) for s, c in ((old, -1), (status, 1)) if s is not None]
        return iter([pd.DataFrame({"key": key[0], "status": [s for s, _ in out], "change": [c for _, c in out]})])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_status_changes(temps: DataFrame, limit: float = 0.5, watermark: str = "2 days") -> DataFrame:
    """Patientid, day, status, change (+1 or -1) from a stream of temperatures; "unstable" where the population SD of the
    day's readings so far exceeds ``limit``."""
    day = F.datediff(F.to_date("date_time"), F.lit("1970-01-01").cast("date"))
    key = F.concat(day.cast("string"), F.lit("|"), named("patientid")).alias("key")
    ready = _ready(temps, [key, F.col("temperature").cast("double").alias("v")], "date_time", _micros("date_time"), watermark)
    kind = temps.schema["patientid"].dataType.simpleString()
    out = ready.groupBy("key").transformWithStateInPandas(statefulProcessor=_Status(limit), outputStructType="key string, status string, change int", outputMode="Append", timeMode="eventTime")
    at = F.substring_index("key", "|", 1).cast("int")
    patient = unnamed(F.substring(F.col("key"), F.instr("key", "|") + 1, F.length("key")), kind)
    return out.select(patient.alias("patientid"), F.date_add(F.lit("1970-01-01").cast("date"), at).alias("day"), "status", "change")


def folded(changes: DataFrame) -> DataFrame:
    """patientid, day, status that the change log adds up to: one row a day."""
    return changes.groupBy("patientid", "day", "status").agg(F.sum("change").alias("_c")).where(F.col("_c") > 0).drop("_c")


def reflagged(temps: DataFrame, changes: DataFrame) -> DataFrame:
    """The readings (with a time) with the status of their day as it stands."""
    timed = temps.where(F.col("date_time").isNotNull()).withColumn("day", F.to_date("date_time"))
    return join_null_safe(timed, folded(changes), ["patientid", "day"], "left").drop("day")


class _Frames(StatefulProcessor):
    def __init__(self, preceding: int):
        self.preceding = preceding

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, v double")
        self.tail = handle.getListState("tail", "v double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            v = batch["v"].astype(object).where(batch["v"].notna(), None)
            self.waiting.appendList([(int(t), None if x is None else float(x)) for t, x in zip(batch["t"], v, strict=True)])
            first = min(int(batch["t"].min()), first) if first is not None else int(batch["t"].min())
        if first is not None:
            self.handle.registerTimer(max(first // 1000, timerValues.getCurrentWatermarkInMs()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(((t, v) for t, v in self.waiting.get()), key=lambda r: (r[0], r[1] is not None, r[1] or 0.0)) if self.waiting.exists() else []
        ready, rest = [r for r in rows if r[0] <= mark], [r for r in rows if r[0] > mark]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(rest[0][0] // 1000)
        else:
            self.waiting.clear()
        if not ready:
            return iter(())
        tail = [v for (v,) in self.tail.get()] if self.tail.exists() else []
        values = np.array([np.nan if v is None else v for v in [*tail, *(v for _, v in ready)]])
        known = ~np.isnan(values)
        sums, counts = (np.concatenate([[0], np.cumsum(x)]) for x in (np.where(known, values, 0.0), known))
        hi = np.arange(len(tail) + 1, len(values) + 1)
        lo = np.maximum(hi - self.preceding - 1, 0)
        # sums of at most preceding + 1 values each, not differences of running sums
        means = [values[a:b][known[a:b]].mean() if counts[b] > counts[a] else np.nan for a, b in zip(lo, hi, strict=True)]
        if self.preceding:
            self.tail.put([(None if np.isnan(x) else float(x),) for x in values[-self.preceding :]])
        out = pd.DataFrame({"t": [t for t, _ in ready], "v": [v for _, v in ready], "mean": means})
        out.insert(0, "key", key[0])
        return iter([out.astype({"v": "float64"}).astype({"v": object, "mean": object}).where(out.notna(), None)])

    def close(self) -> None:
        pass


def stream_moving_avg(readings: DataFrame, preceding: int, name: str = "rolling_avg", watermark: str = "2 hours", key: str = "patientid", ts: str = "date_time", value: str = "temperature") -> DataFrame:
    """O63 on a stream: key, ``ts``, value, and the mean of the row and the ``preceding`` rows before it."""
    ready = _ready(readings, [named(key).alias("key"), F.col(value).cast("double").alias("v")], ts, _micros(ts), watermark)
    kind = readings.schema[key].dataType.simpleString()
    out = ready.groupBy("key").transformWithStateInPandas(statefulProcessor=_Frames(preceding), outputStructType="key string, t long, v double, mean double", outputMode="Append", timeMode="eventTime")
    return out.select(unnamed(F.col("key"), kind).alias(key), _time("t").alias(ts), F.col("v").alias(value), F.col("mean").alias(name))
