"""Event-driven alerts as Structured Streaming jobs.

The reference fires row triggers on INSERT.  Here a table insert is a
micro-batch: stateless alerts are plain filters on the stream, stateful ones
keep per-key state in the state store (``applyInPandasWithState``, Arrow
batches per group) with event-time timeouts so state does not grow forever.

Every function takes a streaming DataFrame with the cleaned sensor schema
(``date_time`` as ``timestamp_ntz``) and returns a streaming DataFrame; each
also works on a static DataFrame, where it equals the batch twin.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from vitalis.functions.time import trunc_hour
from vitalis.plans.advanced import fasting_alerts, high_risk_food
from vitalis.streaming.intervals import merged


def with_event_time(df: DataFrame, ts: str = "date_time", watermark: str = "2 hours") -> DataFrame:
    """Watermarks need a zoned ``timestamp``; the sensors carry wall-clock NTZ.
    The cast uses the session time zone, set UTC for jobs."""
    return df.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", watermark)


def stream_fasting_alerts(summary_stream: DataFrame, threshold: float = 140) -> DataFrame:
    """BEFORE INSERT check on the daily fasting summary - a stateless filter
    (the row itself is kept by the table sink; the alert goes to its own sink)."""
    return fasting_alerts(summary_stream, threshold)


def stream_food_risk(foodlog_stream: DataFrame, keywords=None) -> DataFrame:
    """A notice per logged food containing a risk keyword (stateless)."""
    return high_risk_food(foodlog_stream, keywords) if keywords else high_risk_food(foodlog_stream)


# ------------------------------------------------------------------- O76
_SPREAD_OUT = "patientid int, temperature double, date_time timestamp_ntz, status string"
_SPREAD_STATE = "n long, mean double, m2 double"


def _spread_fn(limit: float, hold_ms: int):
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        n, mean, m2 = state.get if state.exists else (0, 0.0, 0.0)
        batch = pd.concat(list(pdfs), ignore_index=True)
        x = batch["temperature"].to_numpy(dtype="float64")
        x = x[~np.isnan(x)]
        if len(x):
            # Chan et al. merge of (n, mean, M2) with the batch's moments
            nb, mb = len(x), float(x.mean())
            m2b = float(((x - mb) ** 2).sum())
            tot = n + nb
            delta = mb - mean
            mean = mean + delta * nb / tot
            m2 = m2 + m2b + delta * delta * n * nb / tot
            n = tot
        sd = math.sqrt(m2 / n) if n else float("nan")
        # rows of one insert (micro-batch) all see every row of that insert
        status = "unstable" if n and sd > limit else "stable"
        state.update((n, mean, m2))
        # every row of the group lies inside its hour, so (latest event time + 1 h)
        # bounds the hour's end; epoch millis come from Spark, free of the session zone
        hour_end_ms = int(batch["_ems"].max()) + 3_600_000
        state.setTimeoutTimestamp(max(hour_end_ms + hold_ms, state.getCurrentWatermarkMs() + 1))
        yield batch.assign(status=status)[["patientid", "temperature", "date_time", "status"]]

    return fn


def stream_temp_stability(temps: DataFrame, limit: float = 0.5, watermark: str = "2 hours") -> DataFrame:
    """O76 AFTER INSERT trigger: each new row's status from the population SD
    of its (patient, hour) over all rows seen so far, including the rows of
    its own micro-batch; earlier rows are never re-flagged (O81 as written).

    State per (patient, hour) is three numbers (n, mean, M2), merged with
    each batch's moments, and dropped once the watermark passes the hour."""
    hold_ms = _duration_ms(watermark)
    s = with_event_time(temps, "date_time", watermark).withColumn("hour", trunc_hour("date_time"))
    s = s.select("patientid", "hour", "temperature", "date_time", "event_time", F.unix_millis("event_time").alias("_ems"))
    return s.groupBy("patientid", "hour").applyInPandasWithState(
        _spread_fn(limit, hold_ms), _SPREAD_OUT, _SPREAD_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


# ------------------------------------------------------------------- O77
_GAP_OUT = "patientid int, previous_time timestamp_ntz, date_time timestamp_ntz, gap_minutes double"
_GAP_STATE = "last_time timestamp_ntz"


def _gap_fn(min_gap_minutes: float, idle_ms: int | None = None):
    reach = int(min_gap_minutes * 60e6)

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            # silent so long that the gap is certain: tell now, and keep the last time for the return
            last = pd.Timestamp(state.get[0])
            yield pd.DataFrame({"patientid": [key[0]], "previous_time": [last], "date_time": [pd.NaT], "gap_minutes": [float("nan")]})
            return
        # the rows come in Arrow batches; of each only the intervals without a gap are kept
        starts = ends = np.zeros(0, "int64")
        if state.exists:  # late rows: compared among themselves and with the last time
            starts = ends = np.array([pd.Timestamp(state.get[0])], "datetime64[us]").astype("int64")
        latest_ms = None
        for batch in pdfs:
            t = np.unique(batch["date_time"].dropna().to_numpy("datetime64[us]").astype("int64"))
            cut = np.flatnonzero(np.diff(t) > reach)
            if len(t):
                starts, ends = merged(np.concatenate([starts, t[np.append(0, cut + 1)]]), np.concatenate([ends, t[np.append(cut, len(t) - 1)]]), reach)
            if "_ems" in batch and len(batch):
                latest_ms = max(latest_ms or 0, int(batch["_ems"].max()))
        out = pd.DataFrame({
            "patientid": key[0],
            "previous_time": ends[:-1].astype("datetime64[us]"),
            "date_time": starts[1:].astype("datetime64[us]"),
            "gap_minutes": ((starts[1:] - ends[:-1]) / 60e6).round(2),
        })
        if len(ends):
            state.update((pd.Timestamp(int(ends[-1]), unit="us").to_pydatetime(),))
            if idle_ms is not None and latest_ms is not None:
                state.setTimeoutTimestamp(max(latest_ms + idle_ms, state.getCurrentWatermarkMs() + 1))
        yield out

    return fn


def stream_gap_alerts(readings: DataFrame, min_gap_minutes: float = 10, idle_timeout: str | None = None,
                      watermark: str = "2 hours") -> DataFrame:
    """Sync-gap alert - a reading more than ``min_gap_minutes`` after the
    patient's previous one, told in the micro-batch it comes in (``intervals.stream_sync_gaps``
    waits for the watermark and is exact for any order).  State per patient is one timestamp; a micro-batch is taken
    Arrow batch by Arrow batch.  The batch twin is ``operators.windows.time_gaps``.  With ``idle_timeout`` (e.g.
    "7 days") a patient silent that long past the watermark gets an alert with
    an open end (NULL ``date_time`` and ``gap_minutes``) at once; the gap is
    alerted with its end when the patient returns, however late."""
    if idle_timeout is None:
        s = readings.select("patientid", "date_time")
        return s.groupBy("patientid").applyInPandasWithState(
            _gap_fn(min_gap_minutes), _GAP_OUT, _GAP_STATE, "append", GroupStateTimeout.NoTimeout
        )
    s = with_event_time(readings.select("patientid", "date_time"), "date_time", watermark)
    s = s.select("patientid", "date_time", "event_time", F.unix_millis("event_time").alias("_ems"))
    return s.groupBy("patientid").applyInPandasWithState(
        _gap_fn(min_gap_minutes, _duration_ms(idle_timeout)), _GAP_OUT, _GAP_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def _duration_ms(text: str) -> int:
    n, unit = text.split()
    mult = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]
    return int(float(n) * mult)
