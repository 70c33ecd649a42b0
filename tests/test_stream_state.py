"""The stateful stream functions across several micro-batches, driven directly
with a minimal stand-in for Spark's GroupState."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd

from vitalis.streaming.alerts import _gap_fn, _spread_fn


class FakeState:
    def __init__(self):
        self.value, self.timeout, self.removed = None, None, False
        self.hasTimedOut = False

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def remove(self):
        self.value, self.removed = None, True

    def setTimeoutTimestamp(self, ms):
        self.timeout = ms

    def getCurrentWatermarkMs(self):
        return 0


def _temps(vals, start):
    ts = [start + timedelta(minutes=10 * i) for i in range(len(vals))]
    return pd.DataFrame({"patientid": 19, "temperature": vals, "date_time": ts,
                         "_ems": [int(pd.Timestamp(t).value // 1_000_000) for t in ts]})


def test_spread_state_merges_batches():
    fn, st = _spread_fn(0.5, 7_200_000), FakeState()
    key = (19, datetime(2025, 10, 7, 8))
    first = list(fn(key, iter([_temps([36.8, 37.0], datetime(2025, 10, 7, 8, 5))]), st))[0]
    assert set(first.status) == {"stable"}
    # second insert: the SD now covers all five rows (0.3072 -> stable) ...
    second = list(fn(key, iter([_temps([37.4, 36.9, 37.6], datetime(2025, 10, 7, 8, 35))]), st))[0]
    n, mean, m2 = st.get
    allv = np.array([36.8, 37.0, 37.4, 36.9, 37.6])
    assert n == 5 and math.isclose(mean, allv.mean()) and math.isclose(math.sqrt(m2 / n), allv.std())
    assert set(second.status) == {"stable"}
    # ... and a wild third reading flips only the new row (earlier rows are never re-flagged)
    third = list(fn(key, iter([_temps([40.0], datetime(2025, 10, 7, 8, 58))]), st))[0]
    assert list(third.status) == ["unstable"] and len(third) == 1
    assert st.timeout >= int(pd.Timestamp(datetime(2025, 10, 7, 8, 58)).value // 1_000_000) + 3_600_000


def test_spread_state_timeout_removes():
    fn, st = _spread_fn(0.5, 0), FakeState()
    st.value, st.hasTimedOut = (3, 37.0, 0.1), True
    assert list(fn((1, datetime(2025, 1, 1)), iter([]), st)) == [] and st.removed


def test_gap_state_carries_last_reading():
    fn, st = _gap_fn(10), FakeState()
    base = datetime(2024, 1, 1)
    b1 = pd.DataFrame({"patientid": 1, "date_time": [base, base + timedelta(minutes=5)]})
    out1 = list(fn((1,), iter([b1]), st))[0]
    assert out1.empty and pd.Timestamp(st.get[0]) == base + timedelta(minutes=5)
    b2 = pd.DataFrame({"patientid": 1, "date_time": [base + timedelta(minutes=30), base + timedelta(minutes=33)]})
    out2 = list(fn((1,), iter([b2]), st))[0]
    # the gap spans the batch boundary: 00:05 -> 00:30
    assert list(out2.previous_time) == [base + timedelta(minutes=5)] and list(out2.gap_minutes) == [25.0]


def test_gap_state_idle_timeout():
    fn, st = _gap_fn(10, idle_ms=3_600_000), FakeState()
    base = datetime(2024, 1, 1)
    b1 = pd.DataFrame({"patientid": 1, "date_time": [base], "_ems": [int(pd.Timestamp(base).value // 1_000_000)]})
    list(fn((1,), iter([b1]), st))
    assert st.timeout == int(pd.Timestamp(base).value // 1_000_000) + 3_600_000
    st.hasTimedOut = True
    # an alert with an open end; the last time is kept for the return, however late
    told = list(fn((1,), iter([]), st))[0]
    assert list(told.previous_time) == [base] and told.date_time.isna().all() and st.exists and not st.removed
    st.hasTimedOut = False
    back = pd.DataFrame({"patientid": 1, "date_time": [base + timedelta(days=9)], "_ems": [int(pd.Timestamp(base).value // 1_000_000)]})
    assert list(list(fn((1,), iter([back]), st))[0].gap_minutes) == [9 * 24 * 60.0]
