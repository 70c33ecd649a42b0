"""Interval state on streams against the batch operators, rows in any order."""

import random
import tracemalloc
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalis.operators.windows import streaks, time_gaps
from vitalis.streaming import intervals
from vitalis.streaming.sinks import start_parquet_sink

T0 = datetime(2024, 1, 1)


@pytest.fixture()
def rocks(spark):
    old = spark.conf.get(intervals._PROVIDER)
    intervals.use_rocksdb(spark)
    yield spark
    spark.conf.set(intervals._PROVIDER, old)


def run(spark, tmp_path, parts, schema, job):
    """The rows that ``job`` gives for a stream of one file a micro-batch."""
    src, out = tmp_path / "in", tmp_path / "out"
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src / f"p={i:03d}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(src))
    q = start_parquet_sink(job(stream), str(out), f"intervals-{random.random()}", available_now=True)
    q.awaitTermination()
    return spark.read.schema(job(stream).schema).parquet(str(out)).collect()


def times(rng, n):
    return [(rng.choice([1, 2, None]), T0 + timedelta(seconds=rng.choice([1, 60, 601, 4000]) * rng.randrange(200))) for _ in range(n)]


END = [(k, T0 + timedelta(days=400)) for k in (1, 2, None)]


def test_merged():
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.integers(0, 100, rng.integers(0, 12))
        e = s + rng.integers(0, 10, len(s))
        reach = int(rng.integers(0, 6))
        points = sorted({p for a, b in zip(s, e) for p in range(a, b + 1)})
        want = []
        for p in points:
            if want and p - want[-1][1] <= max(reach, 1):
                want[-1][1] = p
            else:
                want.append([p, p])
        if reach:
            assert [list(x) for x in zip(*intervals.merged(s, e, reach))] == want


def test_gaps_in_any_order(rocks, tmp_path):
    """Rows dealt at random over micro-batches, all within the watermark; a last row far ahead settles everything."""
    rng = random.Random(1)
    rows = times(rng, 600) + [(1, None)]
    rows += rows[:50]
    dealt = [rows[i::4] for i in range(4)] + [END, END]
    got = run(rocks, tmp_path, dealt, "patientid int, date_time timestamp_ntz", lambda s: intervals.stream_sync_gaps(s, 10, watermark="30 days"))
    df = rocks.createDataFrame(rows + END, "patientid int, date_time timestamp_ntz").where("date_time IS NOT NULL").distinct()
    want = time_gaps(df, "patientid", "date_time", 10).collect()
    key = lambda r: (str(r.patientid), r.previous_time, r.date_time)
    # END lies beyond the watermark's reach by thirty days: its own gaps are open until more comes
    assert sorted(map(key, got)) == sorted(key(r) for r in want if r.date_time < END[0][1])
    assert all(abs(r.gap_minutes * 60 - (r.date_time - r.previous_time).total_seconds()) < 1e-6 for r in got)


def test_closed_input_in_order_tells_every_gap(rocks, tmp_path):
    rng = random.Random(2)
    rows = sorted({r for r in times(rng, 300) if r[0]}, key=lambda r: r[1])
    parts = [rows[i : i + 60] for i in range(0, len(rows), 60)]
    for p in parts:
        rng.shuffle(p)
    got = run(rocks, tmp_path, parts, "patientid int, date_time timestamp_ntz", lambda s: intervals.stream_sync_gaps(s, 10, watermark="0 seconds"))
    want = time_gaps(rocks.createDataFrame(rows, "patientid int, date_time timestamp_ntz"), "patientid", "date_time", 10).collect()
    assert sorted((r.patientid, r.previous_time, r.date_time) for r in got) == sorted((r.patientid, r.previous_time, r.date_time) for r in want)


def test_idle_is_told_once_and_the_gap_on_return(rocks, tmp_path):
    t = lambda m: T0 + timedelta(minutes=m)
    parts = [[(1, t(0)), (1, t(5)), (2, t(0))], [(2, t(200))], [(2, t(205))], [(1, t(300)), (2, t(300))], [(2, t(301))]]
    got = run(rocks, tmp_path, parts, "patientid int, date_time timestamp_ntz", lambda s: intervals.stream_sync_gaps(s, 10, idle_minutes=60, watermark="0 seconds"))
    one = [(r.previous_time, r.date_time) for r in got if r.patientid == 1]
    assert sorted(one, key=lambda r: r[1] or T0) == [(t(5), None), (t(5), t(300))]


def test_streaks_join_under_late_days(rocks, tmp_path):
    rng = random.Random(3)
    d0 = date(2024, 1, 1)
    days = [(rng.choice([1, 2]), d0 + timedelta(days=rng.randrange(120))) for _ in range(150)]
    dealt = [days[i::5] for i in range(5)] + [[(k, d0 + timedelta(days=900)) for k in (1, 2)]] * 2
    got = run(rocks, tmp_path, dealt, "patientid int, day date", lambda s: intervals.stream_streaks(s, 2, watermark="400 days"))
    df = rocks.createDataFrame(sorted(set(days)), "patientid int, day date")
    want = streaks(df, "patientid", "day", F.lit(1)).collect()
    assert sorted((r.patientid, r.consecutive_days) for r in got) == sorted((r.patientid, r.consecutive_days) for r in want)


class Kept(dict):
    """Stands in for the map state, the value state and the handle."""

    def iterator(self):
        return iter(self.items())

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        del self[k]

    def exists(self):
        return False

    def listTimers(self):
        return []

    def registerTimer(self, t):
        self["timer"] = t


def test_backfill_of_one_key_is_bounded():
    """Ten million rows of one patient in one micro-batch, Arrow batch by Arrow batch: a few MB, as many intervals as there are."""
    p = intervals._Gaps(600_000_000, None)
    p.spans, p.head, p.handle = Kept(), Kept(), Kept()
    rng = np.random.default_rng(4)
    batches = (pd.DataFrame({"t": rng.integers(0, 10**13, 100_000) // 10**9 * 10**9}) for _ in range(100))
    tracemalloc.start()
    list(p.handleInputRows((1,), batches, None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6 and sorted(p.spans.items()) == [((i * 10**9,), (i * 10**9,)) for i in range(10_000)]


def test_state_store_is_asked_for(spark):
    stream = spark.readStream.format("rate").load().select(F.lit(1).alias("patientid"), F.col("timestamp").cast("timestamp_ntz").alias("date_time"))
    with pytest.raises(ValueError):
        intervals.stream_sync_gaps(stream)
