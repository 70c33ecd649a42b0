"""Inputs that once lost rows, kept stale ones or gave NaN."""

import os
import random
import tempfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)
SUMMARY = "patientid int, hour timestamp_ntz, avg_hr double"


def _new(name):
    return os.path.join(tempfile.mkdtemp(prefix="vitalis-repair-"), name)


def test_rolling_frames_and_shifts_keep_null_patients_and_times(spark):
    from vitalis.operators.windows import moving_avg_rows_blocked, shift_over_time

    rows = [(1, T0, 1.0), (1, T0 + timedelta(days=1), 2.0), (1, None, 3.0), (None, T0, 4.0), (None, T0 + timedelta(days=2), 6.0), (None, None, 8.0), (2, T0, 5.0)]
    df = spark.createDataFrame(rows, "p int, t timestamp_ntz, v double")
    got = moving_avg_rows_blocked(df, "p", "t", "v", 2, "a", block=3)
    w = Window.partitionBy("p").orderBy("t", "v")
    want = df.withColumn("a", F.avg("v").over(w.rowsBetween(-2, 0)))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got.select(want.columns).collect(), key=key) == sorted(want.collect(), key=key)
    got = shift_over_time(df, "p", "t", ["v"], "lag")
    want = df.withColumn("prev_v", F.lag("v").over(w))
    assert sorted(got.select(want.columns).collect(), key=key) == sorted(want.collect(), key=key)


def test_upsert_with_an_added_column_keeps_the_day(spark):
    from vitalis.streaming.hourly import upsert_hours

    path = _new("summary")
    upsert_hours(spark.createDataFrame([(p, T0, 70.0) for p in (1, 2, 3)], SUMMARY), path)
    more = spark.createDataFrame([(2, T0, 80.0, "x")], SUMMARY + ", note string")
    upsert_hours(more, path)
    got = spark.read.option("mergeSchema", "true").parquet(path).collect()
    assert sorted((r.patientid, r.avg_hr, r.note) for r in got) == [(1, 70.0, None), (2, 80.0, "x"), (3, 70.0, None)]


def test_upsert_raises_what_reading_raises(spark):
    from vitalis.streaming.hourly import upsert_hours

    path = _new("summary")
    os.makedirs(f"{path}/day=2024-01-01")
    with open(f"{path}/day=2024-01-01/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        upsert_hours(spark.createDataFrame([(1, T0, 70.0)], SUMMARY), path)
    assert os.path.exists(f"{path}/day=2024-01-01/part-0.parquet")


def test_full_refresh_removes_days_that_are_gone(spark):
    from vitalis.streaming.hourly import refresh_summary

    path = _new("summary")
    refresh_summary(spark, spark.createDataFrame([(1, T0, 70.0), (1, T0 + timedelta(days=1), 71.0)], SUMMARY), path)
    refresh_summary(spark, spark.createDataFrame([(1, T0, 72.0)], SUMMARY), path)
    assert [(r.day, r.avg_hr) for r in spark.read.parquet(path).collect()] == [(date(2024, 1, 1), 72.0)]
    refresh_summary(spark, spark.createDataFrame([(1, T0, 1.0), (1, T0 + timedelta(days=3), 73.0)], SUMMARY), path, since="2024-01-02")
    assert sorted(r.avg_hr for r in spark.read.parquet(path).collect()) == [72.0, 73.0]


def test_quarantine_of_a_whole_table(spark):
    from vitalis.sources import schemas
    from vitalis.sources.etl import clean_table

    inverse = {v: k for k, v in schemas.RAW_RENAMES.get("heartrate", {}).items()}
    names = [inverse.get(f.name, f.name) for f in schemas.TYPED["heartrate"].fields]
    value = {"patientid": "1", "date_time": "2024-01-01 00:00:00", "hr": "70"}
    good = [value[f.name] for f in schemas.TYPED["heartrate"].fields]
    bad = [v if v != "70" else "n/a" for v in good]
    raw = spark.createDataFrame([tuple(good), tuple(good), tuple(bad)], ", ".join(f"{n} string" for n in names))
    clean, aside = clean_table(raw, "heartrate", on_error="quarantine")
    assert clean.count() == 1 and aside.count() == 1


def test_year_partitions_of_one_heavy_year(spark):
    from vitalis.sources.partitions import write_year_partitioned

    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.lit("2019-05-05 00:00:00")).otherwise(F.lit("2024-01-01 00:00:00")).cast("timestamp_ntz").alias("t0"), "id")
    df = df.select((F.col("t0") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("t"), "id")
    path = _new("years")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small data are dealt out as large would be
    try:
        write_year_partitioned(df, path, "t", [2019, 2024])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(f"{path}/bucket=2024") if f.endswith(".parquet")]
    counts = [spark.read.parquet(f"{path}/bucket=2024/{f}").count() for f in files]
    assert sum(counts) == 18_000 and max(counts) < 9_000


def test_sessions_of_one_heavy_patient(spark):
    from vitalis.operators.windows import sessions

    rng = random.Random(3)
    rows, t = [], T0
    for _ in range(900):
        t += timedelta(minutes=rng.choice([1, 5, 10, 11, 600, 3000]))
        rows.append((1, t))
    rows += [(2, T0), (2, T0), (None, T0), (None, T0 + timedelta(minutes=11)), (3, None)]
    want, last = [], {}
    for p, x in sorted((r for r in rows if r[1]), key=lambda r: (str(r[0]), r[1])):
        if p not in last or x - last[p] > timedelta(minutes=10):
            want.append([p, x, x, 0])
        want[-1][2:] = [x, want[-1][3] + 1]
        last[p] = x
    got = sessions(spark.createDataFrame(rows, "p int, t timestamp_ntz"), "p", "t", 10).collect()
    assert sorted((str(r.p), r.session_start, r.last_reading, r.readings) for r in got) == sorted((str(a), b, c, n) for a, b, c, n in want)


def _chain_tables(spark, meals, readings):
    food = spark.createDataFrame([(p, t, 400.0) for p, t in meals], "patientid int, time_begin timestamp_ntz, calorie double")
    dex = spark.createDataFrame([(p, t, v) for p, t, v in readings], "patientid int, date_time timestamp_ntz, glucosevalue int")
    return food, dex


def test_spike_chain_of_twenty_constant_days(spark):
    from vitalis.operators.chains import spike_chain

    readings = [(1, T0 + timedelta(minutes=5 * i), 200) for i in range(20 * 288)]
    got = spike_chain(*_chain_tables(spark, [(1, T0)], readings)).collect()
    assert [(r.day, round(r._avg, 6)) for r in got] == [(date(2024, 1, 1), 200.0)]
    # the first hour, then whole hours from trunc(t + 1h) + 1h on: hours 2 to 479
    assert got[0].spike_duration == 1 + 478


def test_spike_chain_against_the_recursion(spark):
    from vitalis.operators.chains import spike_chain

    rng = random.Random(7)
    meals = [(p, T0 + timedelta(minutes=rng.randint(0, 900))) for p in (1, 2) for _ in range(6)] + [(1, T0)] * 2
    readings = [(p, T0 + timedelta(minutes=rng.randint(0, 1400)), rng.randint(150, 260)) for p in (1, 2) for _ in range(45)]
    top = lambda t: t.replace(minute=0, second=0)
    hour = timedelta(hours=1)
    want = {}
    for p, t in meals:
        level = [v for q, x, v in readings if q == p and v > 180 and t <= x < t + hour]
        at, depth = top(t + hour), 1
        while level:
            day = want.setdefault((p, t.date()), [0, 0.0, 0])
            day[0], day[1], day[2] = max(day[0], depth), day[1] + sum(level), day[2] + len(level)
            here = [v for q, x, v in readings if q == p and v > 180 and at + hour <= x < at + 2 * hour]
            level, at, depth = [v for _ in level for v in here], top(at + hour), depth + 1
    got = {(r.patientid, r.day): (r.spike_duration, r._avg) for r in spike_chain(*_chain_tables(spark, meals, readings)).collect()}
    assert got.keys() == want.keys() and len(got) >= 2
    for k, (n, total, rows) in want.items():
        assert got[k][0] == n and abs(got[k][1] - total / rows) < 1e-9


def test_contiguous_chain_against_brute_force(spark):
    from vitalis.operators.chains import spike_chain_contiguous

    rng = random.Random(11)
    meals = [(p, T0 + timedelta(minutes=rng.randint(0, 2000))) for p in (1, 2, 3) for _ in range(12)] + [(1, T0)] * 2
    readings, seen = [], set()
    for p in (1, 2, 3):
        for _ in range(60):
            t = T0 + timedelta(minutes=rng.randint(0, 2400))
            if (p, t) not in seen:
                seen.add((p, t))
                readings.append((p, t, rng.randint(170, 260)))
    want = {}
    for p, t in meals:
        mine = [(x, v) for q, x, v in readings if q == p and v > 180 and x >= t]
        hours = {int((x - t).total_seconds() // 3600) for x, _ in mine}
        run = next(k for k in range(99) if k not in hours)
        if run:
            day = want.setdefault((p, t.date()), [0, {}])
            day[0] = max(day[0], run)
            day[1] |= {x: v for x, v in mine if x < t + timedelta(hours=run)}
    got = {(r.patientid, r.day): (r.spike_duration, r._avg) for r in spike_chain_contiguous(*_chain_tables(spark, meals, readings)).collect()}
    assert got.keys() == want.keys() and max(n for n, _ in got.values()) > 3
    for k, (n, found) in want.items():
        assert got[k][0] == n and abs(got[k][1] - sum(found.values()) / len(found)) < 1e-9


def test_first_surplus_rows_go(spark):
    """``limit`` surplus rows in the order of key and other columns (nulls last), whatever the copies; a key with a third of all rows."""
    import collections
    import random

    from vitalis.sources.etl import deduplicate

    rng = random.Random(11)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice(["a", "b", None]), rng.choice([1, 2, None])) for _ in range(60)] + [(2, "a", 1)] * 40
    df = spark.createDataFrame(rows, "p int, f string, v int")
    last = lambda r: tuple((x is None, x or 0 if not isinstance(x, str) else x) for x in r)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[:2]].append(r)
    surplus = sorted((r for g in groups.values() for r in sorted(g, key=last)[1:]), key=last)
    for k in (1, 2, 17, 55, len(surplus), 10_000):
        want = collections.Counter(rows) - collections.Counter(surplus[:k])
        assert collections.Counter(map(tuple, deduplicate(df, ["p", "f"], limit=k).collect())) == want, k
    assert deduplicate(df.limit(0), ["p", "f"], limit=1).collect() == []
    plan = deduplicate(df, ["p", "f"], limit=1)
    assert plan.columns == df.columns
