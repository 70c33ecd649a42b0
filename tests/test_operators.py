"""Operator tests against brute force on small invented rows (edge cases of
FIXTURES.md §4: equal timestamps, exact window edges, day boundaries, single
rows, constant series, NULLs)."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalis.functions.stats import round_half_up, safe_corr
from vitalis.functions.time import round_ms, trunc_hour, trunc_minute, trunc_week
from vitalis.operators.chains import spike_chain
from vitalis.operators.joins import anti_join_within, asof_backward, first_in_window, interval_join
from vitalis.operators.windows import moving_avg_rows_blocked, shift_over_time, streaks
from vitalis.sources.etl import deduplicate, find_duplicates

T0 = datetime(2024, 1, 30, 22, 0, 0)


def _events(spark):
    rows = [(1, T0), (1, T0 + timedelta(hours=1)), (1, T0 + timedelta(hours=2, minutes=30)), (2, T0), (3, T0 + timedelta(days=2))]
    return spark.createDataFrame(rows, "pid int, et timestamp_ntz")


def _readings(spark):
    offs = [-121, -120, -30, -1, 0, 1, 29, 30, 31, 59, 60, 61, 90, 119, 120, 121, 200, 24 * 60 + 5]
    rows = [(p, T0 + timedelta(minutes=m), float(i)) for p in (1, 2) for i, m in enumerate(offs)]
    rows += [(1, T0 + timedelta(minutes=30), 99.0)]  # equal timestamp, different value
    return spark.createDataFrame(rows, "pid int, rt timestamp_ntz, v double")


@pytest.mark.parametrize("lo,hi,closed", [(0, 120, "right"), (-30, 120, "both"), (-480, 0, "both"), (0, 60, "left"), (-120, 0, "left")])
def test_interval_join_equals_brute_force(spark, lo, hi, closed):
    ev, rd = _events(spark), _readings(spark)
    got = interval_join(ev, rd, "pid", "et", "rt", timedelta(minutes=lo), timedelta(minutes=hi), closed)
    d = (F.col("rt").cast("timestamp").cast("long") - F.col("et").cast("timestamp").cast("long")) / 60
    lo_ok = d >= lo if closed in ("both", "left") else d > lo
    hi_ok = d <= hi if closed in ("both", "right") else d < hi
    brute = ev.join(rd, "pid").where(lo_ok & hi_ok)
    cols = ["pid", "et", "rt", "v"]
    assert sorted(got.select(cols).collect()) == sorted(brute.select(cols).collect())


def test_anti_join_within(spark):
    ev, rd = _events(spark), _readings(spark)
    got = anti_join_within(ev, rd, "pid", "et", "rt", -timedelta(minutes=480), timedelta(0))
    d = (F.col("rt").cast("timestamp").cast("long") - F.col("et").cast("timestamp").cast("long")) / 60
    hit = ev.join(rd, "pid").where((d >= -480) & (d <= 0)).select("pid", "et").distinct()
    brute = ev.join(hit, ["pid", "et"], "left_anti")
    assert sorted(got.collect()) == sorted(brute.collect())


@pytest.mark.parametrize("strict", [True, False])
def test_asof_backward_equals_lateral(spark, strict):
    ev, rd = _events(spark), _readings(spark)
    got = asof_backward(ev, rd, "pid", "et", "rt", ["v"], strict=strict).toPandas()
    r = rd.toPandas()
    for _, e in ev.toPandas().iterrows():
        c = r[(r.pid == e.pid) & ((r.rt < e.et) if strict else (r.rt <= e.et))]
        g = got[(got.pid == e.pid) & (got.et == e.et)]
        if c.empty:
            assert g.prev_rt.isna().all()
        else:
            best = c.sort_values(["rt", "v"]).iloc[-1]
            assert g.prev_rt.iloc[0] == best.rt and g.prev_v.iloc[0] == best.v


def test_first_in_window(spark):
    ev, rd = _events(spark), _readings(spark)
    got = first_in_window(ev, rd, "pid", "et", "rt", ["v"], timedelta(0), timedelta(hours=2)).toPandas()
    r = rd.toPandas()
    for _, e in ev.toPandas().iterrows():
        c = r[(r.pid == e.pid) & (r.rt >= e.et) & (r.rt <= e.et + timedelta(hours=2))]
        g = got[(got.pid == e.pid) & (got.et == e.et)]
        if c.empty:
            assert g.next_rt.isna().all()
        else:
            assert g.next_rt.iloc[0] == c.sort_values(["rt", "v"]).iloc[0].rt


@pytest.mark.parametrize("direction", ["lag", "lead"])
def test_shift_over_time_equals_plain_window(spark, direction):
    rd = _readings(spark)
    got = shift_over_time(rd, "pid", "rt", ["rt", "v"], direction)
    w = Window.partitionBy("pid").orderBy("rt", "v")
    fn = F.lag if direction == "lag" else F.lead
    p = "prev_" if direction == "lag" else "next_"
    brute = rd.select("*", fn("rt").over(w).alias(p + "rt"), fn("v").over(w).alias(p + "v"))
    assert sorted(got.collect()) == sorted(brute.select(got.columns).collect())


@pytest.mark.parametrize("block", [11, 12, 50])
def test_blocked_rolling_equals_plain(spark, block):
    rd = _readings(spark)
    got = moving_avg_rows_blocked(rd, "pid", "rt", "v", 10, "ma", block=block)
    w = Window.partitionBy("pid").orderBy("rt", "v").rowsBetween(-10, 0)
    brute = rd.withColumn("ma", F.avg("v").over(w))
    assert sorted(got.collect()) == sorted(brute.select(got.columns).collect())


def test_streaks_low_day_opens_group(spark):
    days = [("2024-01-01", 150), ("2024-01-02", 100), ("2024-01-03", 150), ("2024-01-04", 150), ("2024-01-06", 150), ("2024-01-07", 150)]
    df = spark.createDataFrame([(1, pd.Timestamp(d).date(), float(v)) for d, v in days], "pid int, day date, a double")
    got = streaks(df, "pid", "day", F.when(F.col("a") > 140, 1).otherwise(0), 2, "g", "n").orderBy("g").collect()
    assert [r.n for r in got] == [2, 2]


def test_safe_corr_constant_and_single(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 3.0), (2, 5.0, 6.0), (3, 1.0, 1.0), (3, 2.0, 2.0)], "k int, x double, y double")
    got = {r.k: r.c for r in df.groupBy("k").agg(safe_corr("x", "y").alias("c")).collect()}
    assert got[1] is None and got[2] is None and abs(got[3] - 1.0) < 1e-12


def test_round_half_up_like_numeric(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (None,)], "x double")
    got = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    assert got == [1.01, 2.68, -1.01, None]


def test_time_bins(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 3, 5, 6, 7, 999600),)], "ts timestamp_ntz")
    r = df.select(trunc_minute("ts").alias("m"), trunc_hour("ts").alias("h"), trunc_week("ts").alias("w"), round_ms("ts").alias("ms")).first()
    assert r.m == datetime(2024, 1, 3, 5, 6) and r.h == datetime(2024, 1, 3, 5) and r.w == datetime(2024, 1, 1)
    assert r.ms == datetime(2024, 1, 3, 5, 6, 8)


def _recursive_spike_chain(meals, readings, cal, glu):
    """Literal evaluation of the recursive CTE (rows, then aggregate)."""
    rows = []
    for pid, tb, c in meals:
        if c <= cal:
            continue
        lvl = [(tb, pd.Timestamp(tb + timedelta(hours=1)).floor("h").to_pydatetime(), g)
               for p, t, g in readings if p == pid and tb <= t < tb + timedelta(hours=1) and g > glu]
        n = 1
        while lvl:
            rows += [(pid, tb.date(), n, g) for _, _, g in lvl]
            nxt = []
            for _, sh, _ in lvl:
                nxt += [(tb, sh + timedelta(hours=1), g) for p, t, g in readings
                        if p == pid and sh + timedelta(hours=1) <= t < sh + timedelta(hours=2) and g > glu]
            lvl, n = nxt, n + 1
    out = {}
    for pid, day, n, g in rows:
        d = out.setdefault((pid, day), [0, 0.0, 0])
        d[0] = max(d[0], n)
        d[1] += g
        d[2] += 1
    return {k: (v[0], round(v[1] / v[2], 6)) for k, v in out.items()}


def test_spike_chain_closed_form_equals_recursion(spark):
    # dense invented series: a reading every 20 minutes for 30 hours; high runs of at most
    # five hours (the literal recursion below is exponential in the run length)
    start = datetime(2024, 1, 1, 0, 0)

    def value(i):
        h, k = divmod(i, 3)
        high = h % 7 < 5 and not (k == 2 and h % 2 == 1)
        return 181 + (i * 13) % 50 if high else 150 + i % 20

    readings = [(1, start + timedelta(minutes=20 * i), value(i)) for i in range(90)]
    readings += [(2, start + timedelta(minutes=20 * i), 185 + (i % 3)) for i in range(14)]
    meals = [(1, start + timedelta(hours=1, minutes=10), 400), (1, start + timedelta(hours=1, minutes=10), 350),
             (1, start + timedelta(hours=5, minutes=50), 500), (1, start + timedelta(hours=20), 100),
             (2, start + timedelta(minutes=5), 900), (2, start + timedelta(hours=3, minutes=59), 301)]
    food = spark.createDataFrame([(p, t, float(c)) for p, t, c in meals], "patientid int, time_begin timestamp_ntz, calorie double")
    dx = spark.createDataFrame(readings, "patientid int, date_time timestamp_ntz, glucosevalue int")
    got = {(r.patientid, r.day): (r.spike_duration, round(r._avg, 6)) for r in spike_chain(food, dx, 300, 180).collect()}
    assert got == _recursive_spike_chain(meals, readings, 300, 180)


def test_dedup_all_and_limit_one(spark):
    rows = [(1, "a", 1.0)] * 3 + [(2, "b", 2.0)] * 2 + [(3, "c", 3.0)]
    df = spark.createDataFrame(rows, "k int, s string, v double")
    assert deduplicate(df, ["k", "s", "v"]).count() == 3
    assert deduplicate(deduplicate(df, ["k", "s", "v"]), ["k", "s", "v"]).count() == 3  # idempotent
    one = deduplicate(df, ["k", "s"], limit=1)
    assert one.count() == 5 and one.where("k = 1").count() == 2
    assert find_duplicates(df, ["k"]).count() == 2


@pytest.mark.parametrize("n,segment", [(4, None), (4, "0"), (3, "date_trunc('MINUTE', ts)")])
def test_ntile_over_values_equals_window(spark, n, segment):
    from vitalis.operators.windows import ntile_over_values

    rows = [(p, T0 + timedelta(minutes=i), None if i % 17 == 0 else float((i * 7) % 11)) for p in (1, 2) for i in range(p * 23)]
    rows += [(3, T0, 1.0)]
    rows += [(None, T0 + timedelta(minutes=i % 3), 2.0) for i in range(6)] + [(1, None, 2.0)]  # a NULL patient, a NULL time
    df = spark.createDataFrame(rows, "pid int, ts timestamp_ntz, v double")
    got = ntile_over_values(df, "pid", "v", ["ts"], n, "q", segment=segment and F.expr(segment))
    w = Window.partitionBy("pid").orderBy(F.col("v").asc_nulls_last(), F.col("ts"))
    brute = df.withColumn("q", F.ntile(n).over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, brute.select(got.columns).collect()))


def test_first_per_key_is_distinct_on(spark):
    from vitalis.operators.windows import first_per_key

    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "b"), (1, 1, "a"), (2, 5, "z")], "k int, t int, s string")
    got = sorted(first_per_key(df, "k", [F.col("t"), F.col("s")]).collect())
    assert [(r.k, r.t, r.s) for r in got] == [(1, 1, "a"), (2, 5, "z")]


def test_spike_chain_contiguous_equals_brute_force(spark):
    from vitalis.operators.chains import spike_chain_contiguous

    start = datetime(2024, 1, 1, 0, 0)
    vals = [190, 200, 150, 185, 150, 150, 150, 150, 150, 210, 182, 150] * 6
    # readings every 25 minutes: relative hours fill, skip, and islands break after >= 2 h without a high reading
    readings = [(i, 1, start + timedelta(minutes=25 * i), v) for i, v in enumerate(vals)]
    meals = [(1, start + timedelta(minutes=m), 400.0) for m in (0, 10, 200, 230, 600, 1500)] + [(1, start + timedelta(minutes=40), 100.0)]
    food = spark.createDataFrame(meals, "patientid int, time_begin timestamp_ntz, calorie double")
    dx = spark.createDataFrame(readings, "indexval int, patientid int, date_time timestamp_ntz, glucosevalue int")
    got = {(r.patientid, r.day): (r.spike_duration, round(r._avg, 9)) for r in spike_chain_contiguous(food, dx, 300, 180).collect()}
    exp, chain_vals = {}, {}
    for pid, t, c in meals:
        if c <= 300:
            continue
        ks = {int((ts - t).total_seconds() // 3600) for _, p, ts, g in readings if ts >= t and g > 180}
        run = 0
        while run in ks:
            run += 1
        if run == 0:
            continue
        day = t.date()
        d = exp.setdefault((pid, day), 0)
        exp[(pid, day)] = max(d, run)
        for idx, p, ts, g in readings:
            if ts >= t and g > 180 and (ts - t).total_seconds() // 3600 < run:
                chain_vals.setdefault((pid, day), {})[idx] = g
    exp = {k: (v, round(sum(chain_vals[k].values()) / len(chain_vals[k]), 9)) for k, v in exp.items()}
    assert got == exp


def _random_rows(seed, n, days=3, dup_every=7):
    import random

    rnd = random.Random(seed)
    base = datetime(2024, 1, 30)
    rows = []
    for i in range(n):
        ts = base + timedelta(minutes=rnd.randrange(0, days * 1440))
        rows.append((rnd.choice([1, 1, 1, 2, 3]), ts, float(rnd.randrange(0, 50))))
        if i % dup_every == 0:
            rows.append((rows[-1][0], ts, float(rnd.randrange(0, 50))))  # equal timestamp
    return rows


def _srt(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed,segment", [(1, "day"), (2, "day"), (3, "hour")])
def test_random_operators_equal_plain_forms(spark, seed, segment):
    rd = spark.createDataFrame(_random_rows(seed, 120), "pid int, rt timestamp_ntz, v double")
    ev = spark.createDataFrame([(p, t) for p, t, _ in _random_rows(seed + 100, 25)], "pid int, et timestamp_ntz").distinct()
    w = Window.partitionBy("pid").orderBy("rt", "v")
    # lag / lead
    for direction, fn in (("lag", F.lag), ("lead", F.lead)):
        got = shift_over_time(rd, "pid", "rt", ["v"], direction, prefix="x_", segment=segment)
        assert _srt(got) == _srt(rd.withColumn("x_v", fn("v").over(w)))
    # rolling 11-row frame with tiny blocks
    got = moving_avg_rows_blocked(rd, "pid", "rt", "v", 10, "ma", block=13, segment=segment)
    assert _srt(got) == _srt(rd.withColumn("ma", F.avg("v").over(w.rowsBetween(-10, 0))))
    # interval join, 90-minute window both sides open on the left
    got = interval_join(ev, rd, "pid", "et", "rt", -timedelta(minutes=30), timedelta(minutes=60), "right")
    d = (F.col("rt").cast("timestamp").cast("long") - F.col("et").cast("timestamp").cast("long")) / 60
    brute = ev.join(rd, "pid").where((d > -30) & (d <= 60))
    assert sorted(got.select("pid", "et", "rt", "v").collect()) == sorted(brute.select("pid", "et", "rt", "v").collect())
    # as-of backward (strict) against a per-event max over earlier readings
    got = asof_backward(ev, rd, "pid", "et", "rt", ["v"], strict=True, segment=segment).toPandas()
    r = rd.toPandas()
    for _, e in ev.toPandas().iterrows():
        c = r[(r.pid == e.pid) & (r.rt < e.et)]
        g = got[(got.pid == e.pid) & (got.et == e.et)].iloc[0]
        if c.empty:
            assert pd.isna(g.prev_rt)
        else:
            best = c.sort_values(["rt", "v"]).iloc[-1]
            assert (g.prev_rt, g.prev_v) == (best.rt, best.v)


@pytest.mark.parametrize("seed", [4, 5])
def test_random_window_and_anti_and_ntile(spark, seed):
    from vitalis.operators.windows import ntile_over_values

    rd = spark.createDataFrame(_random_rows(seed, 150), "pid int, rt timestamp_ntz, v double")
    ev = spark.createDataFrame([(p, t) for p, t, _ in _random_rows(seed + 50, 30)], "pid int, et timestamp_ntz").distinct()
    got = first_in_window(ev, rd, "pid", "et", "rt", ["v"], timedelta(minutes=-20), timedelta(hours=2)).toPandas()
    r = rd.toPandas()
    for _, e in ev.toPandas().iterrows():
        c = r[(r.pid == e.pid) & (r.rt >= e.et - timedelta(minutes=20)) & (r.rt <= e.et + timedelta(hours=2))]
        g = got[(got.pid == e.pid) & (got.et == e.et)].iloc[0]
        if c.empty:
            assert pd.isna(g.next_rt)
        else:
            best = c.sort_values(["rt", "v"]).iloc[0]
            assert (g.next_rt, g.next_v) == (best.rt, best.v)
    anti = anti_join_within(ev, rd, "pid", "et", "rt", -timedelta(hours=3), timedelta(0))
    d = (F.col("rt").cast("timestamp").cast("long") - F.col("et").cast("timestamp").cast("long")) / 60
    hit = ev.join(rd, "pid").where((d >= -180) & (d <= 0)).select("pid", "et").distinct()
    assert _srt(anti) == _srt(ev.join(hit, ["pid", "et"], "left_anti"))
    q = ntile_over_values(rd, "pid", "v", ["rt"], 4, "q")
    w = Window.partitionBy("pid").orderBy(F.col("v").asc_nulls_last(), F.col("rt"))
    # rows equal in (v, rt) are interchangeable, so compare the multiset of (pid, v, rt, q)
    assert _srt(q.select("pid", "rt", "v", "q")) == _srt(rd.withColumn("q", F.ntile(4).over(w)).select("pid", "rt", "v", "q"))


@pytest.mark.parametrize("descending,segments", [(True, 5), (False, 5), (True, 64)])
def test_rank_over_values_equals_global_rank(spark, descending, segments):
    from vitalis.operators.windows import rank_over_values

    rows = [(i, None if i % 13 == 0 else float((i * 7) % 23)) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = rank_over_values(df, "v", "r", descending=descending, segments=segments)
    order = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
    brute = df.withColumn("r", F.rank().over(Window.orderBy(order)))
    assert _srt(got.select("k", "v", "r")) == _srt(brute.select("k", "v", "r"))


@pytest.mark.parametrize("lo,hi,closed", [(0, 0, "both"), (-7, -3, "neither"), (13, 97, "left"), (-1500, 1500, "both"), (-61, 0, "right")])
def test_interval_join_random_windows(spark, lo, hi, closed):
    rd = spark.createDataFrame(_random_rows(11, 140), "pid int, rt timestamp_ntz, v double")
    ev = spark.createDataFrame([(p, t) for p, t, _ in _random_rows(12, 40)], "pid int, et timestamp_ntz").distinct()
    got = interval_join(ev, rd, "pid", "et", "rt", timedelta(minutes=lo), timedelta(minutes=hi), closed)
    d = (F.col("rt").cast("timestamp").cast("long") - F.col("et").cast("timestamp").cast("long")) / 60
    lo_ok = d >= lo if closed in ("both", "left") else d > lo
    hi_ok = d <= hi if closed in ("both", "right") else d < hi
    brute = ev.join(rd, "pid").where(lo_ok & hi_ok)
    cols = ["pid", "et", "rt", "v"]
    assert _srt(got.select(cols)) == _srt(brute.select(cols))
