"""The maintained summary against a full recomputation."""

import random
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from vitalis.plans.advanced import hourly_sensor_summary
from vitalis.streaming import hourly, maintained

T0 = datetime(2024, 1, 1)
VALUES = {"dexcom": "glucosevalue", "heartrate": "hr", "temperature": "temperature", "eda": "eda"}


def readings(seed, n):
    rng = random.Random(seed)
    return {t: [(rng.choice([1, 2, None]), T0 + timedelta(minutes=rng.randrange(12 * 1440)), rng.choice([None, *(rng.randrange(4000) / 16 for _ in range(6))])) for _ in range(n)] for t in VALUES}


def tables(spark, rows):
    return SimpleNamespace(**{t: spark.createDataFrame(r, f"patientid int, date_time timestamp_ntz, {VALUES[t]} double") for t, r in rows.items()})


def plain(df):
    return sorted((tuple("" if x is None else str(x) for x in r) for r in df.select(sorted(df.columns)).collect()))


def test_deltas_equal_a_recomputation(spark, tmp_path):
    path, rows = str(tmp_path / "t"), readings(1, 900)
    split = {t: [r[i::3] for i in range(3)] for t, r in rows.items()}
    maintained.create(maintained.sensors(tables(spark, {t: s[0] for t, s in split.items()})), path)
    for i in (1, 2, 2, 1):  # batches given again are skipped
        maintained.merge_delta(spark, maintained.sensors(tables(spark, {t: s[i] for t, s in split.items()})), path, batch=i)
    assert plain(maintained.summary(spark, path)) == plain(hourly_sensor_summary(tables(spark, rows)))
    empty = maintained.sensors(tables(spark, {t: [] for t in VALUES}))
    maintained.merge_delta(spark, empty, path)
    assert plain(maintained.summary(spark, path)) == plain(hourly_sensor_summary(tables(spark, rows)))


def test_a_delta_rewrites_touched_days_only(spark, tmp_path):
    path = tmp_path / "t"
    maintained.create(maintained.sensors(tables(spark, readings(2, 600))), str(path))
    files = {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in path.glob("day=*")}
    new = {t: [(1, datetime(2024, 1, 4, 5), 7.0)] if t == "dexcom" else [] for t in VALUES}
    maintained.merge_delta(spark, maintained.sensors(tables(spark, new)), str(path))
    changed = {d.name for d in path.glob("day=*") if sorted(f.name for f in d.glob("*.parquet")) != files[d.name]}
    assert changed == {"day=2024-01-04"}


def test_days_made_anew(spark, tmp_path):
    """Corrected, deleted and added days; a day without readings loses its partition, others are not touched."""
    path, rows = str(tmp_path / "t"), readings(3, 900)
    maintained.create(maintained.sensors(tables(spark, rows)), path)
    gone, changed = date(2024, 1, 5), date(2024, 1, 7)
    left = {t: [(p, at, v if at.date() != changed else 1.0) for p, at, v in r if at.date() != gone] for t, r in rows.items()}
    left["dexcom"].append((9, datetime(2024, 3, 1, 1), 5.0))
    maintained.refresh_days(spark, maintained.sensors(tables(spark, left)), path, [gone, changed, date(2024, 3, 1), date(2024, 5, 1)])
    assert plain(maintained.summary(spark, path)) == plain(hourly_sensor_summary(tables(spark, left)))
    assert gone not in hourly.stored_days(spark, path) and date(2024, 3, 1) in hourly.stored_days(spark, path)


def test_refresh_from_a_day_on_drops_vanished_days(spark, tmp_path):
    path, rows = str(tmp_path / "t"), readings(4, 500)
    hourly.refresh_summary(spark, hourly_sensor_summary(tables(spark, rows)), path)
    left = {t: [r for r in rs if r[1].date() not in (date(2024, 1, 3), date(2024, 1, 9))] for t, rs in rows.items()}
    hourly.refresh_summary(spark, hourly_sensor_summary(tables(spark, left)), path, since="2024-01-06")
    days = {r["day"] for r in spark.read.parquet(path).select("day").distinct().collect()}
    assert date(2024, 1, 3) in days and date(2024, 1, 9) not in days
    hourly.refresh_summary(spark, hourly_sensor_summary(tables(spark, {t: [] for t in VALUES})), path, since=date(2024, 1, 10))
    assert max(hourly.stored_days(spark, path)) < date(2024, 1, 10)


@pytest.mark.parametrize("days", [[date(2024, 1, 5)], [date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 9)]])
def test_only_the_days_asked_for_are_read(spark, tmp_path, days):
    rows = [(1, T0 + timedelta(hours=i), float(i)) for i in range(24 * 12)]
    spark.createDataFrame(rows, "patientid int, date_time timestamp_ntz, hr double").write.parquet(str(tmp_path / "hr"))
    raw = {"hr": spark.read.parquet(str(tmp_path / "hr"))}
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = maintained.moments(maintained.on_days(raw, days))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(x for x in plan.splitlines() if "PushedFilters" in x).split("PushedFilters")[1]
    assert pushed.count("GreaterThanOrEqual(date_time") == pushed.count("LessThan(date_time") == (1 if len(days) == 1 else 2)
    got = maintained.moments(maintained.on_days(raw, days)).select("day").distinct().collect()
    assert {r["day"] for r in got} == set(days)


def test_moments_of_far_values_stay_exact(spark):
    """Chan's merge keeps a small spread around a large mean."""
    base = 1e8
    parts = [[(1, T0, base + x) for x in xs] for xs in ([0.0, 1.0], [2.0, 3.0])]
    a, b = (maintained.moments({"hr": spark.createDataFrame(p, "patientid int, date_time timestamp_ntz, hr double")}) for p in parts)
    r = maintained.merged(a, b).first()
    assert (r.n_hr, r.mean_hr, r.m2_hr) == (4, base + 1.5, 5.0)
