"""Corrections and row frames on streams against the batch analyses, for random micro-batch splits."""

import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_intervals import rocks, run  # noqa: F401

from vitalis.plans.variants import a12_temp_stability_intended
from vitalis.streaming import corrections

T0 = datetime(2024, 1, 1)
SCHEMA = "patientid int, date_time timestamp_ntz, temperature double"


def rows(seed, n):
    rng = random.Random(seed)
    out = [(rng.choice([1, 2, None]), T0 + timedelta(seconds=rng.randrange(6 * 86_400)), rng.choice([None, 36.0, 36.25, 36.5, 37.75])) for _ in range(n)]
    return out + [(3, T0 + timedelta(hours=h), None) for h in range(3)] + [(4, T0 + timedelta(hours=h), 36.0 + 2 * (h == 2)) for h in range(3)] + out[:5]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_corrections_equal_the_batch_for_any_split(rocks, tmp_path, seed):  # noqa: F811
    data, rng = rows(seed, 120), random.Random(seed)
    rng.shuffle(data)
    cuts = sorted(rng.sample(range(1, len(data)), 4))
    parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
    log = run(rocks, tmp_path, parts, SCHEMA, lambda s: corrections.stream_status_changes(s, 0.5, "30 days"))
    changes = rocks.createDataFrame(log, "patientid int, day date, status string, change int")
    temps = rocks.createDataFrame(data, SCHEMA)
    key = lambda r: tuple(str(x) for x in (r.patientid, r.date_time, r.temperature, r.status))
    want = sorted(map(key, a12_temp_stability_intended(SimpleNamespace(temperature=temps)).collect()))
    assert sorted(map(key, corrections.reflagged(temps, changes).collect())) == want
    # one status a day; what is taken back was there
    assert corrections.folded(changes).groupBy("patientid", "day").count().where("count > 1").isEmpty()
    assert any(r.change == -1 for r in log) and sum(r.change for r in log) == corrections.folded(changes).count()


@pytest.mark.parametrize("preceding", [0, 3, 10])
def test_row_frames_of_shuffled_input(rocks, tmp_path, preceding):  # noqa: F811
    data = [r for r in rows(7, 200)] + [(1, None, 1.0)]
    rng = random.Random(7)
    rng.shuffle(data)
    end = [(k, T0 + timedelta(days=900), 0.0) for k in (1, 2, 3, 4, None)]
    got = run(rocks, tmp_path, [data[:70], data[70:150], data[150:], end, end], SCHEMA, lambda s: corrections.stream_moving_avg(s, preceding, watermark="400 days"))
    w = Window.partitionBy("patientid").orderBy("date_time", "temperature").rowsBetween(-preceding, 0)
    want = rocks.createDataFrame(data, SCHEMA).where("date_time IS NOT NULL").withColumn("rolling_avg", F.avg("temperature").over(w)).collect()
    key = lambda r: tuple(str(x) for x in (r.patientid, r.date_time, r.temperature, None if r.rolling_avg is None else round(r.rolling_avg, 9)))
    assert sorted(map(key, got)) == sorted(map(key, want))
