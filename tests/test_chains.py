"""The meal chains against a recursive walk, and plans that run no job before they are asked to."""

import collections
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from vitalis.operators.chains import food_chain, food_chain_counts, repeated

T0 = datetime(2024, 1, 1)
FOOD = "patientid int, time_begin timestamp_ntz, logged_food string, calorie int, sugar int, dietary_fiber int"


def walk(meals, spikes, hours, by_patient):
    """Rows of the recursive query: (patient, spike minute, meal, depth) -> how often."""
    reach = timedelta(hours=hours)
    anchors = {}
    for p, t in spikes:
        for m in meals:
            if m[0] == p and p is not None and m[1] is not None and t - reach <= m[1] < t:
                row = (t, p, *m[2:])
                slot = (p, m[1]) if by_patient else m[1]
                if slot not in anchors or row < anchors[slot][0]:
                    anchors[slot] = row, m
    out = collections.Counter()

    def down(p, spike, m, depth):
        out[p, spike, m, depth] += 1
        for e in meals:
            if e[0] == p and e[1] is not None and m[1] - reach <= e[1] < m[1]:
                down(p, spike, e, depth + 1)

    for (t, p, *_), m in anchors.values():
        down(p, t.replace(second=0), m, 1)
    return out


@pytest.mark.parametrize("by_patient", [False, True])
def test_food_chain_of_random_logs(spark, by_patient):
    """200 logs at once: each is its own patients, and its own hours for the anchors that are per time alone."""
    rng = random.Random(int(by_patient))
    meals, spikes, want = [], [], collections.Counter()
    for log in range(200):
        start, patients = T0 + timedelta(days=10 * log), (2 * log, 2 * log, 2 * log + 1)
        m = [(rng.choice(patients), start + timedelta(minutes=rng.choice([0, 30, 60, 90, 119, 120, 121, 180, 239, 240, 300, 500])), rng.choice("ab"), rng.randint(0, 2), 1, 1) for _ in range(rng.randint(0, 14))]
        s = [(rng.choice(patients), start + timedelta(minutes=rng.choice([60, 120, 130, 245, 310, 400]), seconds=rng.choice([0, 5]))) for _ in range(rng.randint(0, 4))]
        want += walk(m, s, 2, by_patient)
        meals += m
        spikes += s
    meals += [(None, T0, "x", 1, 1, 1), (1, None, "x", 1, 1, 1)]
    dexcom = spark.createDataFrame([(p, t, 200.0) for p, t in spikes] + [(0, T0, 100.0), (None, T0, 200.0)], "patientid int, date_time timestamp_ntz, glucosevalue double")
    foodlog = spark.createDataFrame(meals, FOOD)
    key = ("patientid", "food_time") if by_patient else ("food_time",)
    row = lambda r: (r.patientid, r.spike_time, (r.patientid, r.food_time, r.logged_food, r.calorie, r.sugar, r.dietary_fiber), r.depth)
    assert sum(want.values()) > 1000 and max(k[3] for k in want) >= 5
    assert collections.Counter(map(row, food_chain(dexcom, foodlog, anchor_key=key).collect())) == want
    counts = food_chain_counts(dexcom, foodlog, anchor_key=key).collect()
    assert {row(r): int(r.paths) for r in counts} == dict(want)


def test_counts_beyond_long(spark):
    """Two meals every half hour: the paths grow beyond 2 ** 63 and are still exact."""
    n, reach = 40, 4
    foodlog = spark.createDataFrame([(1, T0 + timedelta(minutes=30 * i), f, 1, 1, 1) for i in range(n) for f in "abcdefghij"[: 2 + 2 * (i < n - 1)]], FOOD)
    dexcom = spark.createDataFrame([(1, T0 + timedelta(minutes=30 * (n - 1), seconds=30), 200.0)], "patientid int, date_time timestamp_ntz, glucosevalue double")
    got = {(r.food_time, r.logged_food, r.depth): int(r.paths) for r in food_chain_counts(dexcom, foodlog, anchor_key=("patientid", "food_time")).collect()}
    # one anchor per meal time in the two hours before the spike; all of one spike minute
    total = collections.Counter()
    for a in range(n - 4, n):
        ends = {a: {1: 1}}
        total[a, 1] += 1
        for i in range(a - 1, -1, -1):
            paths = collections.Counter()
            for j in range(i + 1, min(i + reach, a) + 1):
                for d, c in ends[j].items():
                    paths[d + 1] += c
            ends[i] = {d: 4 * c for d, c in paths.items()}
            for d, c in paths.items():
                total[i, d] += c
    assert max(total.values()) > 2**63
    assert {(t, d): c for (t, f, d), c in got.items() if f == "b" and d > 1} == {(T0 + timedelta(minutes=30 * i), d): c for (i, d), c in total.items() if d > 1}


def test_counts_beyond_38_digits_are_an_error(spark):
    foodlog = spark.createDataFrame([(1, T0 + timedelta(minutes=30 * i), f, 1, 1, 1) for i in range(80) for f in "abcdefgh"], FOOD)
    dexcom = spark.createDataFrame([(1, T0 + timedelta(minutes=30 * 79, seconds=30), 200.0)], "patientid int, date_time timestamp_ntz, glucosevalue double")
    with pytest.raises(ArithmeticException):
        food_chain_counts(dexcom, foodlog).collect()


def test_repeated(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("c", 13)], "x string, k int").withColumn("k", F.col("k").cast("decimal(38,0)"))
    assert {r.x: r["count"] for r in repeated(df, "k", 4).groupBy("x").count().collect()} == {"a": 1, "b": 5, "c": 13}
    assert repeated(df, "k").columns == ["x"] and Decimal(1)


#: Keys that publish to the shared folder and read back.
WRITE = {"etl_publish", "a11_year_partition_written", "a14_refreshed", "a14_maintained"}


def test_no_key_runs_a_job_while_it_is_built(spark):
    """On tables that are set up already (reading the schema of a Parquet file is a job of its own)."""
    from vitalis.plans import registry
    from vitalis.sources.fixtures import sensor_tables

    registry.queries()
    tables, tracker, late = sensor_tables(spark, "/root/testdata/sf0.001"), spark.sparkContext.statusTracker(), []
    for k in [c for c in vars(type(tables)) if not c.startswith("_")]:
        getattr(tables, k)
    for k, e in registry.REGISTRY.items():
        if k not in WRITE:
            spark.sparkContext.setJobGroup(f"build-{k}", k)
            e.fn(tables)
            if tracker.getJobIdsForGroup(f"build-{k}"):
                late.append(k)
    spark.sparkContext.setJobGroup("rest", "rest")
    assert late == []
