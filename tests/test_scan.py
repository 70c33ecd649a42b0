"""The ordered scan against plain windows over the key, on one patient-day that holds nine tenths of all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalis.functions.time import micros_between
from vitalis.operators import scan

DAY = datetime(2024, 1, 5)


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(1)
    rows = [(1, DAY + timedelta(milliseconds=rng.randrange(86_400_000)), float(rng.randint(0, 50))) for _ in range(18_000)]
    rows += [(rng.choice([2, 3, 4, None]), DAY + timedelta(minutes=rng.randrange(-9000, 9000)), rng.choice([None, 1.0, 2.0])) for _ in range(1900)]
    rows += [(5, None, 1.0), (5, None, 2.0), (5, DAY, None), (6, DAY, 1.0), (1, None, 3.0)]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "patientid int, at timestamp, v double, n int").withColumn("at", F.col("at").cast("timestamp_ntz")).repartition(5).persist()


def same(got, want):
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    a, b = (sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=key) for df in (got, want))
    assert a == b


ORDER = ["at", "v", "n"]


def window():
    return Window.partitionBy("patientid").orderBy(*ORDER)


@pytest.mark.parametrize("bits", [0, 1, 4, 8])
def test_segments_are_in_order_and_even(readings, bits):
    d = scan.segmented(readings, "patientid", ORDER, bits)
    total = d.count()
    sizes = [r["count"] for r in d.groupBy(scan.SEG).count().collect()]
    assert len(sizes) == 1 << bits and (max(sizes) <= 2 * total / len(sizes) or bits == 8)  # 78 rows a segment at 8 bits: noise of the sample
    edges = d.groupBy(scan.SEG).agg(F.min(F.struct("patientid", *ORDER)).alias("lo"), F.max(F.struct("patientid", *ORDER)).alias("hi"))
    w = Window.orderBy(scan.SEG)
    assert edges.withColumn("before", F.lag("hi").over(w)).where("before >= lo").isEmpty()


def test_no_task_holds_the_hot_day(spark, readings):
    """Rows by (segment, key), the unit of a window's task: at most twice the mean, where the calendar day holds nine tenths."""
    rows = readings.unionAll(readings.withColumn("at", F.col("at") + F.expr("INTERVAL 3 MILLISECONDS"))).unionAll(readings.withColumn("n", F.col("n") + 100_000))
    sizes = [r["count"] for r in scan.segmented(rows, "patientid", ORDER, 5).groupBy(scan.SEG, "patientid").count().collect()]
    assert max(sizes) <= 2 * rows.count() / 32
    assert max(r["count"] for r in rows.groupBy("patientid", F.to_date("at")).count().collect()) > 0.85 * rows.count()


@pytest.mark.parametrize("direction", ["lag", "lead"])
def test_shift(readings, direction):
    f = F.lag if direction == "lag" else F.lead
    got = scan.shift(readings, "patientid", ORDER, ["at", "v"], direction, prefix="p_")
    same(got, readings.withColumn("p_at", f("at").over(window())).withColumn("p_v", f("v").over(window())))


def test_running(readings):
    up, before = window().rowsBetween(Window.unboundedPreceding, 0), window().rowsBetween(Window.unboundedPreceding, -1)
    folds = {"s": scan.Fold("sum", F.col("v")), "c": scan.Fold("count", F.col("v")), "lo": scan.Fold("min", F.col("v"), own=False), "hi": scan.Fold("max", F.col("v")), "l": scan.Fold("last", F.col("v"), own=False), "k": scan.Fold("count", F.lit(1))}
    got = scan.running(readings, "patientid", ORDER, folds)
    want = readings.select("*", F.sum("v").over(up).alias("s"), F.count("v").over(up).alias("c"), F.min("v").over(before).alias("lo"), F.max("v").over(up).alias("hi"), F.last("v", ignorenulls=True).over(before).alias("l"), F.row_number().over(window()).alias("k"))
    same(got, want)


@pytest.mark.parametrize("kind", ["rank", "row_number"])
def test_ranked(readings, kind):
    order = [F.col("v").isNotNull(), -F.col("v"), *(["at", "n"] if kind == "row_number" else [])]
    f = {"rank": F.rank, "row_number": F.row_number}[kind]()
    same(scan.ranked(readings, [], order, "r", kind), readings.withColumn("r", f.over(Window.orderBy(*order))))
    same(scan.ranked(readings, ["patientid"], order, "r", kind), readings.withColumn("r", f.over(Window.partitionBy("patientid").orderBy(*order))))


@pytest.mark.parametrize("minutes", [0.02, 0.5, 700])
def test_sessions(readings, minutes):
    timed = readings.where("at IS NOT NULL")
    opens = lambda a, b: micros_between(a, b) > int(minutes * 60_000_000)
    got = scan.sessions_from(timed, "patientid", "at", opens, ["v", "n"])
    want = timed.withColumn("previous_time", F.lag("at").over(window()))
    new = F.col("previous_time").isNull() | opens(F.col("previous_time"), F.col("at"))
    want = want.withColumn("session_start", F.last(F.when(new, F.col("at")), ignorenulls=True).over(window().rowsBetween(Window.unboundedPreceding, 0)))
    same(got, want)


@pytest.mark.parametrize("strict", [True, False])
def test_asof(spark, readings, strict):
    rng = random.Random(2)
    left = spark.createDataFrame([(rng.choice([1, 1, 2, 3, 7, None]), DAY + timedelta(seconds=rng.randrange(-90_000, 90_000)), i) for i in range(1500)], "patientid int, t timestamp, x int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    right = readings.where("at IS NOT NULL").select("patientid", F.date_trunc("second", F.col("at")).cast("timestamp_ntz").alias("at"), "v", "n")
    got = scan.asof(left, right, "patientid", "t", "at", ["v", "n"], strict)
    hit = left.alias("l").join(right.alias("r"), F.col("l.patientid").eqNullSafe(F.col("r.patientid")) & ((F.col("at") < F.col("t")) if strict else (F.col("at") <= F.col("t"))), "left")
    best = hit.groupBy("l.patientid", "t", "x").agg(F.max(F.when(F.col("at").isNotNull(), F.struct("at", "v", "n"))).alias("m"))
    same(got, best.select("patientid", "t", "x", F.col("m.at").alias("prev_at"), F.col("m.v").alias("prev_v"), F.col("m.n").alias("prev_n")))


def test_empty_and_single(spark, readings):
    for d in (readings.limit(0), readings.where("n = 3")):
        same(scan.shift(d, "patientid", ORDER, ["v"]), d.withColumn("prev_v", F.lit(None).cast("double")))
        assert scan.running(d, "patientid", ORDER, {"k": scan.Fold("count", F.lit(1))}).count() == d.count()


def test_plan_moves_rows_once_and_broadcasts_only_carries(readings):
    plan = scan.shift(readings, "patientid", ORDER, ["at", "v"])._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
