"""The hourly summary as a maintained table (O16): stored moments instead of a recomputed view.

Stored are, for each (patient, hour) and sensor, the number of rows and the moments of the values (n, mean, M2), in one
partition a day.  Moments of disjoint sets of readings merge exactly, so

* ``merge_delta`` folds new readings into the table without looking at the old ones: it reads the new readings and the
  stored partitions of the days they touch;
* ``refresh_days`` makes given days anew from the raw tables, after corrections or deletions: it reads the raw files of
  these days only (the range on ``date_time`` reaches the scan), and a day without readings loses its partition;
* ``summary`` gives the view's columns from the moments.

Only the touched day partitions are rewritten.  A rewritten day is first materialised in the shared checkpoint folder, since it
is computed from the partition that it replaces.  One job at a time may change a table.  ``merge_delta`` is not idempotent:
give a stream's batch id as ``batch``, and a batch that was folded in already is skipped.

Defined cases: NULL values count as rows, not as values; an hour is in the summary if it has a glucose row; readings without a
time or patient keep NULL as their hour or patient (day partition ``__HIVE_DEFAULT_PARTITION__``); empty deltas change
nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.functions.stats import round_half_up
from vitalis.functions.time import trunc_hour
from vitalis.operators.windows import join_null_safe
from vitalis.session import checkpoint_dir
from vitalis.streaming.hourly import SUMMARY_SENSORS, drop_days, exists, stored_days

_STATS = ("rows", "n", "mean", "m2")


def sensors(tables) -> dict[str, DataFrame]:
    """The four sensors of the summary from a tables object, by tag."""
    return {tag: getattr(tables, table) for tag, (table, _, _) in SUMMARY_SENSORS.items()}


def on_days(readings: Mapping[str, DataFrame], days: Iterable[date]) -> dict[str, DataFrame]:
    """The readings of some days, as ranges of ``date_time`` that the scan can use: neighbouring days are one range."""
    ranges: list[list[date]] = []
    for d in sorted(set(days)):
        if ranges and ranges[-1][1] == d:
            ranges[-1][1] = d + timedelta(days=1)
        else:
            ranges.append([d, d + timedelta(days=1)])
    at, inside = F.col("date_time"), None
    for lo, hi in ranges:
        one = (at >= F.lit(str(lo)).cast("timestamp_ntz")) & (at < F.lit(str(hi)).cast("timestamp_ntz"))
        inside = one if inside is None else inside | one
    return {tag: df.where(F.lit(False) if inside is None else inside) for tag, df in readings.items()}


def moments(readings: Mapping[str, DataFrame]) -> DataFrame:
    """patientid, hour, day and, for each sensor tag, rows_, n_, mean_, m2_: one aggregation over the union of the sensors."""
    union = None
    for tag, df in readings.items():
        value = F.col(SUMMARY_SENSORS[tag][1]).cast("double")
        one = df.select("patientid", trunc_hour("date_time").alias("hour"), F.lit(tag).alias("_tag"), value.alias("_v"))
        union = one if union is None else union.unionByName(one)
    aggs = []
    for tag in SUMMARY_SENSORS:
        here = F.col("_tag") == tag
        v = F.when(here, F.col("_v"))
        aggs += [F.count(F.when(here, 1)).alias(f"rows_{tag}"), F.count(v).alias(f"n_{tag}"), F.coalesce(F.avg(v), F.lit(0.0)).alias(f"mean_{tag}"), F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias(f"m2_{tag}")]
    return union.groupBy("patientid", "hour").agg(*aggs).withColumn("day", F.to_date("hour"))


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Moments of the readings of both, hour by hour."""
    side = {x: [f"{s}_{t}" for t in SUMMARY_SENSORS for s in _STATS] for x in "ab"}
    left = a.select("patientid", "hour", "day", *(F.col(c).alias(f"a_{c}") for c in side["a"]))
    right = b.select("patientid", "hour", "day", *(F.col(c).alias(f"b_{c}") for c in side["b"]))
    keys = ["patientid", "hour", "day"]
    both = join_null_safe(left.withColumn("_a", F.lit(True)), right, keys, "left").unionByName(join_null_safe(right, left, keys, "left_anti"), allowMissingColumns=True)

    def of(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    out: list[Column] = []
    for t in SUMMARY_SENSORS:
        na, nb, shift = of(f"a_n_{t}"), of(f"b_n_{t}"), of(f"b_mean_{t}") - of(f"a_mean_{t}")
        n = na + nb
        share = F.when(n > 0, nb / n).otherwise(0.0)
        out += [(of(f"a_rows_{t}") + of(f"b_rows_{t}")).alias(f"rows_{t}"), n.alias(f"n_{t}"), (of(f"a_mean_{t}") + shift * share).alias(f"mean_{t}"),
                (of(f"a_m2_{t}") + of(f"b_m2_{t}") + shift * shift * na * share).alias(f"m2_{t}")]
    return both.select("patientid", "hour", *out, "day")


def _replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def create(readings: Mapping[str, DataFrame], path: str) -> None:
    """The table from all readings."""
    moments(readings).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(path)


def merge_delta(spark: SparkSession, delta: Mapping[str, DataFrame], path: str, batch: int | None = None) -> None:
    """Folds new readings into the table.  With ``batch`` (ascending) a batch is folded in once, however often it is given."""
    checkpoint_dir(spark)
    done = f"{path.rstrip('/')}-batches"
    if batch is not None and exists(spark, done) and not spark.read.parquet(done).where(F.col("batch") >= batch).isEmpty():
        return
    new = moments(delta).checkpoint(eager=True)
    days = [r["day"] for r in new.select("day").distinct().collect()]  # as many as the delta touches
    if days and exists(spark, path):
        touched = F.col("day").isin([d for d in days if d is not None]) | (F.col("day").isNull() & F.lit(None in days))
        new = merged(spark.read.parquet(path).where(touched), new).checkpoint(eager=True)
    if days:
        _replace(new, path)
    if batch is not None:
        spark.range(1).select(F.lit(batch).cast("long").alias("batch")).coalesce(1).write.mode("append").parquet(done)


def refresh_days(spark: SparkSession, readings: Mapping[str, DataFrame], path: str, days: Iterable[date]) -> None:
    """Makes ``days`` anew from the raw readings; days that have none any more lose their partition."""
    checkpoint_dir(spark)
    days = set(days)
    if not days:
        return
    fresh = moments(on_days(readings, days)).checkpoint(eager=True)
    found = {r["day"] for r in fresh.select("day").distinct().collect()}
    if found:
        _replace(fresh, path)
    drop_days(spark, path, (days - found) & stored_days(spark, path))


def summary(spark: SparkSession, path: str) -> DataFrame:
    """The view: patientid, hour and the mean and population SD of each sensor, for the hours with glucose."""
    cols = []
    for tag, (_, _, name) in SUMMARY_SENSORS.items():
        some = F.col(f"n_{tag}") > 0
        cols += [round_half_up(F.when(some, F.col(f"mean_{tag}")), 2).alias(f"avg_{name}"), round_half_up(F.when(some, F.sqrt(F.col(f"m2_{tag}") / F.col(f"n_{tag}"))), 2).alias(f"sd_{name}")]
    return spark.read.parquet(path).where("rows_g > 0").select("patientid", "hour", *cols)
