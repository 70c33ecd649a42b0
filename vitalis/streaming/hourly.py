"""Hourly multi-sensor summary as a stream (O73), its refresh (O16), and
stream de-duplication (O82).

The reference's materialised view is recomputed in full on REFRESH.  As a
stream, each sensor's readings feed one tumbling one-hour window aggregate;
with a watermark each (patient, hour) is emitted once, when no more rows can
change it (append mode), or repeatedly while it changes (update mode, upserted
by ``foreachBatch`` into a day-partitioned table with dynamic partition
overwrite, so only touched days are rewritten).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.functions.stats import round_half_up

# Sensor tag -> (table, value column, output name) of the summary.
SUMMARY_SENSORS = {"g": ("dexcom", "glucosevalue", "glucose"), "hr": ("heartrate", "hr", "hr"),
                   "temp": ("temperature", "temperature", "temp"), "eda": ("eda", "eda", "eda")}


def stream_hourly_summary(streams: Mapping[str, DataFrame], watermark: str = "2 hours") -> DataFrame:
    """``streams`` maps a tag of ``SUMMARY_SENSORS`` to that sensor's
    streaming DataFrame.  All are unioned as (patient, event_time, tag, value)
    and aggregated in one stateful windowed aggregation; hours without glucose
    are dropped (the view LEFT JOINs from glucose)."""
    parts = []
    for tag, df in streams.items():
        _, col, _ = SUMMARY_SENSORS[tag]
        parts.append(df.select(
            "patientid", F.col("date_time").cast("timestamp").alias("event_time"),
            F.lit(tag).alias("_tag"), F.col(col).cast("double").alias("_v"),
        ))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.withWatermark("event_time", watermark)
    aggs = []
    for tag in streams:
        v = F.when(F.col("_tag") == tag, F.col("_v"))
        name = SUMMARY_SENSORS[tag][2]
        aggs += [F.avg(v).alias(f"_a_{name}"), F.stddev_pop(v).alias(f"_s_{name}")]
    aggs.append(F.count(F.when(F.col("_tag") == "g", 1)).alias("_ng"))
    g = u.groupBy("patientid", F.window("event_time", "1 hour")).agg(*aggs)
    cols = []
    for tag in SUMMARY_SENSORS:
        name = SUMMARY_SENSORS[tag][2]
        if tag in streams:
            cols += [round_half_up(F.col(f"_a_{name}"), 2).alias(f"avg_{name}"), round_half_up(F.col(f"_s_{name}"), 2).alias(f"sd_{name}")]
        else:
            cols += [F.lit(None).cast("double").alias(f"avg_{name}"), F.lit(None).cast("double").alias(f"sd_{name}")]
    return g.where(F.col("_ng") > 0).select(
        "patientid", F.col("window.start").cast("timestamp_ntz").alias("hour"), *cols
    )


def _place(spark: SparkSession, path: str):
    """A path and its file system, any that Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _place(spark, path)
    return system.exists(at)


def stored_days(spark: SparkSession, path: str) -> set[date]:
    """The days that a table has a partition of, from its folders' names."""
    at, system = _place(spark, path)
    names = [f.getPath().getName() for f in system.listStatus(at)] if system.exists(at) else []
    return {date.fromisoformat(n[4:]) for n in names if n.startswith("day=") and n[4:5].isdigit()}


def drop_days(spark: SparkSession, path: str, days: Iterable[date]) -> None:
    """Removes the partitions of ``days`` from a table of this module."""
    for d in days:
        at, system = _place(spark, f"{path.rstrip('/')}/day={d.isoformat()}")
        system.delete(at, True)


def _write_days(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("day").parquet(path)


def upsert_hours(batch: DataFrame, path: str) -> None:
    """foreachBatch sink for update mode: replace the (patient, hour) rows of
    the touched days.  Only those day partitions are read and rewritten.  A
    column that only the table or only the batch has is NULL in the other's
    rows; any error in reading the table is raised."""
    from vitalis.session import checkpoint_dir

    spark = batch.sparkSession
    checkpoint_dir(spark)
    # the stateful query behind the batch runs once: the batch is written before it is used twice
    b = batch.withColumn("day", F.to_date("hour")).checkpoint(eager=True)
    if not exists(spark, path):
        return _write_days(b, path, "dynamic")
    days = [r["day"] for r in b.select("day").distinct().collect()]  # a handful of dates per trigger
    old = spark.read.parquet(path).where(F.col("day").isin(days))
    keep = old.join(b.select("patientid", "hour"), ["patientid", "hour"], "left_anti")
    # materialised before the partitions it was read from are overwritten
    _write_days(keep.unionByName(b, allowMissingColumns=True).checkpoint(eager=True), path, "dynamic")


def refresh_summary(spark: SparkSession, summary: DataFrame, path: str, since=None) -> None:
    """O16 REFRESH: the whole table anew (``since=None``), or only the days from ``since`` on; days that are no longer there
    go in both cases.  Build ``summary`` over tables that are cut at ``since`` themselves (``maintained.on_days``, or a
    filter on ``date_time``), so that the raw scan skips what is before it; ``maintained`` keeps moments and needs no
    recomputation of a day for new readings."""
    from vitalis.session import checkpoint_dir

    out = summary.withColumn("day", F.to_date("hour"))
    if since is None:
        return _write_days(out, path, "static")
    first = since if isinstance(since, date) else date.fromisoformat(str(since))
    checkpoint_dir(spark)
    # used twice: once written, once for its days
    out = out.where(F.col("day") >= F.lit(first)).checkpoint(eager=True)
    days = {r["day"] for r in out.select("day").distinct().collect()}
    if days:
        _write_days(out, path, "dynamic")
    drop_days(spark, path, {d for d in stored_days(spark, path) if d >= first} - days)


def stream_dedup(stream: DataFrame, keys, watermark: str = "10 minutes", ts: str = "date_time") -> DataFrame:
    """Drop repeated sensor rows (same key) arriving within the watermark delay."""
    s = stream.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", watermark)
    return s.dropDuplicatesWithinWatermark(list(keys)).drop("event_time")
