"""Range partitioning by year with a default bucket (O13) and partition counts.

PostgreSQL's ``PARTITION BY RANGE (time_begin)`` with one partition per
listed year plus a DEFAULT partition becomes a derived ``bucket`` column and
``DataFrameWriter.partitionBy('bucket')``: one folder per bucket, and a filter
on ``bucket`` (or on a year) prunes folders at planning time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BUCKET = "nulls"  # the reference's name for its DEFAULT partition


def year_bucket(ts: str, years: Sequence[int]) -> Column:
    """Year of ``ts`` as text when it is one of ``years``; else the default bucket
    (NULL timestamps and every other year)."""
    y = F.year(F.col(ts))
    return F.when(y.isin(list(years)), y.cast("string")).otherwise(F.lit(DEFAULT_BUCKET))


def write_year_partitioned(df: DataFrame, path: str, ts: str, years: Sequence[int], mode: str = "overwrite") -> None:
    """O13 + O12: copy ``df`` into a year-partitioned Parquet table at ``path``.

    Dynamic partition overwrite replaces only the buckets present in ``df``,
    so a refresh of one year does not rewrite the others."""
    out = df.withColumn("bucket", year_bucket(ts, years))
    # by time inside a bucket: a year with most rows is cut into many tasks and files
    out = out.repartitionByRange("bucket", ts)
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def partition_counts(df: DataFrame, years: Sequence[int], extra: Sequence[Column] = ()) -> DataFrame:
    """Rows per bucket, every declared bucket listed (0 when empty).

    The bucket list is the partitioning parameter itself (a handful of names),
    so it is a literal; the counts come from one aggregation over ``df``."""
    spark = df.sparkSession
    names = spark.createDataFrame([(str(y),) for y in years] + [(DEFAULT_BUCKET,)], "bucket string")
    counts = df.groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count"), *extra)
    # at most len(years) + 1 rows on each side: the broadcast is size-bounded by construction
    out = names.join(F.broadcast(counts), "bucket", "left")
    return out.fillna(0)  # only the count columns are numeric
