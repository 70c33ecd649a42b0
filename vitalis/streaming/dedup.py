"""Duplicates beyond the watermark (O82): a published table that takes each row once, however late its copy comes.

``dropDuplicatesWithinWatermark`` forgets a row when the watermark has passed it.  Here the published table itself is the memory:
it is partitioned by day, and beside it lies a Bloom filter for each day, stored as bitmaps (two hashes of a row's key, a fixed number of
bits a day).  A batch meets the filters of its own days only.  Rows whose bits are not all set are new for certain; the few others
are compared with the published rows of their days, so nothing is dropped by a false hit.

``append_new`` is a ``foreachBatch`` sink.  The filter is written before the rows: after a failure in between the filter only has bits
too many, and the batch, given again, is compared and appended where it is missing.  One writer at a time.

Defined cases: copies within a batch are one row (the first in the order of all columns); keys are equal if all key columns are, NULL
being equal to NULL; rows with a NULL time are one more partition; an empty batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.operators.windows import first_per_key, join_null_safe
from vitalis.session import checkpoint_dir
from vitalis.streaming.hourly import exists

#: Bits of a day's filter: with two hashes, a tenth of it in rows gives 3 % of rows to compare; more rows compare more, and lose nothing.
BITS = 1 << 26
HASHES = 2


def _bit(keys: Sequence[str], i: int, bits: int) -> Column:
    """The place that hash i of a row sets, from 1 on, as the bitmap functions count."""
    return F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(bits)) + 1


def _marks(rows: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """day, bucket, bits: the bitmaps that ``rows`` (with ``day``) set; added up before the shuffle."""
    places = rows.select("day", F.explode(F.array(*(_bit(keys, i, bits) for i in range(HASHES)))).alias("p"))
    return places.groupBy("day", F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def _days(df: DataFrame, rows: DataFrame) -> DataFrame:
    """``df`` on the days of ``rows``: a filter on the partition column (as many values as a batch has days)."""
    days = [r["day"] for r in rows.select("day").distinct().collect()]
    inside = F.col("day").isin([d for d in days if d is not None])
    return df.where(inside | F.col("day").isNull() if None in days else inside)


def append_new(batch: DataFrame, path: str, keys: Sequence[str], ts: str = "date_time", bits: int = BITS) -> None:
    """Appends the rows of ``batch`` whose ``keys`` the table at ``path`` does not hold yet."""
    spark, keys = batch.sparkSession, list(keys)
    checkpoint_dir(spark)
    marks_path = f"{path.rstrip('/')}-filter"
    others = [F.col(c) for c in batch.columns if c not in keys]
    rows = first_per_key(batch, keys, others) if others else batch.distinct()
    rows = rows.select(batch.columns).withColumn("day", F.to_date(ts)).checkpoint(eager=True)
    if rows.isEmpty():
        return
    fresh = rows
    known = exists(spark, path) and exists(spark, marks_path)
    if known:
        marks = _days(spark.read.parquet(marks_path), rows)
        tested = rows
        for i in range(HASHES):
            one = marks.select("day", "bucket", F.col("bits").alias("_bits"))
            placed = tested.withColumn("_p", _bit(keys, i, bits)).withColumn("bucket", F.bitmap_bucket_number("_p"))
            tested = join_null_safe(placed, one, ["day", "bucket"], "left").withColumn(f"_hit{i}", _is_set(F.col("_bits"), F.col("_p"))).drop("_p", "bucket", "_bits")
        tested = tested.withColumn("_seen", F.col("_hit0") & F.col("_hit1")).drop("_hit0", "_hit1").checkpoint(eager=True)
        maybe = tested.where("_seen").drop("_seen")
        held = _days(spark.read.parquet(path), maybe).select(*keys, "day").distinct()
        fresh = tested.where("NOT _seen").drop("_seen").unionByName(join_null_safe(maybe, held, [*keys, "day"], "left_anti")).checkpoint(eager=True)
    new = _marks(fresh, keys, bits)
    if known:
        old = _days(spark.read.parquet(marks_path), fresh)
        new = new.unionByName(old.select(new.columns)).groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).checkpoint(eager=True)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(marks_path)
    fresh.write.mode("append").partitionBy("day").parquet(path)
