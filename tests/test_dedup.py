"""A table that takes each row once, however late the copy."""

import random
from datetime import datetime, timedelta

import pytest

from vitalis.streaming import dedup

T0 = datetime(2024, 1, 1)
SCHEMA = "patientid int, date_time timestamp_ntz, hr double"


def held(spark, path):
    return sorted(tuple(str(x) for x in r) for r in spark.read.parquet(path).select("patientid", "date_time", "hr").collect())


@pytest.mark.parametrize("bits", [64, dedup.BITS])
def test_late_copies_go_and_nothing_else(spark, tmp_path, bits):
    """With 64 bits a day most tests are false hits, and still no row is lost."""
    path, rng, seen = str(tmp_path / "t"), random.Random(1), set()
    for i in range(5):
        rows = [(rng.choice([1, 2, None]), T0 + timedelta(days=rng.randrange(3), minutes=rng.randrange(200)), rng.choice([None, 1.0, 2.0])) for _ in range(80)]
        rows += rng.sample(sorted(seen, key=str), min(len(seen), 30)) + rows[:10] + [(1, None, 1.0)]
        dedup.append_new(spark.createDataFrame(rows, SCHEMA), path, ["patientid", "date_time", "hr"], bits=bits)
        seen |= set(rows)
        assert held(spark, path) == sorted(tuple(str(x) for x in r) for r in seen), i
    dedup.append_new(spark.createDataFrame([], SCHEMA), path, ["patientid", "date_time", "hr"], bits=bits)
    assert len(held(spark, path)) == len(seen)


def test_a_copy_a_month_late(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["patientid", "date_time"]
    first = [(1, T0, 60.0), (1, T0 + timedelta(minutes=1), 61.0)]
    dedup.append_new(spark.createDataFrame(first, SCHEMA), path, keys)
    for d in range(1, 4):
        dedup.append_new(spark.createDataFrame([(1, T0 + timedelta(days=10 * d), 70.0)], SCHEMA), path, keys)
    dedup.append_new(spark.createDataFrame([(1, T0, 99.0), (2, T0, 99.0)], SCHEMA), path, keys)
    assert len(held(spark, path)) == 6 and ("1", str(T0), "99.0") not in held(spark, path)


def test_a_batch_given_again_after_a_failure(spark, tmp_path):
    """The filter was written, the rows were not: they are appended when the batch comes again, once."""
    path, keys = str(tmp_path / "t"), ["patientid", "date_time", "hr"]
    rows = spark.createDataFrame([(1, T0 + timedelta(minutes=i), 1.0) for i in range(20)], SCHEMA)
    dedup.append_new(rows.where("date_time < '2024-01-01 00:10:00'"), path, keys)
    from pyspark.sql import functions as F

    marks = dedup._marks(rows.withColumn("day", F.to_date("date_time")), keys, dedup.BITS)
    marks.write.mode("overwrite").partitionBy("day").parquet(path + "-filter")
    for _ in range(2):
        dedup.append_new(rows, path, keys)
        assert len(held(spark, path)) == 20


def test_as_a_sink(spark, tmp_path):
    from vitalis.streaming.sinks import start_foreach_batch

    src, path = tmp_path / "in", str(tmp_path / "out")
    for i in range(3):
        spark.createDataFrame([(1, T0 + timedelta(days=30 * j), 1.0) for j in range(i + 1)], SCHEMA).coalesce(1).write.parquet(str(src / f"p={i}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(src))
    q = start_foreach_batch(stream, lambda b, _: dedup.append_new(b, path, ["patientid", "date_time", "hr"]), f"dedup-{random.random()}", mode="append", available_now=True)
    q.awaitTermination()
    assert len(held(spark, path)) == 3
