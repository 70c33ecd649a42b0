"""Golden cases from the reference's literal inserts (FIXTURES.md G1-G3),
streaming = batch on closed input, partitioned write + pruning, ETL checks."""

from datetime import date, datetime, timedelta
import os
import tempfile

from pyspark.sql import functions as F

from vitalis.operators.windows import time_gaps
from vitalis.plans.advanced import fasting_alerts, high_risk_food, hourly_sensor_summary, temp_stability
from vitalis.sources import schemas
from vitalis.sources.etl import cast_schema, check_references, check_unique, find_all_null_columns
from vitalis.sources.partitions import partition_counts, write_year_partitioned
from vitalis.streaming.alerts import stream_gap_alerts, stream_temp_stability
from vitalis.streaming.hourly import stream_dedup, stream_hourly_summary


def _run_stream(spark, sdf, name, mode="append"):
    q = sdf.writeStream.format("memory").queryName(name).outputMode(mode).option(
        "checkpointLocation", tempfile.mkdtemp(prefix="vitalis-ck-")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def _as_stream(spark, df):
    path = tempfile.mkdtemp(prefix="vitalis-src-")
    df.write.mode("overwrite").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1000).parquet(path)


def test_g1_fasting_alert(spark):
    s = spark.createDataFrame([(1, date(2025, 10, 3), 145.2), (2, date(2025, 10, 3), 120.0), (3, date(2025, 10, 3), None)],
                              "patientid int, fasting_day date, avg_fasting_glucose double")
    rows = fasting_alerts(s).collect()
    assert len(rows) == 1 and rows[0].message == "Patient 1 has high fasting glucose on 145.20"


def test_g2_high_risk_food(spark):
    f = spark.createDataFrame([(17, datetime(2025, 10, 3, 8, 30), "white rice"), (17, datetime(2025, 10, 3, 12, 45), "grilled chicken"),
                               (17, datetime(2025, 10, 3, 19, 0), "ice cream"), (17, datetime(2025, 10, 3, 20, 0), None)],
                              "patientid int, time_begin timestamp_ntz, logged_food string")
    got = sorted(r.logged_food for r in high_risk_food(f, patientid=17, day="2025-10-03").collect())
    assert got == ["ice cream", "white rice"]


G3 = [(19, 36.8, datetime(2025, 10, 7, 8, 5)), (19, 37.0, datetime(2025, 10, 7, 8, 15)), (19, 37.4, datetime(2025, 10, 7, 8, 35)),
      (19, 36.9, datetime(2025, 10, 7, 8, 45)), (19, 37.6, datetime(2025, 10, 7, 8, 55))]


def test_g3_temp_stability_batch_and_stream(spark):
    df = spark.createDataFrame(G3, "patientid int, temperature double, date_time timestamp_ntz")
    assert {r.status for r in temp_stability(df).collect()} == {"stable"}
    sd = df.agg(F.stddev_pop("temperature")).first()[0]
    assert abs(sd - 0.3072) < 1e-4
    streamed = _run_stream(spark, stream_temp_stability(_as_stream(spark, df)), "g3")
    assert sorted((r.temperature, r.status) for r in streamed.collect()) == sorted((t, "stable") for _, t, _ in G3)


def test_temp_stability_stream_equals_batch(spark):
    base = datetime(2024, 1, 1)
    rows = [(p, 36.0 + ((i * 7 + p) % 30) / 10.0, base + timedelta(minutes=11 * i)) for p in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "patientid int, temperature double, date_time timestamp_ntz")
    batch = sorted(temp_stability(df).collect())
    streamed = sorted(_run_stream(spark, stream_temp_stability(_as_stream(spark, df)), "ts_eq").collect())
    assert streamed == batch


def test_gap_alert_stream_equals_batch(spark):
    base = datetime(2024, 1, 1)
    mins = [0, 5, 20, 21, 50, 51, 52, 200, 1440 + 3]
    df = spark.createDataFrame([(p, base + timedelta(minutes=m)) for p in (1, 2) for m in mins], "patientid int, date_time timestamp_ntz")
    batch = sorted((r.patientid, r.previous_time, r.date_time) for r in time_gaps(df, "patientid", "date_time", 10).collect())
    got = _run_stream(spark, stream_gap_alerts(_as_stream(spark, df), 10), "gaps")
    assert sorted((r.patientid, r.previous_time, r.date_time) for r in got.collect()) == batch


def test_hourly_summary_stream_equals_batch(spark):
    from vitalis.sources.fixtures import sensor_tables

    t = sensor_tables(spark, "/root/testdata/sf0.001")
    batch = hourly_sensor_summary(t)
    streams = {"g": _as_stream(spark, t.dexcom), "hr": _as_stream(spark, t.heartrate),
               "temp": _as_stream(spark, t.temperature), "eda": _as_stream(spark, t.eda)}
    got = _run_stream(spark, stream_hourly_summary(streams), "hourly", mode="complete")
    assert sorted(got.collect()) == sorted(batch.select(got.columns).collect())


def test_stream_dedup(spark):
    base = datetime(2024, 1, 1)
    rows = [(1, base, 70.0), (1, base, 70.0), (1, base + timedelta(seconds=1), 71.0)]
    df = spark.createDataFrame(rows, "patientid int, date_time timestamp_ntz, hr double")
    got = _run_stream(spark, stream_dedup(_as_stream(spark, df), ["patientid", "date_time", "hr"]), "dedup")
    assert got.count() == 2


def test_year_partitions_and_pruning(spark):
    rows = [(datetime(2019, 5, 1), 1), (datetime(2020, 1, 1), 2), (datetime(2020, 12, 31, 23, 59), 2), (None, 3), (datetime(2024, 3, 3), 4)]
    df = spark.createDataFrame(rows, "time_begin timestamp_ntz, patientid int")
    path = os.path.join(tempfile.mkdtemp(prefix="vitalis-part-"), "foodlog")
    write_year_partitioned(df, path, "time_begin", [2019, 2020, 2025])
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    counts = {r.bucket: r.row_count for r in partition_counts(back, [2019, 2020, 2025]).collect()}
    assert counts == {"2019": 1, "2020": 2, "2025": 0, "nulls": 2}
    plan = back.where("bucket = '2020'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2020" in plan


def test_etl_checks(spark):
    raw = spark.createDataFrame([("1", "MALE", "5.6"), ("2", "FEMALE", "6.1"), ("2", "FEMALE", "x")], "patientid string, gender string, hba1c string")
    good, bad = cast_schema(raw, schemas.DEMOGRAPHY, on_error="quarantine")
    assert good.count() == 2 and bad.count() == 1
    assert check_unique(good, ["patientid"]).first().duplicate_groups == 0
    lenient = cast_schema(raw, schemas.DEMOGRAPHY, on_error="null")
    assert lenient.where("hba1c IS NULL").count() == 1
    assert check_unique(lenient, ["patientid"]).first().duplicate_groups == 1
    facts = spark.createDataFrame([(1,), (5,)], "patientid int")
    assert [r.patientid for r in check_references(facts, good, "patientid").collect()] == [5]
    wide = raw.withColumn("empty", F.lit(None).cast("string"))
    assert find_all_null_columns(wide) == ["empty"]


def test_sql_table_functions(spark):
    from vitalis.plans.advanced import hourly_hr_glucose, patient_variability
    from vitalis.plans.sql_functions import register_sql
    from vitalis.sources.fixtures import sensor_tables

    t = sensor_tables(spark, "/root/testdata/sf0.001")
    register_sql(spark, t)
    assert sorted(spark.sql("SELECT * FROM get_hourly_hr_glucose()").collect()) == sorted(hourly_hr_glucose(t).collect())
    assert sorted(spark.sql("SELECT * FROM get_hourly_hr_glucose(3)").collect()) == sorted(hourly_hr_glucose(t, 3).collect())
    assert sorted(spark.sql("SELECT * FROM get_patient_variability()").collect()) == sorted(patient_variability(hourly_hr_glucose(t)).collect())


def test_table_plumbing(spark):
    from vitalis.sources.tables import append_rows, insert_by_position, temp_table

    demo = spark.createDataFrame([(1, "MALE", 5.5)], "patientid int, gender string, hba1c double")
    more = append_rows(spark, demo, [(17, "MALE")], ["patientid", "gender"])
    assert more.where("patientid = 17 AND hba1c IS NULL").count() == 1
    moved = insert_by_position(demo.select("patientid", "gender", "hba1c"), schemas.DEMOGRAPHY)
    assert moved.schema["hba1c"].dataType == schemas.DEMOGRAPHY["hba1c"].dataType
    temp_table(demo, "demo_tmp")
    assert spark.sql("SELECT count(*) c FROM demo_tmp").first().c == 1


def test_sessions_match_gaps(spark):
    from vitalis.operators.windows import sessions

    base = datetime(2024, 1, 1)
    mins = [0, 5, 20, 21, 50, 51, 52, 200]
    df = spark.createDataFrame([(1, base + timedelta(minutes=m)) for m in mins], "patientid int, date_time timestamp_ntz")
    s = sessions(df, "patientid", "date_time", 10)
    gaps = time_gaps(df, "patientid", "date_time", 10).count()
    assert s.count() == gaps + 1 and s.agg(F.sum("readings")).first()[0] == len(mins)


def test_stream_sliding_avg(spark):
    from vitalis.streaming.windows import stream_sliding_avg

    base = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, base + timedelta(minutes=m), float(m)) for m in range(0, 30, 3)], "patientid int, date_time timestamp_ntz, hr double")
    got = _run_stream(spark, stream_sliding_avg(_as_stream(spark, df), "patientid", "date_time", "hr"), "slide", mode="complete")
    row = got.where(F.col("window_start") == base).first()
    assert row.n == 4 and row.avg_value == 4.5


def test_hour_bin_join_equals_range_predicate(spark):
    from vitalis.operators.joins import hour_bin_join

    base = datetime(2024, 1, 1, 8)
    facts = spark.createDataFrame([(1, base + timedelta(minutes=m)) for m in (0, 59, 60, 119, 185)], "patientid int, date_time timestamp_ntz")
    bins = spark.createDataFrame([(1, base, 1.0), (1, base + timedelta(hours=1), 2.0)], "patientid int, hour_start timestamp_ntz, v double")
    got = sorted((r.date_time, r.v) for r in hour_bin_join(facts, bins, "patientid", "date_time", "hour_start").collect())
    assert got == [(base, 1.0), (base + timedelta(minutes=59), 1.0), (base + timedelta(minutes=60), 2.0),
                   (base + timedelta(minutes=119), 2.0), (base + timedelta(minutes=185), None)]


def test_summary_upsert_refresh_and_publish(spark):
    from vitalis.sources.etl import publish
    from vitalis.sources.fixtures import sensor_tables
    from vitalis.streaming.hourly import refresh_summary, upsert_hours

    t = sensor_tables(spark, "/root/testdata/sf0.001")
    batch = hourly_sensor_summary(t)
    out = os.path.join(tempfile.mkdtemp(prefix="vitalis-up-"), "summary")
    streams = {"g": _as_stream(spark, t.dexcom), "hr": _as_stream(spark, t.heartrate),
               "temp": _as_stream(spark, t.temperature), "eda": _as_stream(spark, t.eda)}
    q = (stream_hourly_summary(streams).writeStream.outputMode("update").foreachBatch(lambda b, _: upsert_hours(b, out))
         .option("checkpointLocation", tempfile.mkdtemp(prefix="vitalis-ck-")).trigger(availableNow=True).start())
    q.awaitTermination(180)
    got = spark.read.parquet(out).drop("day")
    assert sorted(got.select(batch.columns).collect()) == sorted(batch.collect())
    ref = os.path.join(tempfile.mkdtemp(prefix="vitalis-ref-"), "summary")
    refresh_summary(spark, batch, ref)
    refresh_summary(spark, batch, ref, since="2024-01-15")  # rewrites only the later days
    assert spark.read.parquet(ref).count() == batch.count()
    pub = os.path.join(tempfile.mkdtemp(prefix="vitalis-pub-"), "hr")
    publish(t.heartrate, pub)
    assert spark.read.parquet(pub).count() == t.heartrate.count()


def test_clean_all_and_integrity_report(spark):
    from vitalis.plans.cleaning import raw_table
    from vitalis.sources.etl import clean_all, integrity_report
    from vitalis.sources.fixtures import sensor_tables

    t = sensor_tables(spark, "/root/testdata/sf0.001")
    names = ["demography", "dexcom", "eda", "foodlog", "heartrate", "ibinterval", "temperature"]
    clean = clean_all({n: raw_table(t, n) for n in names})
    assert clean["heartrate"].count() == t.heartrate.distinct().count()
    rep = {(r.table_name, r.rule): r.violations for r in integrity_report(clean).collect()}
    assert rep[("demography", "duplicate_keys")] == 0 and rep[("demography", "null_keys")] == 0
    assert all(v == 0 for (tb, c), v in rep.items() if c == "missing_demography")
    assert len(rep) == 2 + 6


def test_stateless_alert_streams(spark):
    from vitalis.streaming.alerts import stream_fasting_alerts, stream_food_risk

    s = spark.createDataFrame([(1, date(2025, 10, 3), 145.2), (2, date(2025, 10, 3), 120.0)],
                              "patientid int, fasting_day date, avg_fasting_glucose double")
    got = _run_stream(spark, stream_fasting_alerts(_as_stream(spark, s)), "fast_alerts").collect()
    assert [(r.patientid, r.message) for r in got] == [(1, "Patient 1 has high fasting glucose on 145.20")]
    f = spark.createDataFrame([(17, datetime(2025, 10, 3, 8, 30), "White Rice"), (17, datetime(2025, 10, 3, 12, 45), "grilled chicken")],
                              "patientid int, time_begin timestamp_ntz, logged_food string")
    got = _run_stream(spark, stream_food_risk(_as_stream(spark, f)), "food_alerts").collect()
    assert [(r.logged_food, r.first_match) for r in got] == [("White Rice", "white rice")]


def test_parquet_sink_with_shared_checkpoint(spark):
    from vitalis.streaming.sinks import start_parquet_sink, stream_checkpoint

    base = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, base, 70.0), (1, base + timedelta(minutes=1), 72.0)], "patientid int, date_time timestamp_ntz, hr double")
    out = os.path.join(tempfile.mkdtemp(prefix="vitalis-sink-"), "hr")
    name = "hr_sink_" + os.path.basename(tempfile.mkdtemp())
    q = start_parquet_sink(_as_stream(spark, df), out, name, available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    assert stream_checkpoint(df, name).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_gap_alert_stream_with_idle_timeout(spark):
    base = datetime(2024, 1, 1)
    mins = [0, 5, 20, 21, 50, 200]
    df = spark.createDataFrame([(p, base + timedelta(minutes=m)) for p in (1, 2) for m in mins], "patientid int, date_time timestamp_ntz")
    batch = sorted((r.patientid, r.previous_time, r.date_time) for r in time_gaps(df, "patientid", "date_time", 10).collect())
    got = _run_stream(spark, stream_gap_alerts(_as_stream(spark, df), 10, idle_timeout="1 day"), "gaps_idle")
    assert sorted((r.patientid, r.previous_time, r.date_time) for r in got.collect()) == batch
