"""Keys for operators that write, read back or take arguments: each is proved by what comes back from storage or by rows."""

from __future__ import annotations

import uuid
from datetime import date, timedelta
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.functions.time import micros_between
from vitalis.operators.joins import asof_backward, first_in_window, hour_bin_join
from vitalis.operators.windows import sessions
from vitalis.plans import advanced as A
from vitalis.plans import beginner as B
from vitalis.plans import cleaning as C
from vitalis.plans.registry import query
from vitalis.plans.sql_functions import register_sql
from vitalis.plans.sqlhelp import SECS, R
from vitalis.session import checkpoint_dir
from vitalis.sources import schemas
from vitalis.sources.etl import all_null_columns, cast_schema, clean_table, publish
from vitalis.sources.partitions import partition_counts, read_partitioned, write_year_partitioned
from vitalis.sources.tables import append_rows, insert_by_position, temp_table
from vitalis.streaming import maintained
from vitalis.streaming.hourly import SUMMARY_SENSORS, refresh_summary


def _path(t, name: str) -> str:
    """A new path in the session's shared folder."""
    return f"{checkpoint_dir(t.spark).rstrip('/')}/published-{name}-{uuid.uuid4().hex}"


# --------------------------------------------------------------- O2-O10, publish
@query("etl_publish", C._sql_clean("foodlog"))
def etl_publish(t):
    """The cleaned food log published sorted by patient and time, and read back."""
    path = _path(t, "foodlog")
    publish(clean_table(C.raw_table(t, "foodlog"), "foodlog"), path)
    return C._typed_out(t.spark.read.parquet(path), "foodlog")


_RAW = {tb: [C._raw_name(tb, f.name) for f in schemas.TYPED[tb].fields] + list(schemas.RAW_DROPS.get(tb, [])) for tb in sorted(schemas.TYPED)}


@query("etl_all_null_columns", "".join(f", raw_{tb} AS ({C._sql_raw(tb)})" for tb in _RAW) + " " + " UNION ALL ".join(
    f"SELECT '{tb}' AS table_name, '{c}' AS column_name FROM raw_{tb} HAVING COUNT({c}) = 0" for tb, cols in _RAW.items() for c in cols))
def etl_all_null_columns(t):
    """O4 over every column of the seven raw tables: the columns without a value, one aggregation a table."""
    out = None
    for tb in _RAW:
        part = all_null_columns(C.raw_table(t, tb)).select(F.lit(tb).alias("table_name"), "column_name")
        out = part if out is None else out.unionByName(part)
    return out


def _spoiled(t) -> DataFrame:
    """Raw heart rates as text; readings on the first second of a minute are unreadable."""
    bad = F.second("date_time") == 0
    return t.heartrate.select(F.col("patientid").cast("string").alias("patientid"), F.col("date_time").cast("string").alias("date_time"),
                              F.when(bad, F.lit("n/a")).otherwise(F.col("hr").cast("string")).alias("hr"))


@query("etl_quarantine", """
SELECT CASE WHEN extract('second' FROM date_time) = 0 THEN 'bad' ELSE 'good' END AS part, patientid, COUNT(*) AS n FROM heartrate GROUP BY 1, 2
""")
def etl_quarantine(t):
    """O6 with quarantine: readable and set-aside rows of a raw table with bad text, by patient."""
    good, bad = cast_schema(_spoiled(t), schemas.TYPED["heartrate"], "quarantine")
    parts = [df.groupBy(F.lit(name).alias("part"), F.col("patientid").cast("int").alias("patientid")).agg(F.count("*").alias("n")) for name, df in (("good", good), ("bad", bad))]
    return parts[0].unionByName(parts[1])


# --------------------------------------------------------------- O11, O12, O15
@query("t11_append_rows", f"""
, added AS (SELECT patientid, gender, CAST(hba1c AS DOUBLE) AS hba1c FROM demography
            UNION ALL SELECT * FROM (VALUES (900001, 'FEMALE', CAST(NULL AS DOUBLE)), (900002, 'MALE', NULL)) v(p, g, h))
SELECT gender, COUNT(*) AS patients, COUNT(hba1c) AS measured, {R('AVG(hba1c)', 4)} AS avg_hba1c FROM added GROUP BY gender
""")
def t11_append_rows(t):
    """Rows with two of three columns appended: the third is NULL."""
    d = append_rows(t.spark, t.demography, [(900001, "FEMALE"), (900002, "MALE")], ["patientid", "gender"])
    return d.groupBy("gender").agg(F.count("*").alias("patients"), F.count("hba1c").alias("measured"), F.round(F.avg("hba1c"), 4).cast("double").alias("avg_hba1c"))


@query("t12_insert_by_position", "SELECT patientid AS who, date_time AS seen, CAST(hr AS DOUBLE) AS beats FROM heartrate")
def t12_insert_by_position(t):
    from pyspark.sql import types as T

    target = T.StructType([T.StructField("who", T.IntegerType()), T.StructField("seen", T.TimestampNTZType()), T.StructField("beats", T.DoubleType())])
    return insert_by_position(t.heartrate.select("patientid", "date_time", "hr"), target)


@query("t15_temp_table", "SELECT patientid, COUNT(*) AS readings, MAX(glucosevalue) AS highest FROM dexcom GROUP BY patientid")
def t15_temp_table(t):
    temp_table(t.dexcom, "t15_readings", persist=False)
    return t.spark.sql("SELECT patientid, COUNT(*) AS readings, MAX(glucosevalue) AS highest FROM t15_readings GROUP BY patientid")


# --------------------------------------------------------------- O13, O14
@query("a11_year_partition_written", A.a11_sql(A.A11_YEARS))
def a11_year_partition_written(t):
    """The food log written by year, read back and counted."""
    path = _path(t, "by-year")
    write_year_partitioned(t.foodlog, path, "time_begin", A.A11_YEARS)
    back = read_partitioned(t.spark, path).withColumn("bucket", F.col("bucket").cast("string"))
    return partition_counts(back, A.A11_YEARS, extra=[F.count_distinct("patientid").alias("patient_count")])


# --------------------------------------------------------------- O16
@query("a14_refreshed", f"""
, hours AS (SELECT patientid, date_trunc('hour', date_time) AS hour, AVG(glucosevalue) AS g FROM dexcom GROUP BY 1, 2)
SELECT CAST(hour AS DATE) AS day, COUNT(*) AS hours, {R('SUM(CAST(ROUND(CAST(g AS DECIMAL(38,12)), 2) AS DECIMAL(38,2)))', 2)} AS glucose FROM hours GROUP BY 1
""")
def a14_refreshed(t, since="2024-01-15"):
    """The hourly summary stored in full, then refreshed from a day on, and read back by day."""
    path = _path(t, "summary")
    refresh_summary(t.spark, A.hourly_sensor_summary(t), path)
    recent = SimpleNamespace(**{name: getattr(t, name).where(F.col("date_time") >= F.lit(since).cast("timestamp_ntz")) for name, _, _ in SUMMARY_SENSORS.values()})
    refresh_summary(t.spark, A.hourly_sensor_summary(recent), path, since=since)
    back = t.spark.read.parquet(path)
    return back.groupBy("day").agg(F.count("*").alias("hours"), F.sum(F.col("avg_glucose").cast("decimal(18,2)")).cast("double").alias("glucose"))


@query("a14_maintained", f"""
, whole AS (SELECT patientid, date_trunc('hour', date_time) AS hour, {', '.join(f"{R(f'AVG(v_{n})', 2)} AS avg_{n}, {R(f'stddev_pop(v_{n})', 2)} AS sd_{n}" for _, _, n in A._A14_PARTS)}
  FROM ({' UNION ALL BY NAME '.join(f"SELECT '{n}' AS part, patientid, date_time, {c} AS v_{n} FROM {tb}" for tb, c, n in A._A14_PARTS)})
  GROUP BY 1, 2 HAVING bool_or(part = 'glucose'))
SELECT * FROM whole WHERE CAST(hour AS DATE) <> DATE '2024-01-10'
""")
def a14_maintained(t, gone=date(2024, 1, 10)):
    """The hourly summary kept by moments: two thirds of the readings at first, the others folded in as a delta (twice, as after a
    restart), then a day whose readings are deleted made anew."""
    path, readings = _path(t, "moments"), maintained.sensors(t)
    late = F.second("date_time") % 3 == 0
    maintained.create({k: df.where(~late) for k, df in readings.items()}, path)
    for _ in range(2):
        maintained.merge_delta(t.spark, {k: df.where(late) for k, df in readings.items()}, path, batch=1)
    left = {k: df.where(F.to_date("date_time") != F.lit(gone)) for k, df in readings.items()}
    maintained.refresh_days(t.spark, left, path, [gone, gone + timedelta(days=1)])
    return maintained.summary(t.spark, path)


# --------------------------------------------------------------- O32
@query("a15_hour_range_join", f"""
, beats AS (SELECT patientid, date_trunc('hour', date_time) AS h, AVG(hr) AS m FROM heartrate GROUP BY 1, 2)
SELECT d.patientid, d.date_time, CAST(d.glucosevalue AS DOUBLE) AS glucosevalue, {R('b.m', 2)} AS hour_hr
FROM dexcom d LEFT JOIN beats b ON b.patientid = d.patientid AND d.date_time >= b.h AND d.date_time < b.h + INTERVAL 1 HOUR
""")
def a15_hour_range_join(t):
    """Each glucose reading with the mean heart rate of its hour."""
    from vitalis.functions.stats import round_half_up
    from vitalis.functions.time import trunc_hour

    beats = t.heartrate.groupBy("patientid", trunc_hour("date_time").alias("h")).agg(F.avg("hr").alias("m"))
    j = hour_bin_join(t.dexcom.select("patientid", "date_time", "glucosevalue"), beats, "patientid", "date_time", "h")
    return j.select("patientid", "date_time", F.col("glucosevalue").cast("double").alias("glucosevalue"), round_half_up(F.col("m"), 2).alias("hour_hr"))


# --------------------------------------------------------------- O36, O37
@query("t36_last_before_meal", """
SELECT f.patientid, f.time_begin, f.logged_food, CAST(f.calorie AS DOUBLE) AS calorie, d.date_time AS reading_time, CAST(d.glucosevalue AS DOUBLE) AS glucosevalue
FROM foodlog f ASOF LEFT JOIN (SELECT patientid, date_time, MAX(glucosevalue) AS glucosevalue FROM dexcom GROUP BY ALL) d
  ON d.patientid = f.patientid AND f.time_begin > d.date_time
""")
def t36_last_before_meal(t):
    """Every meal with the patient's last glucose reading before it."""
    meals = t.foodlog.select("patientid", "time_begin", "logged_food", F.col("calorie").cast("double").alias("calorie"))
    j = asof_backward(meals, t.dexcom, "patientid", "time_begin", "date_time", ["glucosevalue"], prefix="")
    return j.withColumnRenamed("date_time", "reading_time").withColumn("glucosevalue", F.col("glucosevalue").cast("double"))


@query("t37_first_after_meal", """
, nearest AS (
  SELECT f.patientid, f.time_begin, MIN((d.date_time, d.glucosevalue)) AS m
  FROM (SELECT DISTINCT patientid, time_begin FROM foodlog) f
  JOIN dexcom d ON d.patientid = f.patientid AND d.date_time BETWEEN f.time_begin AND f.time_begin + INTERVAL 2 HOUR GROUP BY ALL)
SELECT f.patientid, f.time_begin, f.logged_food, CAST(f.calorie AS DOUBLE) AS calorie, m[1] AS reading_time, CAST(m[2] AS DOUBLE) AS glucosevalue
FROM foodlog f LEFT JOIN nearest n ON n.patientid = f.patientid AND n.time_begin = f.time_begin
""")
def t37_first_after_meal(t):
    """Every meal with the patient's first glucose reading in the two hours from it."""
    meals = t.foodlog.select("patientid", "time_begin", "logged_food", F.col("calorie").cast("double").alias("calorie"))
    j = first_in_window(meals, t.dexcom, "patientid", "time_begin", "date_time", ["glucosevalue"], timedelta(0), timedelta(hours=2), prefix="")
    return j.withColumnRenamed("date_time", "reading_time").withColumn("glucosevalue", F.col("glucosevalue").cast("double"))


# --------------------------------------------------------------- O80
@query("i19_sessions", f"""
, steps AS (SELECT patientid, date_time, lag(date_time) OVER (PARTITION BY patientid ORDER BY date_time) AS before FROM dexcom),
marked AS (SELECT *, SUM(CASE WHEN before IS NULL OR date_diff('microsecond', before, date_time) > 43200000000 THEN 1 ELSE 0 END)
                     OVER (PARTITION BY patientid ORDER BY date_time) AS nth FROM steps)
SELECT patientid, COUNT(*) AS readings, MIN(date_time) AS session_start, MAX(date_time) AS last_reading,
       {SECS('MIN(date_time)', 'MAX(date_time)')} AS seconds FROM marked GROUP BY patientid, nth
""")
def i19_sessions(t, gap_minutes=720):
    """Glucose sessions: readings at most half a day apart."""
    s = sessions(t.dexcom.select("patientid", "date_time"), "patientid", "date_time", gap_minutes)
    return s.withColumn("seconds", micros_between("session_start", "last_reading") / 1e6)


# --------------------------------------------------------------- arguments and reachable limits
@query("a03_hourly_hr_glucose_patient", A._A03_SQL + "SELECT * FROM a03 WHERE new_patientid = 3")
def a03_hourly_hr_glucose_patient(t):
    """get_hourly_hr_glucose(3)."""
    return A.hourly_hr_glucose(t, 3)


@query("a09_hrv_after_crash_two_hours", A.a09_sql(2, "AND c.patientid % 3 = 0"))
def a09_hrv_after_crash_two_hours(t, hours=2):
    """get_hrv_after_glucose_crash with two hours, for every third patient."""
    third = SimpleNamespace(dexcom=t.dexcom.where("patientid % 3 = 0"), ibinterval=t.ibinterval)
    return A.hrv_after_crash(third, hours)


def _sql(t, text: str) -> DataFrame:
    register_sql(t.spark, t)
    return t.spark.sql(text)


@query("a09_hrv_after_crash_sql", A.a09_sql(3))
def a09_hrv_after_crash_sql(t):
    """The SQL table function with three hours, all patients."""
    return _sql(t, "SELECT * FROM get_hrv_after_glucose_crash(p_hours => 3)").withColumn("glucosevalue", F.col("glucosevalue").cast(t.dexcom.schema["glucosevalue"].dataType))


@query("a10_nutrient_alerts_sql", A.a10_sql())
def a10_nutrient_alerts_sql(t):
    return _sql(t, "SELECT * FROM get_nutrient_alerts()")


@query("a15_hourly_stress_sql", A.a15_sql())
def a15_hourly_stress_sql(t):
    return _sql(t, "SELECT * FROM summarize_hourly_glucose_hr()")


@query("a02_food_risk_of_day", """
, kw AS (SELECT * FROM (VALUES (0, 'anvil'), (1, 'widget'), (2, 'ring')) v(pos, k))
SELECT patientid, log_date, logged_food, first_match FROM (
  SELECT f.patientid, CAST(f.time_begin AS DATE) AS log_date, f.logged_food,
         (SELECT arg_min(k, pos) FROM kw WHERE contains(lower(f.logged_food), k)) AS first_match
  FROM foodlog f WHERE f.patientid = 1 AND CAST(f.time_begin AS DATE) >= DATE '2024-01-01') WHERE first_match IS NOT NULL AND log_date IN (
  SELECT MIN(CAST(time_begin AS DATE)) FROM foodlog WHERE patientid = 1)
""")
def a02_food_risk_of_day(t):
    """check_logged_food_risk(1, first day on which patient 1 logged a meal)."""
    day = t.foodlog.where("patientid = 1").agg(F.to_date(F.min("time_begin"))).scalar()
    return A.high_risk_food(t.foodlog, A.A02_KEYWORDS, patientid=1, day=day)


@query("b23_food_and_glucose_reachable", """
SELECT patientid FROM (SELECT patientid, AVG(glucosevalue) AS a FROM dexcom GROUP BY patientid)
WHERE a > 125 AND patientid IN (SELECT patientid FROM foodlog)
""")
def b23_food_and_glucose_reachable(t):
    """Limits that some patients of the data exceed."""
    return B.b23_food_and_glucose(t, 0, 125)
