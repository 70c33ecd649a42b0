"""SQL surface: the sensor tables as temporary views and the table
functions O83-O87 as SQL table functions (Spark 4 ``CREATE TEMPORARY FUNCTION
... RETURNS TABLE``), callable with and without the optional arguments:

    SELECT * FROM get_hourly_hr_glucose()        -- all patients
    SELECT * FROM get_hourly_hr_glucose(3)       -- one patient, filter pushed into both scans
    SELECT * FROM get_patient_variability() ORDER BY hr_stddev DESC
    SELECT * FROM get_hrv_after_glucose_crash(3, 2)     -- patient 3, two hours after each crash; both may be left out
    SELECT * FROM get_nutrient_alerts()
    SELECT * FROM summarize_hourly_glucose_hr()

Same one-aggregation plan as ``advanced.hourly_hr_glucose``: both sensors are
unioned and binned once (the FULL JOIN of two hourly aggregates, without the join).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SENSORS = ["demography", "dexcom", "heartrate", "eda", "ibinterval", "temperature", "foodlog"]

_HOUR = "make_timestamp_ntz(year(date_time), month(date_time), day(date_time), hour(date_time), 0, 0)"


def _r2(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,12)), 2) AS DOUBLE)"


HOURLY_HR_GLUCOSE = f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_hourly_hr_glucose(p_patientid INT DEFAULT NULL)
RETURNS TABLE (new_patientid INT, hour_bucket TIMESTAMP_NTZ, avg_hr DOUBLE, avg_glucose DOUBLE, clinical_flag STRING)
RETURN
WITH u AS (
  SELECT patientid, {_HOUR} AS hour_bucket, hr AS v_hr, CAST(NULL AS DOUBLE) AS v_g
  FROM heartrate WHERE p_patientid IS NULL OR patientid = p_patientid
  UNION ALL
  SELECT patientid, {_HOUR}, CAST(NULL AS DOUBLE), CAST(glucosevalue AS DOUBLE)
  FROM dexcom WHERE p_patientid IS NULL OR patientid = p_patientid),
b AS (SELECT patientid, hour_bucket, {_r2('AVG(v_hr)')} AS avg_hr, {_r2('AVG(v_g)')} AS avg_glucose
      FROM u GROUP BY patientid, hour_bucket)
SELECT patientid, hour_bucket, avg_hr, avg_glucose,
       CASE WHEN avg_hr IS NULL AND avg_glucose IS NULL THEN 'No Data'
            WHEN avg_hr < 60 THEN 'Bradycardia (Low HR)' WHEN avg_hr > 100 THEN 'Tachycardia (High HR)'
            WHEN avg_glucose < 70 THEN 'Hypoglycemia (Low Glucose)' WHEN avg_glucose > 180 THEN 'Hyperglycemia (High Glucose)'
            ELSE 'Normal Range' END
FROM b
"""

PATIENT_VARIABILITY = f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_patient_variability()
RETURNS TABLE (pv_patientid INT, hr_stddev DOUBLE, glucose_stddev DOUBLE, hr_cv DOUBLE, glucose_cv DOUBLE)
RETURN
SELECT new_patientid, {_r2('stddev_samp(avg_hr)')}, {_r2('stddev_samp(avg_glucose)')},
       {_r2('try_divide(stddev_samp(avg_hr), AVG(avg_hr))')}, {_r2('try_divide(stddev_samp(avg_glucose), AVG(avg_glucose))')}
FROM get_hourly_hr_glucose() GROUP BY new_patientid
"""


_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {0})"

# crashes and beats meet in buckets as long as the window: a crash goes into the two it touches, and no patient is one task
HRV_AFTER_CRASH = f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_hrv_after_glucose_crash(p_patientid INT DEFAULT NULL, p_hours INT DEFAULT 1)
RETURNS TABLE (patientid INT, glucose_crash_time TIMESTAMP_NTZ, glucosevalue DOUBLE, rmssd DOUBLE, sdnn DOUBLE, pnn50 DOUBLE)
RETURN
WITH crash AS (
  SELECT patientid, date_time AS t, glucosevalue, {_US.format('date_time')} AS us,
         explode(array_distinct(array({_US.format('date_time')} div (p_hours * 3600000000), ({_US.format('date_time')} + p_hours * 3600000000) div (p_hours * 3600000000)))) AS slot
  FROM dexcom WHERE glucosevalue < 70 AND (p_patientid IS NULL OR patientid = p_patientid)),
beat AS (
  SELECT patientid, date_time, ibi, {_US.format('date_time')} AS us, {_US.format('date_time')} div (p_hours * 3600000000) AS slot
  FROM ibinterval WHERE p_patientid IS NULL OR patientid = p_patientid),
step AS (
  SELECT c.patientid, c.t, c.glucosevalue, b.ibi, b.ibi - lag(b.ibi) OVER (PARTITION BY c.patientid, c.t ORDER BY b.date_time, b.ibi, c.glucosevalue) AS d
  FROM crash c JOIN beat b ON b.patientid = c.patientid AND b.slot = c.slot AND b.us - c.us BETWEEN 0 AND p_hours * 3600000000)
SELECT patientid, t, CAST(glucosevalue AS DOUBLE), CAST(ROUND(CAST(sqrt(AVG(d * d)) AS DECIMAL(38,12)), 3) AS DOUBLE),
       CAST(ROUND(CAST(stddev_samp(ibi) AS DECIMAL(38,12)), 3) AS DOUBLE),
       CAST(ROUND(CAST(try_divide(100.0 * count_if(abs(d) > 0.05), COUNT(d)) AS DECIMAL(38,12)), 2) AS DOUBLE)
FROM step GROUP BY patientid, t, glucosevalue
"""

_NUTRIENTS = {"total_carb": 60, "dietary_fiber": 25, "sugar": 30, "protein": 40, "total_fat": 20}

NUTRIENT_ALERTS = f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_nutrient_alerts()
RETURNS TABLE (patientid INT, hour_start TIMESTAMP_NTZ, total_carb DOUBLE, dietary_fiber DOUBLE, sugar DOUBLE, protein DOUBLE, total_fat DOUBLE,
               max_glucose DOUBLE, glucose_spike BOOLEAN)
RETURN
WITH r AS (SELECT patientid, {_HOUR} AS h, COUNT(*) AS n, MAX(glucosevalue) AS top FROM dexcom GROUP BY ALL),
f AS (SELECT patientid, {_HOUR.replace('date_time', 'time_begin')} AS h, {', '.join(f'SUM({c}) AS {c}' for c in _NUTRIENTS)} FROM foodlog GROUP BY ALL),
e AS (SELECT f.patientid, f.h, {', '.join(f'CAST(f.{c} * COALESCE(r.n, 1) AS DOUBLE) AS {c}' for c in _NUTRIENTS)}, r.top FROM f LEFT JOIN r ON r.patientid = f.patientid AND r.h = f.h)
SELECT patientid, h, {', '.join(_NUTRIENTS)}, CAST(top AS DOUBLE), COALESCE(top > 180, false) FROM e WHERE {' OR '.join(f'{c} > {v}' for c, v in _NUTRIENTS.items())}
"""

HOURLY_STRESS = f"""
CREATE OR REPLACE TEMPORARY FUNCTION summarize_hourly_glucose_hr()
RETURNS TABLE (patientid INT, day DATE, hour INT, avg_glucose DOUBLE, avg_hr DOUBLE, status STRING)
RETURN
WITH u AS (
  SELECT patientid, {_HOUR} AS h, CAST(glucosevalue AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS b, 1 AS is_g FROM dexcom
  UNION ALL SELECT patientid, {_HOUR}, NULL, CAST(hr AS DOUBLE), 0 FROM heartrate),
a AS (SELECT patientid, h, AVG(g) AS g, AVG(b) AS b FROM u GROUP BY patientid, h HAVING SUM(is_g) > 0)
SELECT patientid, to_date(h), hour(h), {_r2('g')}, {_r2('b')}, CASE WHEN g > 180 AND b > 100 THEN 'Stress Spike' ELSE 'Normal' END FROM a
"""


def register_sql(spark: SparkSession, tables) -> None:
    """Temp views for the seven sensor tables plus the SQL table functions."""
    for name in SENSORS:
        getattr(tables, name).createOrReplaceTempView(name)
    spark.sql(HOURLY_HR_GLUCOSE)
    for function in (PATIENT_VARIABILITY, HRV_AFTER_CRASH, NUTRIENT_ALERTS, HOURLY_STRESS):
        spark.sql(function)
