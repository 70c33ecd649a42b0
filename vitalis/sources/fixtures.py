"""Driver tables -> the seven sensor tables.

The test data is a TPC-H-like star schema plus an ``events`` stream.  This
module is the only place that knows those names; it derives the sensor tables
(demography, dexcom, heartrate, eda, ibinterval, temperature, foodlog) with
one deterministic mapping, written twice: as Spark DataFrames and as DuckDB
CTE text for the oracle.  Sensors share event types on purpose, so that
minute-equal joins between two sensors are not empty.

Everything is lazy: a query that uses two sensors only scans what those two
need, and the column pruning / filter pushdown reaches the parquet scans.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.sources import schemas

# Which event types feed which sensor (overlapping on purpose).
SENSOR_EVENT_TYPES = {
    "dexcom": ["view", "click", "error"],
    "heartrate": ["click", "purchase", "signup"],
    "eda": ["error", "purchase", "click"],
    "ibinterval": ["error", "view", "purchase"],
    "temperature": ["signup", "view"],
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """O1: scan of a base table (parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class SensorTables:
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def base(self, name: str) -> DataFrame:
        return self._get("base:" + name, lambda: read_table(self.spark, self.sf_dir, name))

    def _events(self, kind: str) -> DataFrame:
        return self.base("events").where(F.col("event_type").isin(SENSOR_EVENT_TYPES[kind]))

    @property
    def demography(self) -> DataFrame:
        def build():
            return self.base("customer").select(
                F.col("c_custkey").cast("int").alias("patientid"),
                F.when(F.col("c_custkey") % 2 == 0, F.lit("FEMALE")).otherwise(F.lit("MALE")).alias("gender"),
                (F.lit(5.0) + (F.col("c_custkey") % 20) * F.lit(0.1)).cast("decimal(18,4)").alias("hba1c"),
            )

        return self._get("demography", build)

    @property
    def dexcom(self) -> DataFrame:
        def build():
            e = self._events("dexcom")
            return e.select(
                F.col("event_id").cast("int").alias("indexval"),
                F.col("user_id").cast("int").alias("patientid"),
                F.col("ts").alias("date_time"),
                F.col("event_type").alias("eventtype"),
                F.concat(F.lit("dev"), (F.col("user_id") % 7).cast("string")).alias("sourcedeviceid"),
                (F.lit(60) + F.floor("value").cast("int")).alias("glucosevalue"),
                F.lit(None).cast("string").alias("duration"),
                F.when(F.col("event_id") % 11 == 0, F.lit(None))
                .otherwise(F.col("event_id") % 5000)
                .cast("int")
                .alias("transmittertime"),
            )

        return self._get("dexcom", build)

    def _signal(self, kind: str, value_name: str, expr) -> DataFrame:
        e = self._events(kind)
        return e.select(
            F.col("user_id").cast("int").alias("patientid"),
            F.col("ts").alias("date_time"),
            expr.cast("double").alias(value_name),
        )

    @property
    def heartrate(self) -> DataFrame:
        return self._get(
            "heartrate",
            lambda: self._signal(
                "heartrate", "hr", F.lit(50.0) + ((F.col("event_id") * 7919) % 1000).cast("double") / 10
            ),
        )

    @property
    def eda(self) -> DataFrame:
        return self._get(
            "eda",
            lambda: self._signal("eda", "eda", ((F.col("event_id") * 104729) % 100).cast("double") / 100),
        )

    @property
    def ibinterval(self) -> DataFrame:
        return self._get(
            "ibinterval",
            lambda: self._signal(
                "ibinterval", "ibi", F.lit(0.6) + ((F.col("event_id") * 15485863) % 500).cast("double") / 1000
            ),
        )

    @property
    def temperature(self) -> DataFrame:
        return self._get(
            "temperature",
            lambda: self._signal(
                "temperature",
                "temperature",
                F.lit(36.0) + ((F.col("event_id") * 611953) % 300).cast("double") / 100,
            ),
        )

    @property
    def foodlog(self) -> DataFrame:
        def build():
            li = self.base("lineitem").select(
                "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus",
            )
            o = self.base("orders").select("o_orderkey", "o_custkey")
            p = self.base("part").select("p_partkey", "p_name", "p_type")
            j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
            start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
                (F.col("o_orderkey") % 30).cast("int"),
                F.lit(0),
                ((F.col("o_orderkey") * 37) % 1440).cast("int"),
                F.lit(0),
            )
            j = j.withColumn("time_begin", start)
            dec = "decimal(18,4)"
            return j.select(
                "time_begin",
                F.date_format(
                    F.col("time_begin") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber") * 10, F.lit(0)),
                    "HH:mm:ss",
                ).alias("time_end"),
                F.col("p_name").alias("logged_food"),
                F.col("l_quantity").cast("string").alias("quantity"),
                F.col("l_linestatus").alias("unit"),
                F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
                .when(F.col("l_returnflag") == "A", F.col("p_name"))
                .otherwise(F.concat(F.col("p_type"), F.lit(" "), F.col("p_name")))
                .alias("searched_food"),
                (F.col("l_quantity") * 10).cast(dec).alias("calorie"),
                F.col("l_quantity").cast(dec).alias("total_carb"),
                (F.col("l_linenumber") * 2).cast(dec).alias("dietary_fiber"),
                (F.col("l_discount") * 300).cast(dec).alias("sugar"),
                (F.col("l_tax") * 500).cast(dec).alias("protein"),
                (F.col("l_quantity") / 2).cast(dec).alias("total_fat"),
                F.col("o_custkey").cast("int").alias("patientid"),
            )

        return self._get("foodlog", build)


def sensor_tables(spark: SparkSession, sf_dir: str) -> SensorTables:
    """The sensor views over one data folder, as its files are now."""
    return SensorTables(spark, sf_dir)


# --------------------------------------------------------------------------
# The same mapping as DuckDB CTEs (used by the oracle SQL).
# --------------------------------------------------------------------------

def _types(kind):
    return ", ".join(f"'{t}'" for t in SENSOR_EVENT_TYPES[kind])


SENSOR_CTES_SQL = f"""
demography AS (
  SELECT CAST(c_custkey AS INTEGER) AS patientid,
         CASE WHEN c_custkey % 2 = 0 THEN 'FEMALE' ELSE 'MALE' END AS gender,
         CAST(5.0 + (c_custkey % 20) * 0.1 AS DECIMAL(18,4)) AS hba1c
  FROM customer
),
dexcom AS (
  SELECT CAST(event_id AS INTEGER) AS indexval, CAST(user_id AS INTEGER) AS patientid,
         CAST(ts AS TIMESTAMP) AS date_time, event_type AS eventtype,
         'dev' || CAST(user_id % 7 AS VARCHAR) AS sourcedeviceid,
         60 + CAST(floor(value) AS INTEGER) AS glucosevalue,
         CAST(NULL AS VARCHAR) AS duration,
         CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 5000 END AS INTEGER) AS transmittertime
  FROM events WHERE event_type IN ({_types('dexcom')})
),
heartrate AS (
  SELECT CAST(user_id AS INTEGER) AS patientid, CAST(ts AS TIMESTAMP) AS date_time,
         50 + CAST((event_id * 7919) % 1000 AS DOUBLE) / 10 AS hr
  FROM events WHERE event_type IN ({_types('heartrate')})
),
eda AS (
  SELECT CAST(user_id AS INTEGER) AS patientid, CAST(ts AS TIMESTAMP) AS date_time,
         CAST((event_id * 104729) % 100 AS DOUBLE) / 100 AS eda
  FROM events WHERE event_type IN ({_types('eda')})
),
ibinterval AS (
  SELECT CAST(user_id AS INTEGER) AS patientid, CAST(ts AS TIMESTAMP) AS date_time,
         CAST(0.6 AS DOUBLE) + CAST((event_id * 15485863) % 500 AS DOUBLE) / 1000 AS ibi
  FROM events WHERE event_type IN ({_types('ibinterval')})
),
temperature AS (
  SELECT CAST(user_id AS INTEGER) AS patientid, CAST(ts AS TIMESTAMP) AS date_time,
         36 + CAST((event_id * 611953) % 300 AS DOUBLE) / 100 AS temperature
  FROM events WHERE event_type IN ({_types('temperature')})
),
foodlog_src AS (
  SELECT l.*, o.o_custkey, p.p_name, p.p_type,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o.o_orderkey % 30 AS INTEGER))
           + to_minutes(CAST((o.o_orderkey * 37) % 1440 AS BIGINT)) AS tb
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
),
foodlog AS (
  SELECT tb AS time_begin,
         strftime(tb + to_minutes(CAST(l_linenumber * 10 AS BIGINT)), '%H:%M:%S') AS time_end,
         p_name AS logged_food, CAST(l_quantity AS VARCHAR) AS quantity, l_linestatus AS unit,
         CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' THEN p_name
              ELSE p_type || ' ' || p_name END AS searched_food,
         CAST(l_quantity * 10 AS DECIMAL(18,4)) AS calorie,
         CAST(l_quantity AS DECIMAL(18,4)) AS total_carb,
         CAST(l_linenumber * 2 AS DECIMAL(18,4)) AS dietary_fiber,
         CAST(l_discount * 300 AS DECIMAL(18,4)) AS sugar,
         CAST(l_tax * 500 AS DECIMAL(18,4)) AS protein,
         CAST(l_quantity / 2 AS DECIMAL(18,4)) AS total_fat,
         CAST(o_custkey AS INTEGER) AS patientid
  FROM foodlog_src
)
"""


def oracle(body: str, recursive: bool = False) -> str:
    """Prefix ``body`` with the sensor CTEs.

    ``body`` either starts with ``SELECT`` or continues the CTE list with
    ``, name AS (...) SELECT ...``.
    """
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} {SENSOR_CTES_SQL.strip()}\n{body.strip()}"


__all__ = ["SensorTables", "sensor_tables", "read_table", "oracle", "SENSOR_CTES_SQL", "schemas"]
