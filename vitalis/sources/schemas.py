"""Typed schemas of the cleaned sensor tables and their raw (all-text) staging form."""

from __future__ import annotations

from pyspark.sql import types as T

DEC = T.DecimalType(18, 4)

DEMOGRAPHY = T.StructType([
    T.StructField("patientid", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("hba1c", DEC),
])

DEXCOM = T.StructType([
    T.StructField("indexval", T.IntegerType()),
    T.StructField("patientid", T.IntegerType()),
    T.StructField("date_time", T.TimestampNTZType()),
    T.StructField("eventtype", T.StringType()),
    T.StructField("sourcedeviceid", T.StringType()),
    T.StructField("glucosevalue", T.IntegerType()),
    T.StructField("duration", T.StringType()),
    T.StructField("transmittertime", T.IntegerType()),
])

FOODLOG = T.StructType(
    [
        T.StructField("time_begin", T.TimestampNTZType()),
        T.StructField("time_end", T.StringType()),
        T.StructField("logged_food", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("searched_food", T.StringType()),
    ]
    + [T.StructField(n, DEC) for n in ["calorie", "total_carb", "dietary_fiber", "sugar", "protein", "total_fat"]]
    + [T.StructField("patientid", T.IntegerType())]
)


def signal(value: str) -> T.StructType:
    return T.StructType([
        T.StructField("patientid", T.IntegerType()),
        T.StructField("date_time", T.TimestampNTZType()),
        T.StructField(value, T.DoubleType()),
    ])


HEARTRATE = signal("hr")
EDA = signal("eda")
IBINTERVAL = signal("ibi")
TEMPERATURE = signal("temperature")

TYPED = {
    "demography": DEMOGRAPHY,
    "dexcom": DEXCOM,
    "foodlog": FOODLOG,
    "heartrate": HEARTRATE,
    "eda": EDA,
    "ibinterval": IBINTERVAL,
    "temperature": TEMPERATURE,
}

# Raw column names -> cleaned names, and the columns the cleaning drops.
RAW_RENAMES = {
    "demography": {},
    "dexcom": {"timeof": "date_time", "glucosevaluemgdl": "glucosevalue", "transmittertimelonginteger": "transmittertime"},
    "eda": {"timeof": "date_time"},
    "foodlog": {"amount": "quantity"},
    "heartrate": {"timeof": "date_time"},
    "ibinterval": {"timeof": "date_time"},
    "temperature": {"timeof": "date_time", "temparature": "temperature"},
}
RAW_DROPS = {
    "dexcom": ["patientinfo", "deviceinfo", "insulinvalue_u", "carbvaluegrams", "glucoserateofchangemgdlmin"],
    "foodlog": ["dateof", "timeof", "time_of_day"],
}
# Duplicate keys checked (and removed) per table.
DEDUP_KEYS = {
    "demography": ["patientid"],
    "dexcom": ["patientid", "date_time"],
    "eda": ["date_time", "eda", "patientid"],
    "foodlog": ["patientid", "time_begin", "logged_food"],
    "heartrate": ["patientid", "date_time", "hr"],
    "ibinterval": ["patientid", "date_time", "ibi"],
    "temperature": ["patientid", "date_time", "temperature"],
}
# Timestamp precision after cleaning (None = microseconds kept).
TS_PRECISION_MS = {"eda": True, "temperature": True}
