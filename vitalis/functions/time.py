"""Time-bin and time-difference expressions.

All sensor times are ``timestamp_ntz`` (wall clock, no zone), like the
reference's ``timestamp without time zone``.  Spark's ``date_trunc`` returns a
zoned ``timestamp`` for an NTZ input, so the bins below are built from
calendar fields instead; they are exact in every session time zone and stay
inside whole-stage codegen.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trunc_minute(ts) -> Column:
    ts = _c(ts)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.lit(0))


def trunc_hour(ts) -> Column:
    ts = _c(ts)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))


def trunc_day(ts) -> Column:
    """``date_trunc('day', ts)`` as a timestamp."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def to_day(ts) -> Column:
    """``ts::date`` / ``DATE(ts)``."""
    return F.to_date(_c(ts))


def trunc_week(ts) -> Column:
    """ISO week start (Monday 00:00), as ``date_trunc('week', ts)``."""
    ts = _c(ts)
    return F.date_sub(F.to_date(ts), F.weekday(ts)).cast("timestamp_ntz")


def trunc(ts, grain: str) -> Column:
    return {"minute": trunc_minute, "hour": trunc_hour, "day": trunc_day, "week": trunc_week}[grain](ts)


def micros_between(start, end) -> Column:
    """``end - start`` in microseconds (long); works on NTZ without a zone."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def seconds_between(start, end) -> Column:
    """``EXTRACT(EPOCH FROM end - start)`` as double seconds."""
    return micros_between(start, end) / F.lit(1_000_000.0)


def shift(ts, minutes: int = 0, hours: int = 0, days: int = 0) -> Column:
    """``ts + interval``; negative values shift back."""
    return _c(ts) + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(0))


def shift_hours(ts, hours) -> Column:
    """``ts + interval '1 hour' * n`` where n may be a column."""
    n = hours if isinstance(hours, Column) else F.lit(hours)
    return _c(ts) + F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0))


def time_of_day(ts) -> Column:
    """``ts::time`` rendered as ``HH:mm:ss`` (Spark's TIME type is off by default)."""
    return F.date_format(_c(ts), "HH:mm:ss")


def hour_of_time_text(t) -> Column:
    """``EXTRACT(HOUR FROM time_col)`` for a ``HH:mm:ss`` text column."""
    return F.substring(_c(t), 1, 2).cast("int")


def from_epoch_micros(us) -> Column:
    """Inverse of ``micros_between(epoch, ts)``: a zone-free NTZ timestamp."""
    return _epoch() + F.lit(timedelta(microseconds=1)) * _c(us)


def round_ms(ts) -> Column:
    """``::timestamp(3)``: round (not truncate) to milliseconds, half up as PostgreSQL."""
    micros = micros_between(_epoch(), _c(ts))
    return from_epoch_micros(F.floor((micros + F.lit(500)) / F.lit(1000)) * F.lit(1000))
