"""Numeric helpers: PostgreSQL-style rounding, NULL-safe correlation, CV, HRV terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(col, digits: int) -> Column:
    """``ROUND(x::numeric, n)`` returned as double.

    The value goes through an exact decimal first, so ties round away from
    zero on the decimal digits a user sees (``1.005 -> 1.01``), as PostgreSQL
    does for numeric; rounding the raw binary double would give 1.00.
    """
    return F.round(_c(col).cast("decimal(38,12)"), digits).cast("double")


def as_double(col) -> Column:
    return _c(col).cast("double")


def safe_corr(x, y) -> Column:
    """Pearson correlation that is NULL (not an error) for a constant series.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI when one side has zero
    variance; PostgreSQL returns NULL.  One pass, partial-aggregate friendly.
    """
    x, y = _c(x).cast("double"), _c(y).cast("double")
    pair = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(pair, x), F.when(pair, y)
    cov = F.covar_pop(xx, yy)
    den = F.stddev_pop(xx) * F.stddev_pop(yy)
    return F.try_divide(cov, F.when(den > 0, den))


def safe_corr_window(x, y, window) -> Column:
    """``CORR(x, y) OVER (PARTITION BY ...)`` with the same NULL rule."""
    x, y = _c(x).cast("double"), _c(y).cast("double")
    pair = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(pair, x), F.when(pair, y)
    cov = F.covar_pop(xx, yy).over(window)
    den = (F.stddev_pop(xx).over(window)) * (F.stddev_pop(yy).over(window))
    return F.try_divide(cov, F.when(den > 0, den))


def coefficient_of_variation(col) -> Column:
    """``stddev_samp / avg``; NULL when the mean is 0 (``try_divide``)."""
    return F.try_divide(F.stddev_samp(_c(col)), F.avg(_c(col)))


def pct(numerator: Column, denominator: Column) -> Column:
    """``100.0 * a / b`` in double; NULL when b is 0."""
    return F.try_divide(F.lit(100.0) * numerator.cast("double"), denominator.cast("double"))


def count_if(cond: Column) -> Column:
    """``COUNT(*) FILTER (WHERE cond)``; NULL conditions do not count."""
    return F.count(F.when(cond, F.lit(1)))
