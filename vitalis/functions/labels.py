"""Threshold labels (searched CASE built from a rule list).

A rule is ``(label, predicate)``; the first rule whose predicate is true wins,
otherwise ``else_``.  A NULL input fails every comparison and falls to
``else_``, exactly like a CASE without a NULL branch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Callable[[Column], Column]]


def label_bands(col, rules: Sequence[Rule], else_: str | None) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for label, pred in rules:
        out = F.when(pred(c), F.lit(label)) if out is None else out.when(pred(c), F.lit(label))
    return out.otherwise(F.lit(else_)) if out is not None else F.lit(else_)


def label_values(col, mapping: Sequence[tuple[object, str]], else_: str | None) -> Column:
    """Simple CASE: ``CASE expr WHEN v1 THEN l1 ... ELSE e END``."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for value, label in mapping:
        out = F.when(c == F.lit(value), F.lit(label)) if out is None else out.when(c == F.lit(value), F.lit(label))
    return out.otherwise(F.lit(else_))


def contains_any(col, words: Sequence[str]) -> Column:
    """``lower(col) LIKE '%w1%' OR ...`` - substring test, case-insensitive."""
    c = F.lower(F.col(col) if isinstance(col, str) else col)
    out = None
    for w in words:
        t = c.contains(w.lower())
        out = t if out is None else (out | t)
    return out


def between(lo, hi) -> Callable[[Column], Column]:
    return lambda c: c.between(lo, hi)


def lt(v) -> Callable[[Column], Column]:
    return lambda c: c < v


def le(v) -> Callable[[Column], Column]:
    return lambda c: c <= v


def gt(v) -> Callable[[Column], Column]:
    return lambda c: c > v


def ge(v) -> Callable[[Column], Column]:
    return lambda c: c >= v


# The reference's clinical and category thresholds (defaults).
HBA1C_BANDS_B01: list[Rule] = [("Normal", lt(5.7)), ("Prediabetic", between(5.7, 6.4)), ("Diabetic", ge(6.5))]
HBA1C_BANDS_I22: list[Rule] = [("Non-diabetic", lt(5.7)), ("Pre-diabetic", lambda c: (c >= 5.7) & (c < 6.5))]
CALORIE_BANDS: list[Rule] = [("Low Calorie", lt(200)), ("Moderate Calorie", between(200, 500)), ("High Calorie", gt(500))]
DAY_PERIODS: list[Rule] = [("Morning", between(6, 11)), ("Afternoon", between(12, 17)), ("Evening", between(18, 23))]
FEVER_BANDS: list[Rule] = [("Normal", lt(37.5)), ("Low-grade", lt(38))]
GLUCOSE_AVG_RANGE_I08: list[Rule] = [("Hypoglycemia", lt(70)), ("Normal", between(70, 140))]
GLUCOSE_RANGE_A06: list[Rule] = [("Low", lt(70)), ("Normal", between(70, 140))]
GLUCOSE_ZONES: list[Rule] = [("Hypo", lt(70)), ("Normal", between(70, 180))]
HR_STATUS_I11: list[Rule] = [("bradycardia", lt(60)), ("normal", between(60, 100))]
VARIABILITY_BANDS: list[Rule] = [("Low", lt(20)), ("Medium", le(40))]
QUARTILE_LABELS = [(1, "Low"), (2, "Med-Low"), (3, "Med-High")]
SNACK_WORDS = ["chip", "cookie", "cake"]
FRUIT_WORDS = ["apple", "banana", "orange"]
HIGH_RISK_FOODS = ["cake", "soda", "white rice", "ice cream", "sweet", "pastry", "milkshake", "chocolate", "donut"]
