"""Query catalogue: one key per numbered analysis, each with its DuckDB oracle text.

A query function takes a tables object (attributes ``demography``, ``dexcom``,
``heartrate``, ``eda``, ``ibinterval``, ``temperature``, ``foodlog``) and returns
a lazy DataFrame.  ``sensor_tables(spark, sf_dir)`` gives such an object for the
driver data; users pass their own cleaned tables the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vitalis.sources.fixtures import oracle, sensor_tables


@dataclass
class Entry:
    key: str
    fn: Callable
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | None = None, recursive: bool = False):
    def deco(fn):
        text = oracle(sql, recursive=recursive) if sql is not None else None
        REGISTRY[key] = Entry(key, fn, text)
        return fn

    return deco


def _load_all():
    # importing registers the catalogue
    from vitalis.plans import advanced, beginner, cleaning, intermediate, published, variants  # noqa: F401


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    _load_all()
    return REGISTRY[key].fn(sensor_tables(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: (lambda spark, sf_dir, _k=k: run(_k, spark, sf_dir)) for k in sorted(REGISTRY)}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: e.sql for k, e in sorted(REGISTRY.items()) if e.sql is not None}
