"""Cleaning jobs: staging -> drop -> rename -> typed cast -> key checks ->
duplicate report -> deduplicate -> publish (O2-O10, ``clean_table``).

Each step is a DataFrame -> DataFrame function, so one table's cleaning is a
single lazy plan that Spark runs in one pass and writes once.  Checks return
report DataFrames instead of raising, so a pipeline can decide what to do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.functions.time import round_ms
from vitalis.operators.chains import repeated
from vitalis.sources import schemas


def stage(raw: DataFrame, cache: bool = False) -> DataFrame:
    """O2: staging copy.  Lazy by default; ``cache=True`` persists it when
    several checks read the same staged data."""
    return raw.persist() if cache else raw


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O3."""
    return df.drop(*[c for c in cols if c in df.columns])


def find_all_null_columns(df: DataFrame) -> list[str]:
    """Columns whose every value is NULL - one aggregation pass, one row back."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if counts[c] == 0]


def all_null_columns(df: DataFrame) -> DataFrame:
    """O4 as rows (column_name): one aggregation, unpivoted; an empty table has all its columns."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])  # values of each column
    return counts.unpivot([], list(df.columns), "column_name", "n").where("n = 0").select("column_name")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """O5."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def _cast_one(col: Column, dtype: T.DataType, strict: bool, ms: bool) -> Column:
    if isinstance(dtype, T.TimestampNTZType):
        c = col.cast(dtype) if strict else F.try_to_timestamp(col).cast(dtype)
        return round_ms(c) if ms else c
    return col.cast(dtype) if strict else col.try_cast(dtype)


def cast_schema(
    df: DataFrame, schema: T.StructType, on_error: str = "fail", ms_columns: Sequence[str] = ()
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """``ALTER COLUMN ... TYPE t USING col::t`` for every column of ``schema``.

    ``on_error``: ``fail`` - ANSI cast, bad text raises (PostgreSQL's
    behaviour); ``null`` - ``try_cast``, bad text becomes NULL; ``quarantine``
    - returns (good, bad), bad = rows where a non-NULL text did not parse.
    Columns in ``ms_columns`` are rounded to milliseconds (``timestamp(3)``).
    """
    strict = on_error == "fail"
    typed = [
        _cast_one(F.col(f.name), f.dataType, strict, f.name in ms_columns).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    if on_error != "quarantine":
        return df.select(*typed)
    flags = [
        (F.col(f.name).isNotNull() & _cast_one(F.col(f.name), f.dataType, False, False).isNull())
        for f in schema.fields
        if f.name in df.columns
    ]
    bad_any = flags[0]
    for x in flags[1:]:
        bad_any = bad_any | x
    marked = df.withColumn("_bad", bad_any)
    good = marked.where(~F.col("_bad")).drop("_bad").select(*typed)
    bad = marked.where(F.col("_bad")).drop("_bad")
    return good, bad


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def deduplicate(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Keep one row per key group.

    Without ``limit``: every row with ``row_number > 1`` goes.  When the key
    is the whole row this is ``dropDuplicates`` (partial aggregation, no
    sort).  Otherwise the kept row is the first in the order of all columns
    (the reference leaves it open).  ``limit=k`` reproduces ``DELETE ...
    WHERE ctid IN (SELECT ... WHERE row_num > 1 LIMIT k)``: only the first k
    surplus rows, in (key, all columns) order, are removed.
    """
    others = [c for c in df.columns if c not in keys]
    if limit is None and not others:
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in others or keys])
    if limit is None:
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return _without_first_surplus(df, list(keys), others, limit)


def _without_first_surplus(df: DataFrame, keys: list[str], others: list[str], limit: int) -> DataFrame:
    """Equal rows are one row with a count first (added up before the shuffle, so copies are no hot group); the count of what
    precedes a row in its key group tells how many of its copies are surplus.  The first ``limit`` of these are at most
    ``limit`` rows, a bounded broadcast, whose counts are lowered; then every row stands as often as its count."""
    def nulls_last(cols: Sequence[str]) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in cols]

    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*keys).orderBy(*nulls_last(others or keys)).rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_surplus", F.col("_n") - F.when(F.sum("_n").over(ahead).isNull(), 1).otherwise(0))
    first = counted.where(F.col("_surplus") > 0).orderBy(*nulls_last([*keys, *others])).limit(limit)
    before = F.coalesce(F.sum("_surplus").over(Window.orderBy(*nulls_last([*keys, *others])).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = first.withColumn("_gone", F.greatest(F.lit(0), F.least(F.col("_surplus"), F.lit(limit) - before)))
    doomed = F.broadcast(first.select(*(F.col(c).alias(f"_k_{c}") for c in df.columns), "_gone"))  # limit rows at most
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in df.columns]
    left = counted.join(doomed, same, "left").withColumn("_n", F.col("_n") - F.coalesce("_gone", F.lit(0)))
    return repeated(left.where(F.col("_n") > 0).select(*df.columns, "_n"), "_n")


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary-key rule as data: one row (duplicate_groups, null_keys),
    from one grouping by the key (NULL keys form their own group)."""
    null_any = None
    for k in key:
        x = F.col(k).isNull()
        null_any = x if null_any is None else (null_any | x)
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(
        F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(null_any, F.col("_n"))), F.lit(0)).cast("long").alias("null_keys"),
    )


def check_references(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Foreign-key rule as data: rows whose key is not in ``dim``."""
    return df.where(F.col(key).isNotNull()).join(dim.select(key).distinct(), key, "left_anti")


# Per-table cleaning recipe of the reference.
RECIPES = {
    "demography": {"dedup": None},
    "dexcom": {"dedup": None},
    "eda": {"dedup": None, "ms": ["date_time"]},
    "foodlog": {"dedup": 1},  # deletes exactly one surplus row, as written
    "heartrate": {"dedup": "all"},
    "ibinterval": {"dedup": None},
    "temperature": {"dedup": "all", "ms": ["date_time"]},
}


def clean_table(raw: DataFrame, name: str, on_error: str = "fail", dedup=None) -> DataFrame | tuple[DataFrame, DataFrame]:
    """The whole cleaning of one raw table as one lazy plan.  ``dedup``
    overrides the recipe: "all", an int limit, or False for none.  With
    ``on_error="quarantine"`` the result is (clean, bad): bad rows as staged."""
    r = dict(RECIPES[name])
    if dedup is not None:
        r["dedup"] = None if dedup is False else dedup
    df = stage(raw)
    df = drop_columns(df, schemas.RAW_DROPS.get(name, []))
    df = rename(df, schemas.RAW_RENAMES.get(name, {}))
    df = cast_schema(df, schemas.TYPED[name], on_error, r.get("ms", []))
    df, bad = df if on_error == "quarantine" else (df, None)
    keys = schemas.DEDUP_KEYS[name]
    if r["dedup"] == "all":
        df = deduplicate(df, keys)
    elif isinstance(r["dedup"], int):
        df = deduplicate(df, keys, limit=r["dedup"])
    return df if bad is None else (df, bad)


def publish(df: DataFrame, path: str, sort_within: Sequence[str] = ("patientid", "date_time", "time_begin")) -> None:
    """Final table: Parquet sorted within files by (patient, time), so row-group
    min/max statistics skip most of the file for a patient or time filter
    (the role the reference's composite index plays)."""
    cols = [c for c in sort_within if c in df.columns]
    # range partitioning on (patient, time) splits a heavy patient over many files
    out = df.repartitionByRange(*cols).sortWithinPartitions(*cols) if cols else df
    out.write.mode("overwrite").parquet(path)


def clean_all(raw: Mapping[str, DataFrame], on_error: str = "fail") -> dict:
    """Every raw table through its recipe; lazy, one plan per table."""
    return {name: clean_table(df, name, on_error) for name, df in raw.items()}


def integrity_report(tables: Mapping[str, DataFrame], dim: str = "demography", key: str = "patientid") -> DataFrame:
    """PK / FK rules of the schema as one report: for the dimension, duplicate
    key groups and NULL keys; for every fact table, rows whose key has no
    dimension row.  One row per (table, rule); all counts come from
    distributed aggregations."""
    d = tables[dim]
    u = check_unique(d, [key])
    parts = [
        u.select(F.lit(dim).alias("table_name"), F.lit("duplicate_keys").alias("rule"), F.col("duplicate_groups").alias("violations")),
        u.select(F.lit(dim).alias("table_name"), F.lit("null_keys").alias("rule"), F.col("null_keys").alias("violations")),
    ]
    for name, df in tables.items():
        if name == dim:
            continue
        orphans = check_references(df.select(key), d, key).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(orphans.select(F.lit(name).alias("table_name"), F.lit("missing_" + dim).alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
