"""ETL catalogue (etl_*): raw text tables -> cleaned typed tables.

The raw inputs are derived from the driver tables: every sensor column as
text under its raw name, the all-NULL columns the reference drops, and
full-row copies of the rows whose reading falls in the first six seconds of
a minute (first six minutes of an hour for the food log), so every
duplicate check and delete has work to do.  The registered query is
``clean_table`` on that raw table; the oracle repeats the same cleaning in
DuckDB text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.plans.registry import query
from vitalis.sources import schemas
from vitalis.sources.etl import RECIPES, clean_table
from vitalis.sources.fixtures import sensor_tables

_TS = {"demography": None, "foodlog": "time_begin"}


def _raw_name(table: str, col: str) -> str:
    inv = {v: k for k, v in schemas.RAW_RENAMES.get(table, {}).items()}
    return inv.get(col, col)


def raw_table(t, table: str) -> DataFrame:
    """Driver data in the raw, all-text shape the cleaning starts from."""
    df: DataFrame = getattr(t, table)
    cols = [F.col(c).cast("string").alias(_raw_name(table, c)) for c in df.columns]
    cols += [F.lit(None).cast("string").alias(c) for c in schemas.RAW_DROPS.get(table, [])]
    raw = df.select(*cols)
    ts = _TS.get(table, "date_time")
    if ts is None:
        return raw
    src = F.col(_raw_name(table, ts)).cast("timestamp_ntz")
    dup_rule = (F.minute(src) < 6) if table == "foodlog" else (F.second(src) < 6)
    # a second copy of some rows, in the same scan
    return raw.withColumn("_copy", F.explode(F.when(dup_rule, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_copy")


# integer columns that can hold NULL in the cleaned tables
_NULLABLE_INTS = {"dexcom": ["transmittertime"]}


def _typed_out(df: DataFrame, table: str) -> DataFrame:
    # decimals and nullable integers leave as double: same values, one
    # representation across engines (the library's clean_table keeps the types)
    as_double = set(_NULLABLE_INTS.get(table, []))
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" or f.name in as_double else F.col(f.name)
                       for f in df.schema.fields])


def etl(table: str):
    def run(t):
        return _typed_out(clean_table(raw_table(t, table), table), table)

    run.__name__ = f"etl_{table}"
    return run


# ---------------------------------------------------------------- oracle text
def _sql_type(f) -> str:
    name = f.dataType.typeName()
    return {"integer": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}.get(name, "DECIMAL(18,4)")


def _sql_raw(table: str) -> str:
    typed = schemas.TYPED[table]
    cols = [f"CAST({f.name} AS VARCHAR) AS {_raw_name(table, f.name)}" for f in typed.fields]
    cols += [f"CAST(NULL AS VARCHAR) AS {c}" for c in schemas.RAW_DROPS.get(table, [])]
    base = f"SELECT {', '.join(cols)} FROM {table}"
    ts = _TS.get(table, "date_time")
    if ts is None:
        return base
    rts = _raw_name(table, ts)
    rule = f"minute(CAST({rts} AS TIMESTAMP)) < 6" if table == "foodlog" else f"second(CAST({rts} AS TIMESTAMP)) < 6"
    return f"{base} UNION ALL SELECT * FROM ({base}) WHERE {rule}"


def _sql_clean(table: str, dedup=None) -> str:
    typed = schemas.TYPED[table]
    ms = RECIPES[table].get("ms", [])
    exprs = []
    for f in typed.fields:
        src = _raw_name(table, f.name)
        e = f"CAST({src} AS {_sql_type(f)})"
        if f.name in ms:
            e = f"TIMESTAMP '1970-01-01' + to_microseconds(((epoch_us({e}) + 500) // 1000) * 1000)"
        if _sql_type(f).startswith("DECIMAL") or f.name in _NULLABLE_INTS.get(table, []):
            e = f"CAST({e} AS DOUBLE)"
        exprs.append(f"{e} AS {f.name}")
    typed_sql = f"SELECT {', '.join(exprs)} FROM raw_{table}"
    names = [f.name for f in typed.fields]
    keys = schemas.DEDUP_KEYS[table]
    others = [c for c in names if c not in keys]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in (others or keys))
    mode = dedup if dedup is not None else RECIPES[table]["dedup"]
    body = f", raw_{table} AS ({_sql_raw(table)}), typed AS ({typed_sql})"
    if mode is None:
        return body + f" SELECT {', '.join(names)} FROM typed"
    if mode == "all":
        body += f", ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn FROM typed)"
        return body + f" SELECT {', '.join(names)} FROM ranked WHERE rn = 1"
    # one pass: the place of a row in its key group, and its place among all surplus rows
    all_order = ", ".join(f"{c} ASC NULLS LAST" for c in [*keys, *others])
    body += f", placed AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn FROM typed)"
    body += f", surplus AS (SELECT *, row_number() OVER (PARTITION BY rn > 1 ORDER BY {all_order}, rn) AS nth FROM placed)"
    return body + f" SELECT {', '.join(names)} FROM surplus WHERE rn = 1 OR nth > {mode}"


for _table in ["demography", "dexcom", "eda", "foodlog", "heartrate", "ibinterval", "temperature"]:
    query(f"etl_{_table}", _sql_clean(_table))(etl(_table))


@query("etl_duplicate_report", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{tb}' AS table_name, COUNT(*) AS duplicate_groups FROM (SELECT 1 FROM ({_sql_raw(tb)}) "
    f"GROUP BY {', '.join(_raw_name(tb, k) for k in schemas.DEDUP_KEYS[tb])} HAVING COUNT(*) > 1)"
    for tb in ["demography", "dexcom", "eda", "foodlog", "heartrate", "ibinterval", "temperature"]
) + ")")
def etl_duplicate_report(t):
    """O7 over every raw table: the number of duplicate key groups per table
    (the reference's duplicate probes, as one report)."""
    from vitalis.sources.etl import find_duplicates

    parts = []
    for tb in ["demography", "dexcom", "eda", "foodlog", "heartrate", "ibinterval", "temperature"]:
        raw = raw_table(t, tb)
        keys = [_raw_name(tb, k) for k in schemas.DEDUP_KEYS[tb]]
        parts.append(find_duplicates(raw, keys).agg(F.count(F.lit(1)).alias("duplicate_groups")).select(
            F.lit(tb).alias("table_name"), "duplicate_groups"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_FACTS = ["dexcom", "eda", "foodlog", "heartrate", "ibinterval", "temperature"]


@query("etl_integrity_report", "SELECT * FROM ("
       "SELECT 'demography' AS table_name, 'duplicate_keys' AS rule, COUNT(*) AS violations FROM "
       "(SELECT patientid FROM demography GROUP BY patientid HAVING COUNT(*) > 1) "
       "UNION ALL SELECT 'demography', 'null_keys', COUNT(*) FROM demography WHERE patientid IS NULL "
       + " ".join(f"UNION ALL SELECT '{tb}', 'missing_demography', COUNT(*) FROM {tb} f WHERE f.patientid IS NOT NULL "
                  f"AND NOT EXISTS (SELECT 1 FROM demography d WHERE d.patientid = f.patientid)" for tb in _FACTS)
       + ")")
def etl_integrity_report(t):
    """O9 + O10: the schema's primary- and foreign-key rules as one report."""
    from vitalis.sources.etl import integrity_report

    return integrity_report({"demography": t.demography, **{tb: getattr(t, tb) for tb in _FACTS}})


__all__ = ["raw_table", "etl", "sensor_tables"]
