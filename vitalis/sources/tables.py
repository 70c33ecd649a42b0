"""Table plumbing the scripts use between statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def append_rows(spark: SparkSession, table: DataFrame, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """O11 ``INSERT INTO t (cols) VALUES ...``: the listed columns get the
    values, every other column NULL; result has ``table``'s schema."""
    schema = T.StructType([table.schema[c] for c in columns])
    new = spark.createDataFrame(list(rows), schema)
    return table.unionByName(new, allowMissingColumns=True)


def insert_by_position(source: DataFrame, target_schema: T.StructType) -> DataFrame:
    """O12 ``INSERT INTO target SELECT * FROM source``: columns matched by
    position, cast to the target's types and names."""
    if len(source.columns) != len(target_schema.fields):
        raise ValueError("column count differs between source and target")
    return source.select(*[source[c].cast(f.dataType).alias(f.name) for c, f in zip(source.columns, target_schema.fields)])


def temp_table(df: DataFrame, name: str, persist: bool = True) -> DataFrame:
    """O15 ``CREATE TEMP TABLE name AS ...``: a session-scoped view, persisted
    when it feeds several later statements (recomputed from lineage if an
    executor is lost)."""
    out = df.persist() if persist else df
    out.createOrReplaceTempView(name)
    return out
