"""Pivots (crosstab with fixed categories), grouping sets, and the one-scan
multi-sensor bin that replaces UNION ALL / FULL JOIN of per-sensor aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.functions.time import trunc


def pivot_fixed(
    df: DataFrame, row_key: Sequence[str] | str, category: str, value: str, categories: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """O53 ``crosstab(source, VALUES (...))``: one row per ``row_key``, one
    column per listed category (NULL where absent).  Listing the values keeps
    absent categories as columns and saves Spark the distinct-values job."""
    keys = [row_key] if isinstance(row_key, str) else list(row_key)
    p = df.groupBy(*keys).pivot(category, list(categories)).agg(F.first(value))
    if names:
        for c, n in zip(categories, names):
            p = p.withColumnRenamed(c, n)
    return p


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], cols: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """O51 ``GROUP BY GROUPING SETS (...)`` - one Expand + one aggregation."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(*aggs)


def multi_sensor_bins(
    sensors: Mapping[str, tuple[DataFrame, str]],
    key: str,
    ts: str,
    grain: str,
    stats: Mapping[str, Sequence[tuple[str, str]]],
    bin_name: str = "hour",
) -> DataFrame:
    """Bin several sensors at once.

    ``sensors`` maps a tag to (DataFrame, value column).  All are projected to
    (key, bin, tag, value), unioned and aggregated in ONE groupBy, with one
    conditional aggregate per (tag, stat).  Compared with one aggregate per
    sensor followed by joins on (key, bin), this is one shuffle of partial
    aggregates instead of N shuffles plus N-1 joins; an absent sensor gives
    NULLs exactly like the outer join would.  ``stats[tag]`` lists
    (function name, output name) with function in avg / stddev_pop /
    stddev_samp / max / min / count (non-NULL values) / sum / rows (all rows
    of that sensor, NULL values included).
    """
    parts = []
    for tag, (df, val) in sensors.items():
        parts.append(df.select(F.col(key), trunc(ts, grain).alias(bin_name), F.lit(tag).alias("_tag"), F.col(val).cast("double").alias("_v")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    fns = {"avg": F.avg, "stddev_pop": F.stddev_pop, "stddev_samp": F.stddev_samp, "max": F.max, "min": F.min,
           "count": F.count, "sum": F.sum}
    aggs = []
    for tag, lst in stats.items():
        v = F.when(F.col("_tag") == tag, F.col("_v"))
        for fn, name in lst:
            if fn == "rows":
                aggs.append(F.count(F.when(F.col("_tag") == tag, F.lit(1))).alias(name))
            else:
                aggs.append(fns[fn](v).alias(name))
    # presence flag per tag so callers can reproduce LEFT/INNER join semantics
    for tag in sensors:
        aggs.append(F.max(F.when(F.col("_tag") == tag, F.lit(True))).alias(f"_has_{tag}"))
    return u.groupBy(key, bin_name).agg(*aggs)
