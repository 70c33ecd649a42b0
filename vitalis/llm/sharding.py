"""Sharding by sampled splitters: shards of near-equal bytes, contiguous in a key order.

Records are ordered by the hash of their text and then their id, so equal texts lie side by side and are cut only where a
shard is full.  The order is never sorted as a whole:

1. Each record is drawn into the sample with a chance in proportion to its size (a hash of the record decides, so a
   second run draws the same); the sample is bounded, about ``shards * OVERSAMPLE`` keys.
2. Sample quantiles cut the key space into ``shards * RANGES`` ranges.  Ranges that turn out to hold more than twice their
   part are subdivided at quantiles of a second, denser sample drawn inside them, until none does or it holds one key.
3. The ranges' exact sizes (a small table) give every range its first byte; inside a range a running sum places each
   record, and the shard is the one that the middle of the record falls into.

Shard sizes then differ from the mean by at most one record.  A record's rank in its shard (slot) comes from counts by range
and shard.

Defined cases: null text counts no bytes and is ordered as an empty one; a null id is ordered first; identical rows lie side
by side in any order; with fewer records than shards some shards stay empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis.llm.scratch import written

OVERSAMPLE = 400
RANGES = 8
OVERHEAD = 8
ROUNDS = 6


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size (UTF-8 bytes of the text plus OVERHEAD), text_crc32 and the place in the key order: ``__order`` is the
    crc32 in the upper and a hash of the key in the lower 31 bits."""
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")))
    out = docs.select(F.col(key), (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"), crc.alias("text_crc32"))
    return out.withColumn("__order", F.col("text_crc32") * (1 << 31) + F.hash(key).bitwiseAND(0x7FFFFFFF))


def _drawn(records: DataFrame, rate: Column, seed: int) -> DataFrame:
    """Records drawn with chance ``rate``, by a hash."""
    chance = (F.pmod(F.xxhash64("__order", "size", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)).cast("double")
    return records.where(chance < rate).select("__order")


def _quantiles(keys: list[int], parts: int) -> list[int]:
    """At most parts - 1 distinct keys that cut the sample evenly; a range begins with its splitter."""
    keys = sorted(keys)
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def _range_of(order: Column, splitters: list[int]) -> Column:
    """Index of the range, by binary search in a CASE tree."""

    def within(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(order < F.lit(splitters[mid]), within(lo, mid)).otherwise(within(mid + 1, hi))

    return within(0, len(splitters))


def splitters(records: DataFrame, total: int, shards: int) -> list[int]:
    """Range boundaries such that no range of several keys holds more than twice ``total / (shards * RANGES)`` bytes."""
    ranges = shards * RANGES
    want = shards * OVERSAMPLE
    found = _quantiles([r[0] for r in _drawn(records, F.lit(float(want)) * F.col("size") / F.lit(float(max(total, 1))), 1).collect()], ranges)
    part = total / ranges
    for seed in range(2, 2 + ROUNDS):
        at = records.withColumn("__range", _range_of(F.col("__order"), found))
        load = at.groupBy("__range").agg(F.sum("size").alias("bytes"), F.min("__order").alias("lo"), F.max("__order").alias("hi"))
        over = load.where((F.col("bytes") > 2 * part) & (F.col("lo") < F.col("hi"))).collect()  # at most one row a range
        if not over:
            break
        heavy = at.where(F.col("__range").isin([r["__range"] for r in over]))
        # denser than the first sample by as much as these ranges are a part of the whole, and bounded like it
        rate = min(1.0, want / max(1, sum(r["bytes"] for r in over)))
        inside: dict[int, list[int]] = {}
        for r in _drawn(heavy.select("__range", "__order", "size"), F.lit(rate) * F.col("size"), seed).collect():
            for o in over:
                if o["lo"] <= r[0] <= o["hi"]:
                    inside.setdefault(o["__range"], []).append(r[0])
        new = set(found)
        for o in over:
            cuts = _quantiles(inside.get(o["__range"], []), max(2, round(o["bytes"] / part)))
            new |= {c for c in cuts if c > o["lo"]} or {o["hi"]}
        found = sorted(new)
    return found


def assign(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, shard (0 to shards - 1) and slot (gapless from 0 in each shard)."""
    records = written(sized(docs, key, text), "records")
    total = records.agg(F.sum("size")).first()[0] or 0
    cuts = splitters(records, total, shards)
    at = records.withColumn("__range", _range_of(F.col("__order"), cuts))
    loads = at.groupBy("__range").agg(F.sum("size").alias("bytes")).collect()  # one row a range
    first, starts = 0, []
    for r in sorted(loads, key=lambda r: r["__range"]):
        starts.append((r["__range"], first))
        first += r["bytes"]
    spark = docs.sparkSession
    begin = F.broadcast(spark.createDataFrame(starts, "__range int, __first long"))  # one row a range
    order = Window.partitionBy("__range").orderBy("__order", key, "size")
    middle = F.col("__first") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size") / 2
    at = at.join(begin, "__range").withColumn("shard", F.least(F.floor(middle * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int"))
    at = written(at.withColumn("__rank", F.row_number().over(Window.partitionBy("__range", "shard").orderBy("__order", key, "size"))), "shards")
    counts = at.groupBy("shard", "__range").count().collect()  # ranges + shards rows at most
    before: dict[int, int] = {}
    offsets = []
    for r in sorted(counts, key=lambda r: (r["shard"], r["__range"])):
        offsets.append((r["shard"], r["__range"], before.get(r["shard"], 0)))
        before[r["shard"]] = before.get(r["shard"], 0) + r["count"]
    held = F.broadcast(spark.createDataFrame(offsets, "shard int, __range int, __before long"))
    slot = (F.col("__before") + F.col("__rank") - 1).cast("long")
    return at.join(held, ["shard", "__range"]).select(key, "size", "text_crc32", "shard", slot.alias("slot"))


def write(docs: DataFrame, path: str, shards: int = 24, key: str = "doc_id", text: str = "text") -> None:
    """Writes ``docs`` with their shard and slot, a folder a shard; rows are spread by shard and stretches of slots, so that a
    shard is several files and no task holds a whole one."""
    named = docs.withColumn("__crc", F.crc32(F.coalesce(F.col(text), F.lit(""))))
    placed = assign(docs, shards, key, text).groupBy(F.col(key).alias("__key"), F.col("text_crc32").alias("__text")).agg(F.min("shard").alias("shard"), F.min("slot").alias("slot"))
    joined = named.join(placed, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__crc") == F.col("__text"))).drop("__key", "__text", "__crc")
    joined.repartition("shard", F.floor(F.col("slot") / 10_000)).write.partitionBy("shard").parquet(path)


