"""Merkle manifest of a dataset: checkpoint and recompute.

Each record is a leaf, the digest of its fields.  The leaves of a tree (one for each value of a column) ascend by key; runs of
``FANOUT`` nodes become one digest until one node, the subroot, is left; the subroots, ordered by their tree, give the root
in the same way.  All digests are lowercase hexadecimal SHA-256 and enter the next one as that text.

Only every ``STRIDE``-th level is stored (``SPAN`` = FANOUT ** STRIDE leaves stand under one stored node), as one Parquet table
for each stored level.  A proof needs the siblings on all levels: an aligned subtree of at most ``SPAN`` stored nodes is read,
the levels between are hashed again, the siblings of each node are emitted and the levels are dropped.  Going down from the
root, a node's proof is its own part in its subtree and the proof of the stored node above.  Everything is DataFrame
expressions; a group never holds more than ``SPAN`` digests, so a tree with most of the leaves is only more groups.

Leaves are numbered without a window over a tree: they are range-partitioned by (tree, key, digest), numbered within their
partition, and offsets come from the counts by tree and partition.

Defined cases: a null field is ``-``; a null tree is the first one, before the empty string; rows with a null key come first in
their tree; rows of one key are ordered by their digest, equal rows take neighbouring places; an empty table has no
subroots and no root.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalis.llm.scratch import written

FANOUT = 8
STRIDE = 3
SPAN = FANOUT**STRIDE


def digest(*values: Column) -> Column:
    """Digest of a record: each value as its UTF-8 length, a colon and itself; ``-`` for null."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with ``tree``) with their place in the tree, ``pos``, and its number of rows, ``n``.  Equal rows are told apart by
    a number that only serves to spread them over partitions."""
    by = ["tree", *order, "__salt"]
    ordered = rows.withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("__salt")
    held = written(ordered.withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()), "ordered")
    parts = held.groupBy("tree", "__part").agg(F.min("__row").alias("__first"), F.count("*").alias("__c"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("__c").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("tree", "__part", "__first", before.alias("__before"), F.sum("__c").over(tree).alias("n"))
    return held.join(offsets, ["tree", "__part"]).withColumn("pos", F.col("__row") - F.col("__first") + F.col("__before")).drop("__part", "__row", "__first", "__before")


def _up(nodes: Column) -> Column:
    """The level above an array of nodes."""
    return F.transform(F.sequence(F.lit(0), ((F.size(nodes) - 1) / FANOUT).cast("int")), lambda i: F.sha2(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), ""), 256))


def _subtrees(nodes: DataFrame, *carried: str) -> DataFrame:
    """Aligned subtrees of stored nodes: tree, block, n, x (the nodes with pos and ``carried``), l0 and the regenerated levels l1 ...
    up to the next stored one; null above the root of the tree."""
    out = nodes.groupBy("tree", F.expr(f"pos div {SPAN}").alias("block")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "node", *carried))).alias("x"))
    out = out.withColumn("l0", F.col("x.node"))
    for level in range(STRIDE):
        below = F.col(f"l{level}")
        out = out.withColumn(f"l{level + 1}", F.when((F.col("n") > SPAN) | (F.size(below) > 1), _up(below)))
    return out


def _store(nodes: DataFrame, path: str) -> None:
    """Writes the levels 0, STRIDE, 2 * STRIDE ... of all trees: path/0, path/1 ..."""
    spark, level = nodes.sparkSession, 0
    nodes.write.parquet(f"{path}/0")
    while True:
        tall = spark.read.parquet(f"{path}/{level}").where("n > 1")
        if tall.isEmpty():
            return
        top = F.coalesce(*(F.col(f"l{k}") for k in range(STRIDE, -1, -1)))[0]
        level += 1
        _subtrees(tall.select("tree", "pos", "n", "node")).select("tree", F.col("block").alias("pos"), F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n"), top.alias("node")).write.parquet(f"{path}/{level}")


def _levels(spark: SparkSession, path: str) -> list[DataFrame]:
    """The stored levels.  A level without a tall tree is the last."""
    out = [spark.read.parquet(f"{path}/0")]
    while not out[-1].where("n > 1").isEmpty():
        out.append(spark.read.parquet(f"{path}/{len(out)}"))
    return out


def _peaks(levels: Sequence[DataFrame]) -> DataFrame:
    """tree, node: the one node left of each tree, on whichever stored level."""
    out = levels[0].where("n = 1").select("tree", "node")
    for level in levels[1:]:
        out = out.union(level.where("n = 1").select("tree", "node"))
    return out


def write(docs: DataFrame, path: str, key: str = "doc_id", tree: str = "lang", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), carry: Mapping[str, Column] | None = None) -> None:
    """Writes the manifest of ``docs`` to the folder ``path``: ``trees`` and, over their subroots, ``top``.  ``carry``: columns kept
    with each leaf, by a name that the proofs give them (not pos, n, node, tree, key)."""
    extra = dict(carry or {})
    clash = set(extra) & {"pos", "n", "node", "tree", "key", "proof", "subroot", "root"}
    if clash:
        raise ValueError(f"names taken: {sorted(clash)}")
    # null first, then bytewise
    named = F.when(F.col(tree).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(tree).cast("string")))
    rows = docs.select(named.alias("tree"), F.col(key).alias("key"), digest(*(F.col(f) for f in fields)).alias("node"), *(c.alias(name) for name, c in extra.items()))
    _store(_numbered(rows, ["key", "node"]), f"{path}/trees")
    peaks = _peaks(_levels(docs.sparkSession, f"{path}/trees"))
    _store(_numbered(peaks.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "node"), ["key", "node"]), f"{path}/top")


def _siblings(level: int) -> Column:
    """Texts left and right of the node under the place ``i`` of its subtree on ``level``; null above the root."""
    here = F.expr(f"i div {FANOUT**level}").cast("int")
    inside = here % FANOUT
    left = F.array_join(F.slice(F.col(f"l{level}"), here - inside + 1, inside), "")
    right = F.array_join(F.slice(F.col(f"l{level}"), here + 2, F.lit(FANOUT - 1) - inside), "")
    return F.when(F.col(f"l{level + 1}").isNotNull(), F.struct(left.alias("left"), right.alias("right")))


def _proved(levels: Sequence[DataFrame], peaks: DataFrame, wanted: DataFrame | None, *carried: str) -> DataFrame:
    """tree, ``carried``, node, proof, subroot, root of the lowest level (of ``wanted`` places only).  ``peaks``: tree, proof, root
    of each tree's one node."""
    places = [wanted]
    for _ in levels[1:]:
        places.append(places[-1] and places[-1].select("tree", F.expr(f"pos div {SPAN}").alias("pos")).distinct())
    above = None
    for k in range(len(levels) - 1, -1, -1):
        own, nodes = list(carried if k == 0 else ()), levels[k]
        if places[k] is not None:
            chosen = places[k].select("tree", F.expr(f"pos div {SPAN}").alias("__block")).distinct()
            nodes = nodes.withColumn("__block", F.expr(f"pos div {SPAN}")).join(chosen, ["tree", "__block"], "leftsemi").drop("__block")
        done = nodes.where("n = 1").join(peaks, "tree").select("tree", "pos", "node", *own, "proof", F.col("node").alias("subroot"), "root")
        if above is not None:
            blocks = _subtrees(nodes.where("n > 1"), *own).join(above.select("tree", F.col("pos").alias("block"), F.col("proof").alias("upper"), "subroot", "root"), ["tree", "block"])
            each = blocks.select("*", F.posexplode("x").alias("i", "one"))
            part = F.array_compact(F.array(*(_siblings(t) for t in range(STRIDE))))
            done = done.union(each.select("tree", "one.pos", "one.node", *(f"one.{c}" for c in own), F.concat(part, "upper").alias("proof"), "subroot", "root"))
        if places[k] is not None:
            done = done.join(places[k], ["tree", "pos"], "leftsemi")
        above = done
    return above


def proofs(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """One row per leaf of the manifest: key, node (the leaf), what ``write`` carried, proof (from the leaf to the root, one entry
    for each level: the digests of the run's other nodes, left and right of the own one), subroot, root.  ``keys``: a DataFrame
    of one column; only the subtrees above these keys are read and hashed."""
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    top, trees = _levels(spark, f"{path}/top"), _levels(spark, f"{path}/trees")
    root = _peaks(top).select("tree", nothing.alias("proof"), F.col("node").alias("root"))
    peaks = _proved(top, root, None, "key").select(F.col("key").alias("tree"), "proof", "root")
    wanted = None
    if keys is not None:
        wanted = trees[0].join(keys.toDF("key"), "key", "leftsemi").select("tree", "pos")
    carried = [c for c in trees[0].columns if c not in ("tree", "pos", "n", "node")]
    return _proved(trees, peaks, wanted, *carried).drop("tree", "pos")


def folded(node: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, node, lambda under, level: F.sha2(F.concat(level["left"], under, level["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)
