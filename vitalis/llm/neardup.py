"""Near-duplicates by min-max hashing.

A text's set is its distinct k-word shingles (64-bit hashes).  Under each random permutation both the least and the
greatest image are kept: two signature values for one hash evaluation, each equal for two sets with probability J (their
Jaccard similarity).  ``rows`` consecutive values make a band; texts that share a band are candidates.  With J at the
threshold a pair shares none of the bands with probability (1 - J**rows)**bands: 2e-7 for 48 bands of 8 at 0.85, 5e-7 for
48 of 6 at 0.80.

1. Texts with equal sets are one class, stood for by its least id.
2. In each band bucket every class is compared with one hub only, the class that meets most others over all its buckets
   (the original of a family of copies rather than a much-changed copy): linear in the bucket, whatever its size.
   Candidates are confirmed on the full sets and links contracted to components.
3. Buckets that still hold several components may hide links between them.  Their classes go through an exact prefix
   filter: ordered by how many of these classes have it, a link's two sets of sizes n and m must share
   c = ceil(t * (n + m) / (1 + t)) shingles, so one among the first n - c + 1 of the one and m - c + 1 of the other.  Rows of one component are never paired: in each posting the members outside its largest
   component are compared with the rest.  Confirmed links are contracted again.

No pair within a component is enumerated, nothing is capped, and only classes with candidates have their sets moved.

Defined cases: null and empty texts have an empty set and are linked with nothing; a text with fewer than k words has one
shingle, its whole sequence; rows with a null id are never linked (component null, kept); rows with one id are one document,
linked by any of its texts.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm import wordhash
from vitalis.llm.scratch import free_prefix, map_arrow, written

_U = np.uint64


class Signer:
    """Shingle sets, class fingerprints and band hashes of texts."""

    def __init__(self, shingle: int, bands: int, rows: int, seed: int = 7):
        if rows % 2:
            raise ValueError("rows come in pairs: the least and the greatest of a permutation")
        rng = np.random.default_rng(seed)
        self.shingle, self.bands, self.rows = shingle, bands, rows
        self.times = rng.integers(0, 1 << 64, bands * rows // 2, dtype=np.uint64) | _U(1)
        self.plus = rng.integers(0, 1 << 64, bands * rows // 2, dtype=np.uint64)
        self.places = rng.integers(0, 1 << 64, rows, dtype=np.uint64) | _U(1)

    def sets(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(index of the first text, sorted distinct shingle hashes of each text) for runs of texts."""
        for w in wordhash.words(column, wordhash.SPACED_FOLDED):
            grams, _ = w.grams(self.shingle)
            short = {n: w.grams(n)[0] for n in range(1, self.shingle) if (w.count == n).any()}
            yield w.first, [np.unique(grams[a : a + n - self.shingle + 1]) if n >= self.shingle else short[n][a : a + 1] if n else grams[:0] for a, n in zip(w.at[:-1].tolist(), w.count.tolist(), strict=True)]

    def signed(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Set sizes, 128-bit fingerprints (n x 2) and band hashes (n x bands); empty sets have zeros."""
        n = np.zeros(len(column), np.int64)
        prints = np.zeros((len(column), 2), np.uint64)
        bands = np.zeros((len(column), self.bands), np.uint64)
        for first, sets in self.sets(column):
            sizes = np.array([len(s) for s in sets])
            n[first : first + len(sets)] = sizes
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            x = np.concatenate([sets[i] for i in full])
            at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            prints[first + full, 0] = np.add.reduceat(wordhash.mix(x), at)
            prints[first + full, 1] = np.add.reduceat(wordhash.mix(x ^ _U(0x5851F42D4C957F2D)), at)
            half = self.rows // 2
            for b in range(self.bands):
                band = np.full(len(full), b + 1, np.uint64)
                for r in range(half):
                    image = x * self.times[b * half + r] + self.plus[b * half + r]
                    band += np.minimum.reduceat(image, at) * self.places[2 * r] + np.maximum.reduceat(image, at) * self.places[2 * r + 1]
                bands[first + full, b] = wordhash.mix(band)
        return n, prints, bands


def _signatures(docs: DataFrame, key: str, text: str, signer: Signer) -> DataFrame:
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, prints, bands = signer.signed(batch.column(1))
            at = np.concatenate([[0], np.cumsum(np.where(n > 0, signer.bands, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(bands[n > 0].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(prints[:, 0].copy().view(np.int64)), pa.array(prints[:, 1].copy().view(np.int64)), lists], names=schema.fieldNames())

    return map_arrow(docs.select(key, text), run, schema)


def _sets(docs: DataFrame, key: str, text: str, signer: Signer) -> DataFrame:
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [s.tobytes() for _, sets in signer.sets(batch.column(1)) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=schema.fieldNames())

    return map_arrow(docs.select(key, text), run, schema)


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (u, v) whose full sets have similarity num / den or more."""
    num, den = similarity
    schema = pairs.select("u", "v").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, keep = batch.column(2), batch.column(3), np.zeros(len(batch), bool)
            for i in range(len(batch)):
                p, q = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
                small, large = (p, q) if len(p) <= len(q) else (q, p)
                if den * len(small) < num * len(large) or not len(small):
                    continue
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep[i] = den * both >= num * (len(p) + len(q) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    x, y = (sets.select(F.col("key").alias(c), F.col("shingles").alias("s" + c)) for c in "uv")
    return map_arrow(pairs.join(x, "u").join(y, "v").select("u", "v", "su", "sv"), run, schema).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges -> (u, v) with v the least node reachable from u, for every u that is not its own least.

    Alternates large-star and small-star steps until nothing changes: a few rounds of joins on the edges, each written to
    the shared folder.  No node's neighbours are gathered; a hub's edges are joined with one row, a join that can be split."""
    e = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = e.union(e.select("v", "u")).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.where("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        e = written(e.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return e
        state = now


def _with_component(df: DataFrame, key: str, stars: DataFrame) -> DataFrame:
    return df.join(stars.select(F.col("u").alias(key), "v"), key, "left").withColumn("component", F.coalesce("v", key)).drop("v")


def _hidden_pairs(sets: DataFrame, stars: DataFrame, ids: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (u, v) of different components among ``ids`` that pass the exact prefix filter."""
    num, den = similarity
    schema = T.StructType([sets.schema["key"], T.StructField("set", T.LongType()), T.StructField("n", T.LongType()), T.StructField("shingle", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                found = [np.frombuffer(s.as_buffer(), np.int64) for s in part.column(1)]
                sizes = np.array([len(x) for x in found])
                owner = np.repeat(np.arange(len(found)), sizes)
                prints = np.array([np.bitwise_xor.reduce(x) for x in found])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), pa.array(prints[owner]), pa.array(sizes[owner]), pa.array(np.concatenate(found))], names=schema.fieldNames())

    spread = map_arrow(sets.join(ids, "key", "leftsemi"), run, schema)
    common = spread.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = spread.join(common, "shingle")
    # single shingles come first in the order and pair with nothing; what is left of the prefix goes to the rarest others
    sizes = shared.groupBy("key", "set", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("x"))
    left = F.expr(f"n - (n * {num} + {den - 1}) div {den} + 1 - (n - size(x))").cast("int")
    prefix = sizes.where(left > 0).select("key", "n", (F.col("n") - F.size("x")).alias("singles"), F.posexplode(F.slice("x", 1, left)).alias("i", "s"))
    prefix = prefix.select("key", "n", "s.shingle", (F.col("singles") + F.col("i") + 1).alias("pos"))
    prefix = written(_with_component(prefix, "key", stars), "prefix")
    members = prefix.groupBy("shingle", "component").agg(F.count("*").alias("c"))
    largest = members.groupBy("shingle").agg(F.max(F.struct("c", "component")).alias("m"), F.count("*").alias("k")).where("k > 1").select("shingle", F.col("m.component").alias("largest"))
    mixed = prefix.join(largest, "shingle")
    outside = mixed.where("component != largest").select("shingle", F.col("key").alias("x"), F.col("n").alias("xn"), F.col("pos").alias("xpos"), F.col("component").alias("xc"))
    # sets of sizes n and m need num * (n + m) / (num + den) common shingles, so one among the first of each that allow for that
    need = F.expr(f"({num} * (n + xn) + {num + den - 1}) div {num + den}")
    met = outside.join(mixed, "shingle").where((F.col("xc") != F.col("component")) & (F.col("pos") <= F.col("n") - need + 1) & (F.col("xpos") <= F.col("xn") - need + 1))
    return met.select(F.greatest("x", "key").alias("u"), F.least("x", "key").alias("v")).distinct()


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, similarity: tuple[int, int] = (85, 100), bands: int = 48, rows: int = 8) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (least id reachable over links) and kept (it is its own)."""
    signer = Signer(shingle, bands, rows)
    num, den = similarity
    signed = written(_signatures(docs, key, text, signer), "signatures")
    known = signed.where("n > 0 AND key IS NOT NULL")
    classes = written(known.groupBy("a", "b", "n").agg(F.min(F.struct("key", "bands")).alias("x")).select("a", "b", "n", "x.key", "x.bands"), "classes")
    members = known.select("key", "a", "b", "n").join(classes.select("a", "b", "n", F.col("key").alias("class")), ["a", "b", "n"]).select("key", "class")

    buckets = classes.select("key", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    # ids found with several texts: the same id may stand for several classes, or belong to several
    several = members.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi")
    links = members.join(several, "key", "leftsemi").select(F.col("key").alias("u"), F.col("class").alias("v"))

    met = written(buckets.join(shared, "bucket").select("bucket", "key", "c"), "buckets")
    central = met.groupBy("key").agg(F.sum("c").alias("meets"))
    met = written(met.drop("c").join(central, "key"), "met")
    size = classes.groupBy("key").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    sets = written(_sets(docs.join(central.select(F.col("key").alias(key)), key, "leftsemi"), key, text, signer).distinct(), "sets")
    hubs = met.groupBy("bucket").agg(F.max(F.struct("meets", "key")).alias("x")).select("bucket", F.col("x.key").alias("hub"))
    pairs = met.join(hubs, "bucket").where("key != hub").select(F.col("key").alias("u"), F.col("hub").alias("v")).distinct()
    pairs = pairs.join(size.toDF("u", "ulo", "uhi"), "u").join(size.toDF("v", "vlo", "vhi"), "v").where(f"uhi * {den} >= vlo * {num} AND vhi * {den} >= ulo * {num}").select("u", "v")
    links = written(_confirmed(pairs, sets, similarity).union(links), "links")
    stars = components(links)

    parted = _with_component(met.select("bucket", "key"), "key", stars)
    mixed = parted.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    unsure = written(parted.join(mixed, "bucket", "leftsemi").select("key").distinct(), "unsure")
    if not unsure.isEmpty():
        stars = components(_confirmed(_hidden_pairs(sets, stars, unsure, similarity), sets, similarity).union(stars))

    found = _with_component(members.distinct(), "class", stars).groupBy("key").agg(F.min("component").alias("component"))
    out = signed.select("key", "n").join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("component") == F.col("key"), F.lit(True)).alias("kept"))


def _node(docs: DataFrame, key: str, text: str) -> Column:
    """A node for each text of an id, in the order of the ids: the id, then 63 bits of the text's hash.  Null for a null id."""
    h = F.xxhash64(text)
    if isinstance(docs.schema[key].dataType, T.IntegralType):
        shifted = F.col(key).cast("decimal(19,0)") * F.lit(Decimal(1 << 63)).cast("decimal(19,0)")
        return (shifted + F.shiftrightunsigned(h, 1).cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.concat(F.col(key).cast("string"), F.lit("\x00"), F.hex(h))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: tuple[int, int] = (80, 100), bands: int = 48, rows: int = 6) -> DataFrame:
    """One row of each component of ``docs``, the one with the least id, with all its columns.  Rows of one id are documents of
    their own: they are linked by their texts like any others, and rows equal in id and text are one.  Rows without words are
    linked with nothing and stay, once for each id and text; rows with a null id stay."""
    own = free_prefix(docs)
    repeated = written(docs.groupBy(key).count().where(F.col(key).isNotNull() & (F.col("count") > 1)).select(key), "repeated")
    if repeated.isEmpty():
        gone = link(docs, key, text, shingle, similarity, bands, rows).where(~F.col("kept")).select(key).distinct()
        return docs.join(gone, key, "leftanti").select(docs.columns)
    noded = docs.withColumn(own + "node", _node(docs, key, text))
    gone = link(noded.select(own + "node", text), own + "node", text, shingle, similarity, bands, rows).where(~F.col("kept")).select(own + "node").distinct()
    kept = noded.join(gone, own + "node", "leftanti").select(noded.columns)
    # equal rows of an id: one each, chosen by a partial aggregation
    one = kept.join(repeated, key, "leftsemi").groupBy(own + "node").agg(F.first(F.struct(*docs.columns)).alias("row"))
    return kept.join(repeated, key, "leftanti").select(docs.columns).union(one.select(*(F.col("row")[c].alias(c) for c in docs.columns)))
