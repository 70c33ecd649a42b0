"""Grouping of spelling variants: words one edit apart, each led to its most frequent neighbour.

Two words are near if one inserted, deleted or replaced code point makes one of the other.  Within a group of words that may be
near, the words are sorted; for each word the list is scanned with the edit matrix of the word and the list's words, of
which only the band of three diagonals matters.  A word that shares its first d code points with the one before keeps the
first d rows (adjacent longest common prefixes), and where a row has no value below two, all words with that prefix are
skipped.

Groups are made so that each near pair meets in exactly one.  Let m be the length of the shorter word and p the length of
the common prefix: the edit is at place p, so the words share the first p code points and the last m - p (m - p - 1 for
a replacement).  A window [lo, hi) of places says lo <= p < hi; its words share the first lo and the last m - hi code points, which is
the group's key.  Two windows cover all places; a word takes part once as one of the shorter and once as one of the longer
length.  Groups of more than ``MOST`` words are dealt again by halves of their window, down to windows of one place, where a group
holds at most one word for each letter and length: no cap, and no group grows with the vocabulary.  Groups are streamed
over sorted rows; what leaves a task is one row for each word and group, never pairs.

Words are counted with DataFrame functions, summed before the shuffle, so a frequent word is one row a task.

Defined cases: null and empty texts have no words; a null id counts as empty text before the colon; repeated rows count each
time; among near words of one frequency the least in code-point order is the form; empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.scratch import map_arrow, written

LETTERS = "A-Za-zÀ-ÿ"
MOST = 2000


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, typo: int | None = None) -> DataFrame:
    """word, n: the runs of letters, A-Z lowered, of at least ``shortest`` code points that occur ``least`` times.  With ``typo``, a run
    whose crc32 with its row's key that number divides loses one code point first (made-up misspellings)."""
    # runs shorter than the shortest word make no word, with or without a letter less
    found = F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{shortest},}})"), 1)
    lowered = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(found).alias("run")).select("key", lowered.alias("run"))
    if typo:
        h = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        shorter = F.concat(F.expr("run").substr(F.lit(1), at), F.expr("run").substr(at + 2, F.length("run")))
        runs = runs.select(F.when(h % typo == 0, shorter).otherwise(F.col("run")).alias("run")).where(F.length("run") >= shortest)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _grouped(entries: DataFrame) -> DataFrame:
    """``entries`` (word, n, m, lo, hi) with the group's key: head and tail."""
    tail = F.greatest(F.lit(0), F.col("m") - F.col("hi"))
    return entries.withColumn("head", F.col("word").substr(F.lit(1), F.col("lo"))).withColumn("tail", F.when(tail == 0, F.lit("")).otherwise(F.col("word").substr(F.length("word") - tail + 1, tail)))


def _windows(spans: list[tuple[Column, Column, Column]]) -> Column:
    return F.explode(F.array(*(F.struct(m.cast("int").alias("m"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi")) for m, lo, hi in spans)))


def groups(vocabulary: DataFrame, most: int = MOST) -> DataFrame:
    """word, n, m, lo, hi, head, tail: the groups that a word takes part in, none of more than ``most`` words unless its window is one
    place.  Groups of one word are left out."""
    size = F.length("word")
    spans = [x for m in (size, size - 1) for half in [F.floor(m / 2)] for x in ((m, F.lit(0), half), (m, half, m + 1))]
    first = vocabulary.select("word", "n", _windows(spans).alias("w")).select("word", "n", "w.*")
    entries, done = _grouped(first), []
    by = ["m", "lo", "hi", "head", "tail"]
    while True:
        sizes = entries.groupBy(*by).agg(F.count("*").alias("c")).where("c > 1")
        large = written(sizes.where((F.col("c") > most) & (F.col("hi") - F.col("lo") > 1)).select(*by), "large-groups")
        kept = entries.join(sizes.select(*by), by, "leftsemi")
        if large.isEmpty():
            return _union([*done, kept])
        done.append(kept.join(large, by, "leftanti"))
        mid = F.floor((F.col("lo") + F.col("hi")) / 2)
        halves = [(F.col("m"), F.col("lo"), mid), (F.col("m"), mid, F.col("hi"))]
        dealt = entries.join(large, by, "leftsemi").select("word", "n", _windows(halves).alias("w")).select("word", "n", "w.*")
        entries = written(_grouped(dealt), "dealt-groups")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0
    while n - lo > 1:  # a[:lo] == b[:lo]; the first difference lies before n
        mid = (lo + n) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            n = mid
    return lo


def scan(sorted_words: list[str], m: int, lo: int, hi: int) -> list[list[int]]:
    """For each word of a sorted list without repeats, which share their first ``lo`` code points, the places of its near words
    whose first difference from it lies in [lo, hi) and of which the shorter has ``m`` code points."""
    count = len(sorted_words)
    shared = [lo] + [_common(a, b) for a, b in zip(sorted_words, sorted_words[1:])]
    # the next word that shares less with the word before it
    shorter, open_ = [count] * count, []
    for i, d in enumerate(shared):
        while open_ and shared[open_[-1]] > d:
            shorter[open_.pop()] = i
        open_.append(i)
    sizes = [len(w) for w in sorted_words]
    out = []
    for q, query in enumerate(sorted_words):
        found, size = [], sizes[q]
        # rows[d]: distances of the first lo + d code points of the list's word to the query's first lo + d - 1, same and + 1 ones
        rows = [(1, 0, 1)]
        i = 0
        while i < count:
            word = sorted_words[i]
            depth = min(shared[i], lo + len(rows) - 1)
            del rows[depth - lo + 1 :]
            under, same, over = rows[-1]
            dead = False
            for d in range(depth, sizes[i]):
                c = word[d]
                # places of the query: d - 1, d, d + 1 (beyond its end: nothing fits)
                a = under + (c != query[d - 1]) if 0 < d <= size else 2
                a = min(a, same + 1)
                b = same + (c != query[d]) if d < size else 2
                b = min(b, over + 1, a + 1)
                e = over + (c != query[d + 1]) if d + 1 < size else 2
                under, same, over = a, b, min(e, b + 1)
                rows.append((under, same, over))
                # too far, or a first difference that lies beyond the window
                if (under > 1 and same > 1 and over > 1) or (d + 1 >= hi and same == 0):
                    depth, dead = d + 1, True
                    break
            if not dead:
                more = size - sizes[i]
                if -1 <= more <= 1 and min(size, sizes[i]) == m and i != q and (under, same, over)[more + 1] == 1:
                    found.append(i)
                i += 1
            else:
                i += 1
                while i < count and shared[i] >= depth:
                    i = shorter[i]
        out.append(found)
    return out


def near(vocabulary: DataFrame, most: int = MOST) -> DataFrame:
    """word, n_near, form, form_n: how many words are near, and the most frequent of them; words without near ones are left out."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("c", T.LongType()), T.StructField("best", T.StringType()), T.StructField("best_n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ready() -> Iterator[tuple]:
            for i, found in enumerate(scan(held, *span)):
                if found:
                    best = min(found, key=lambda j: (-times[j], held[j]))
                    yield held[i], len(found), held[best], times[best]

        group, span, held, times, out = None, (0, 0, 0), [], [], []
        for batch in batches:
            m, lo, hi, head, tail, word, n = (batch.column(i).to_pylist() for i in range(7))
            for i, g in enumerate(zip(m, lo, hi, head, tail, strict=True)):
                if g != group:
                    if len(held) > 1:
                        out += ready()
                    group, span, held, times = g, g[:3], [], []
                held.append(word[i])
                times.append(n[i])
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out, strict=True))), names=schema.fieldNames())
                out = []
        if len(held) > 1:
            out += ready()
        if out:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out, strict=True))), names=schema.fieldNames())

    by = ["m", "lo", "hi", "head", "tail"]
    dealt = groups(vocabulary, most).repartition(*by).sortWithinPartitions(*by, "word")
    parts = map_arrow(dealt.select(*by, "word", "n"), run, schema)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"), F.col("best_n").alias("form_n")))
    return parts.groupBy("word").agg(F.sum("c").alias("n_near"), best.alias("b")).select("word", "n_near", "b.form", "b.form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """word, root from word, form: forms followed to the last one, in doubling steps.  A form is at least so many times as
    frequent, so chains have few links and no cycle."""
    at = written(steps.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def group(vocabulary: DataFrame, factor: int = 5, most: int = MOST) -> DataFrame:
    """One row per word: word, form (its most frequent near word, if at least ``factor`` times as frequent), root (from the word, forms
    followed to the last), n, n_near, form_n."""
    if factor < 2:
        raise ValueError("a form must be more frequent than its variants")
    vocabulary = written(vocabulary, "vocabulary")
    judged = vocabulary.join(near(vocabulary, most), "word", "left").withColumn("led", F.coalesce(F.col("form_n") >= F.col("n") * factor, F.lit(False)))
    judged = written(judged.select("word", F.when(F.col("led"), F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("led"), F.col("form_n")).alias("form_n")), "forms")
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
