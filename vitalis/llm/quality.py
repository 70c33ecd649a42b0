"""Quality rules with risk-controlled thresholds.

Each rule rejects a text whose measure lies above a cutoff.  The cutoffs are not set by hand: for each stratum (language)
and rule, a fixed grid of cutoffs is walked from the mildest on, and a cutoff is taken as long as the labelled holdout
proves that the rule's false-rejection rate (share of good texts rejected) is at most ``risk / number of rules``.  The proof is
the exact binomial test P(Binomial(n, limit) <= rejected good texts) <= delta / (strata * rules): a Bonferroni correction
over strata and rules, and fixed-sequence testing along the grid (it stops at the first cutoff that fails, so the grid
needs no further correction).  With probability 1 - delta, no stratum loses more than ``risk`` of its good texts.  All
proved cutoffs hold at once, so the one used is free to choose: the one with the largest
``bad rejected - cost * good rejected``, the mildest of equals.  A rule that is not proved in a stratum, or that catches
nothing there, rejects nothing there.

Defined cases: a null or empty text has no words and fails the base rule; a null stratum is a stratum like any other; labels with
a null id or null quality are ignored and an id labelled twice counts as good if any of its labels is good; a labelled id
found on several rows counts for each of its texts; copies of a text in a stratum are one trial, good if any of them is.  A
stratum without labels has only the base rule.  Other columns are kept as they are, whatever their names (``keep_good``).  Empty
tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm import wordhash
from vitalis.llm.scratch import free_prefix, map_arrow, ship, written

STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``measure`` is SQL over STATS; larger is worse.  ``grid``: cutoffs, mildest first."""

    name: str
    measure: str
    grid: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / n_words", (3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
    Rule("capitals", "n_upper / word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("duplicate_lines", "n_dup_lines / n_lines", (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("repeats", "n_repeat_words / n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("long_words", "word_chars / n_words", (40.0, 30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0)),
    Rule("short_words", "-(word_chars / n_words)", (-1.0, -1.5, -2.0, -2.5, -3.0, -3.5, -4.0)),
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def _dup_lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier line, of each text."""
    lines, dups = np.zeros(len(at) - 1, np.int64), np.zeros(len(at) - 1, np.int64)
    raw = data.tobytes()
    for i in range(len(at) - 1):
        full = [x for x in raw[at[i] : at[i + 1]].split(b"\n") if x and not x.isspace()]
        lines[i], dups[i] = len(full), len(full) - len(set(full))
    return lines, dups


def _repeat_words(w: wordhash.Words) -> np.ndarray:
    """Words inside a 3-word window that its text has twice or more."""
    grams, whole = w.grams(3)
    marked = np.zeros(len(w.hashes), bool)
    if whole.any():
        place = np.flatnonzero(whole)
        text = np.searchsorted(w.at, place, side="right").astype(np.uint64)
        key = wordhash.mix(grams[place] ^ (text * np.uint64(0x9E3779B97F4A7C15)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        hit = place[order[again]]
        for j in range(3):
            marked[hit + j] = True
    return wordhash.per_text(marked, w.at)


def measure(column: pa.Array) -> list[np.ndarray]:
    """The STATS of every text of an Arrow string column."""
    out = [np.zeros(len(column), np.int64) for _ in STATS]
    for w in wordhash.words(column, wordhash.SPACED):
        here = slice(w.first, w.first + len(w.at) - 1)
        letters = (wordhash.SPACED[w.data] != 0) & ((w.data & 0xC0) != 0x80)
        found = (w.count, wordhash.per_text(letters, w.bytes_at), wordhash.per_text(_SYMBOL[w.data], w.bytes_at), *_dup_lines(w.data, w.bytes_at), _repeat_words(w), wordhash.per_text(_UPPER[w.data], w.bytes_at))
        for o, x in zip(out, found, strict=True):
            o[here] = x
    return out


def with_stats(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the STATS of ``text`` as long columns named prefix + name, in one pass without a shuffle.
    The names must be free; give a prefix where the input has columns of these names."""
    names = [prefix + s for s in STATS]
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns already there: {sorted(clash)}")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, measure(batch.column(at)))], names=[*batch.schema.names, *names])

    return map_arrow(docs, run, schema)


def base_failed(prefix: str = "") -> Column:
    """Fewer than 50 words, or more than half of the words in repeated 3-word windows."""
    n, r = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def _value(rule: Rule, prefix: str = "") -> Column:
    text = rule.measure
    for s in sorted(STATS, key=len, reverse=True):
        text = text.replace(s, f"`{prefix}{s}`")
    # no words or lines: nothing to measure, never above a cutoff
    top, _, under = text.strip("-()").partition(" / ")
    sign = "-" if text.startswith("-") else ""
    return F.expr(f"CASE WHEN {under} > 0 THEN {sign}({top} / {under}) END")


def binomial_tail(k: int, n: int, p: float) -> float:
    """Exact P(Binomial(n, p) <= k)."""
    if k >= n:
        return 1.0
    log_p, log_q = math.log(p), math.log1p(-p)
    return min(1.0, math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q) for i in range(k + 1)))


@dataclass
class Counts:
    """Of one stratum and rule: good texts, and the good and bad texts above each cutoff of the grid."""

    good: int
    good_above: list[int]
    bad_above: list[int]


def select_cutoffs(counts: dict[tuple[str, str], Counts], risk: float, delta: float, cost: float, rules: tuple[Rule, ...] = RULES, strata: int | None = None) -> dict[tuple[str, str], float]:
    """Cutoff by (stratum, rule) for those that are proved and catch something.  ``strata``: how many there are in all, if
    ``counts`` has only some of them."""
    strata = strata or len({s for s, _ in counts}) or 1
    level, limit = delta / (strata * len(rules)), risk / len(rules)
    out = {}
    for (stratum, name), c in counts.items():
        grid = next(r.grid for r in rules if r.name == name)
        best = 0.0
        for cutoff, k, caught in zip(grid, c.good_above, c.bad_above, strict=True):
            if k > limit * c.good or binomial_tail(k, c.good, limit) > level:
                break
            if caught - cost * k > best:
                best, out[stratum, name] = caught - cost * k, cutoff
    return out


def _stratum(stratum: str) -> Column:
    """The stratum as a string without nulls."""
    return F.when(F.col(stratum).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(stratum).cast("string")))


def fit_cutoffs(stats: DataFrame, labels: DataFrame, same: str, key: str = "doc_id", stratum: str = "lang", quality: str = "quality", prefix: str = "", risk: float = 0.05, delta: float = 0.05, cost: float = 20.0, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per stratum with a proved cutoff: stratum (see ``_stratum``) and the cutoff of each rule, null where it has none.

    Every label is used and every labelled value of ``stratum`` is a stratum of its own.  ``same`` is the column of ``stats`` that
    tells texts apart: copies of a text are one trial, not many."""
    known = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull()).groupBy(F.col(key).alias("__key")).agg((F.max(quality) > 0).alias("__good"))
    held = stats.where(~base_failed(prefix)).select(F.col(key).alias("__key"), _stratum(stratum).alias("stratum"), F.col(same).alias("__same"), *(_value(r, prefix).alias(r.name) for r in rules))
    trials = held.join(known, "__key").groupBy("stratum", "__same").agg(F.max("__good").alias("good"), *(F.first(r.name).alias(r.name) for r in rules))

    def passes(rule: Rule) -> Column:
        """How many cutoffs of the grid the measure lies above."""
        return F.size(F.filter(F.array(*map(F.lit, rule.grid)), lambda cutoff: F.col(rule.name) > cutoff))

    passed = [F.struct(F.lit(r.name).alias("rule"), passes(r).alias("passed")) for r in rules]
    counted = written(trials.select("stratum", "good", F.explode(F.array(*passed)).alias("x")).groupBy("stratum", "x.rule", "x.passed", "good").count(), "trials")
    strata = counted.select("stratum").distinct().count()
    schema = T.StructType([T.StructField("stratum", T.StringType()), *(T.StructField(r.name, T.DoubleType()) for r in rules)])

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        """Of one stratum: at most two rows for each cutoff."""
        counts: dict[tuple[str, str], Counts] = {}
        for s, name, beyond, good, c in part[["stratum", "rule", "passed", "good", "count"]].itertuples(index=False):
            size = next(len(x.grid) for x in rules if x.name == name)
            one = counts.setdefault((s, name), Counts(0, [0] * size, [0] * size))
            if good:
                one.good += c
            above = one.good_above if good else one.bad_above
            for i in range(size - beyond, size):  # the last cutoffs of a grid are the lowest
                above[i] += c
        cut = select_cutoffs(counts, risk, delta, cost, rules, strata)
        return pd.DataFrame([[s, *(cut.get((s, r.name)) for r in rules)] for s in {s for s, _ in cut}], columns=schema.fieldNames())

    ship(stats.sparkSession)
    return written(counted.groupBy("stratum").applyInPandas(choose, schema), "cutoffs")


def with_rejected(stats: DataFrame, cutoffs: DataFrame, name: str, stratum: str = "lang", prefix: str = "", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``stats`` with a column ``name``: whether any rule's measure lies above its cutoff in the row's stratum.  Without labels a
    stratum has no cutoffs.  The table of cutoffs is stored, so Spark knows its size and broadcasts it only if it is small."""
    cut = cutoffs.select(F.col("stratum").alias(name + "_at"), *(F.col(r.name).alias(f"{name}_{r.name}") for r in rules))
    above = F.lit(False)
    for r in rules:
        above = above | F.coalesce(_value(r, prefix) > F.col(f"{name}_{r.name}"), F.lit(False))
    return stats.join(cut, _stratum(stratum) == F.col(name + "_at"), "left").withColumn(name, above).drop(*cut.columns)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: key, stratum, STATS, base_failed, kept."""
    stats = written(with_stats(docs.select(key, stratum, text, F.md5(text).alias("__same")), text).drop(text), "quality")
    cutoffs = fit_cutoffs(stats, labels, "__same", key, stratum, risk=risk, delta=delta)
    return with_rejected(stats.drop("__same"), cutoffs, "__rejected", stratum).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~F.col("__rejected")).drop("__rejected")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns: statistics for the cutoffs first, then one filtering pass."""
    own = free_prefix(docs)
    same = own + "same"
    stats = with_stats(docs.select(key, stratum, text, F.md5(text).alias(same)), text, own).drop(text)
    cutoffs = fit_cutoffs(stats, labels, same, key, stratum, prefix=own, risk=risk, delta=delta)
    measured = with_stats(docs, text, own).where(~base_failed(own))
    return with_rejected(measured, cutoffs, own + "rejected", stratum, own).where(~F.col(own + "rejected")).select(docs.columns)
