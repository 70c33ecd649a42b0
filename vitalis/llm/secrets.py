"""Secrets: known forms by pattern, and unknown ones by two character Markov models.

Two first-order models give the chance of each character after the one before: one of random strings (keys, tokens, digests),
one of ordinary identifiers and words.  A candidate is a run of characters that keys are made of, less what a known form
takes of it; where the log-likelihood ratio says random by more than ``margin`` nats a character, it is a finding of kind
``random``.  Ordinary text in the same run hides no key: where the whole run is not random, its best stretches are, found by a
running sum of the ratio less the margin and carried on to the next of / _ + - on both sides.

The models are trained here, from labelled samples: random strings are digests of numbers in the usual spellings (hex, base64,
base 36), ordinary ones are common words of program code and the words of up to ``WORDS_FROM`` documents (chosen by a hash of
their id) without those that hold a digit, spelled as words, CamelCase, snake_case and paths.  Only the table of transition counts, at most CLASSES squared, reaches
the driver; scoring is a sum over an array literal.  All steps are DataFrame functions.

Defined cases: null and empty texts have no spans; repeated rows are treated alike; candidates are scored in full, however long;
what a known form covers is that form only.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm import spans
from vitalis.llm.scratch import hash_sample, written

KINDS = ("assign", "access", "hex")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CLASSES = len(LETTERS) + 1  # the last stands for the beginning
#: Bounds of the labelled samples: documents that give ordinary words, and random strings of each spelling.
WORDS_FROM = 2_000
RANDOM_STRINGS = 4_000
MARGIN = 0.75
#: Least length of a finding, least length of a stretch before it is carried on, and nats that a running sum falls where one ends.
LEAST, STRETCH, DROP = 20, 16, 10.0
CANDIDATE = r"(?:(?<![A-Za-z0-9+/_-])|\G)[A-Za-z0-9+/_-]{20,}+"

#: Words that names in program code are made of.
CODE_WORDS = (
    "get set add remove user name value index count list map file path config option default connection host port request response "
    "session account information message service client server error handler manager factory builder process thread memory buffer "
    "stream reader writer source target version number date time status update delete insert select create table column row key "
    "field record document page title content text language international application development organization community library "
    "maximum minimum average total current previous next first last start stop open close enable disable visible hidden active "
    "network address database query result format parser string integer boolean object array element child parent root node tree "
    "graph layout window button screen image color width height position event listener callback parameter argument function method "
    "class interface module package directory folder project environment variable constant template resource permission security "
    "constraint validation transaction operation calculation configuration notification registration authentication description"
).split()

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def known(text: Column) -> dict[str, Column]:
    """Spans of each known form; of ``assign`` the text is the value."""
    text = F.coalesce(text, F.lit(""))
    return {
        "assign": spans.found(text, text.rlike(r"(?i)passw|secret|token|api_?key"), _ASSIGN, lambda s: F.length(s["text"]) >= 6, group=2),
        "access": spans.found(text, F.contains(text, F.lit("AKIA")), r"AKIA[A-Z0-9]+", lambda s: s["stop"] - s["start"] >= 20),
        "hex": spans.found(text, text.rlike("[0-9a-f]{24}"), r"[0-9a-f]{24,}+"),
    }


def random_samples(spark: SparkSession, n: int = RANDOM_STRINGS) -> DataFrame:
    """Column ``sample``: n strings of each spelling, the same in every run."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    raw = F.unhex(digest)
    spelled = F.explode(F.array(F.substring(digest, 1, 40), F.regexp_replace(F.base64(raw), "=", ""), F.translate(F.base64(raw), "+/=", "-_"), F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)), F.substring(F.regexp_replace(F.base64(raw), "[^A-Za-z0-9]", ""), 1, 32)))
    return spark.range(n).select(spelled.alias("sample"))


def ordinary_samples(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = WORDS_FROM) -> DataFrame:
    """Column ``sample``: words of the documents of ``most`` ids, alone and joined as identifiers are."""
    chosen = hash_sample(docs.where(F.col(text).isNotNull()).select(key, text), key, most)
    words = F.regexp_extract_all(F.col(text), F.lit(r"[A-Za-z0-9]{2,}+"), F.lit(0))
    plain = F.filter(words, lambda w: ~w.rlike("[0-9]"))
    joined = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size("w") / 3) - 1, F.lit(0)).cast("int")), lambda i: F.slice(F.col("w"), i * 3 + 1, 3))
    three = chosen.select(plain.alias("w")).where(F.size("w") > 0).select(F.explode(joined).alias("w"))
    n = len(CODE_WORDS)
    code = [([CODE_WORDS[i], CODE_WORDS[(i + step) % n], CODE_WORDS[(i + 3 * step) % n]],) for i in range(n) for step in (1, 7, 31)]
    three = three.union(docs.sparkSession.createDataFrame(code, "w array<string>"))
    return three.select(F.explode(F.array(F.array_join("w", ""), F.array_join(F.transform("w", F.initcap), ""), F.lower(F.array_join("w", "_")), F.upper(F.array_join("w", "_")), F.lower(F.array_join("w", "-")), F.concat(F.array_join("w", "/"), F.lit("1")))).alias("sample"))


def _class(letter: Column) -> Column:
    return F.instr(F.lit(LETTERS), letter) - 1


def transitions(samples: DataFrame) -> list[list[float]]:
    """Log chance of each class after each, add-one smoothed; at most CLASSES ** 2 rows are collected."""
    letters = F.split(F.regexp_replace("sample", f"[^{LETTERS}]", ""), "")
    pairs = samples.select(F.filter(letters, lambda x: x != "").alias("x")).where(F.size("x") > 0)
    each = pairs.select(F.explode(F.arrays_zip(F.concat(F.array(F.lit("")), "x").alias("a"), F.col("x").alias("b"))).alias("p")).where("p.b IS NOT NULL")
    count = [[1] * (CLASSES - 1) for _ in range(CLASSES)]
    for r in each.groupBy("p.a", "p.b").count().collect():
        count[LETTERS.index(r["a"]) if r["a"] else CLASSES - 1][LETTERS.index(r["b"])] += r["count"]
    return [[math.log(c / sum(row)) for c in row] for row in count]


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> list[float]:
    """Log-likelihood ratio random / ordinary of each transition, row by row."""
    chance, order = transitions(random_samples(docs.sparkSession)), transitions(ordinary_samples(docs, key, text))
    return [a - b for x, y in zip(chance, order, strict=True) for a, b in zip(x, y, strict=True)]


def ratio(string: Column, model: list[float]) -> Column:
    """Log-likelihood ratio a character of a string over LETTERS."""
    table, width = F.array(*map(F.lit, model)), CLASSES - 1
    start = F.struct(F.lit(CLASSES - 1).alias("at"), F.lit(0.0).alias("sum"))

    def step(state: Column, letter: Column) -> Column:
        c = _class(letter)
        return F.struct(c.alias("at"), (state["sum"] + F.get(table, state["at"] * width + c)).alias("sum"))

    return F.aggregate(F.filter(F.split(string, ""), lambda x: x != ""), start, step, lambda s: s["sum"] / F.length(string))


def stretches(string: Column, model: list[float], margin: float) -> Column:
    """Spans (in ``string``) of its best stretches: those whose running sum of ratio less margin is greatest, until it falls by
    DROP or to nothing; carried on to the next separators.  Stretches that then overlap are one."""
    table, width = F.array(*map(F.lit, model)), CLASSES - 1
    pair = "array<struct<start:int,stop:int>>"
    zero, nought = F.lit(0), F.lit(0.0)
    # at: class before; sum since begin; best: greatest sum, of the characters from begin to end
    first = F.struct(F.lit(CLASSES - 1).alias("at"), zero.alias("i"), nought.alias("sum"), zero.alias("begin"), nought.alias("best"), zero.alias("end"), F.array().cast(pair).alias("out"))

    def ended(state: Column) -> Column:
        one = F.array(F.struct(state["begin"].alias("start"), state["end"].alias("stop")))
        return F.when(state["end"] - state["begin"] >= STRETCH, F.concat(state["out"], one)).otherwise(state["out"])

    def step(state: Column, letter: Column) -> Column:
        c, i = _class(letter), state["i"] + 1
        total = state["sum"] + F.get(table, state["at"] * width + c) - margin
        over = (total <= 0) | (total < state["best"] - DROP)
        more = total > state["best"]
        return F.struct(
            c.alias("at"),
            i.alias("i"),
            F.when(over, nought).otherwise(total).alias("sum"),
            F.when(over, i).otherwise(state["begin"]).alias("begin"),
            F.when(over, nought).when(more, total).otherwise(state["best"]).alias("best"),
            F.when(over, i).when(more, i).otherwise(state["end"]).alias("end"),
            F.when(over, ended(state)).otherwise(state["out"]).alias("out"),
        )

    found = F.aggregate(F.filter(F.split(string, ""), lambda x: x != ""), first, step, ended)

    def carried(s: Column) -> Column:
        # separators at the ends are none of the stretch; beyond them it is not carried on
        text = F.substring(string, s["start"] + 1, s["stop"] - s["start"])
        start = s["start"] + F.length(text) - F.length(F.ltrim(text, F.lit("/_+-")))
        stop = s["stop"] - F.length(text) + F.length(F.rtrim(text, F.lit("/_+-")))
        before = F.length(F.regexp_extract(F.substring(string, F.lit(1), start), "([^/_+-]*)$", 1))
        after = F.length(F.regexp_extract(F.substring(string, stop + 1, F.length(string)), "^([^/_+-]*)", 1))
        return F.struct((start - before).alias("start"), F.greatest(start - before, stop + after).alias("stop"))

    def joined(out: Column, s: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        both = F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop")))
        return F.when((F.size(out) > 0) & (last["stop"] > s["start"]), F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, zero)), both)).otherwise(F.concat(out, F.array(s)))

    whole = F.aggregate(F.transform(found, carried), F.array().cast(pair), joined)
    return F.filter(whole, lambda s: s["stop"] - s["start"] >= LEAST)


def _part(c: Column, start: Column, stop: Column) -> Column:
    """The part of a span between two places."""
    return F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"), F.substring(c["text"], start - c["start"] + 1, stop - start).alias("text"))


def _cut(c: Column, every: Column) -> Column:
    """What the spans ``every`` leave of a candidate, without separators where it is cut, in pieces of LEAST characters or more."""
    over = F.array_sort(F.transform(F.filter(every, lambda s: (s["start"] < c["stop"]) & (c["start"] < s["stop"])), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
    edge = F.array_append(over, F.struct(c["stop"].alias("start"), c["stop"].alias("stop")))
    first = F.struct(c["start"].alias("at"), spans.none().alias("out"))

    def step(state: Column, s: Column) -> Column:
        more = F.when(s["start"] > state["at"], F.array(_part(c, state["at"], s["start"]))).otherwise(spans.none())
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), F.concat(state["out"], more).alias("out"))

    def trimmed(p: Column) -> Column:
        left = F.when(p["start"] > c["start"], F.length(p["text"]) - F.length(F.ltrim(p["text"], F.lit("/_+-")))).otherwise(0)
        right = F.when(p["stop"] < c["stop"], F.length(p["text"]) - F.length(F.rtrim(p["text"], F.lit("/_+-")))).otherwise(0)
        return _part(p, p["start"] + left, F.greatest(p["start"] + left, p["stop"] - right))

    pieces = F.transform(F.aggregate(edge, first, step, lambda s: s["out"]), trimmed)
    return F.when(F.size(over) == 0, F.array(c)).otherwise(F.filter(pieces, lambda p: p["stop"] - p["start"] >= LEAST)).cast(spans.SPAN)


def _random(c: Column, model: list[float], margin: float) -> Column:
    """The candidate where it is random as a whole, else its random stretches."""
    inside = F.transform(stretches(c["text"], model, margin), lambda s: _part(c, c["start"] + s["start"], c["start"] + s["stop"]))
    return F.when(ratio(c["text"], model) > margin, F.array(c)).otherwise(inside).cast(spans.SPAN)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row per row of ``docs``: key, spans of each known form, and ``random``: spans that only the models tell."""
    column = F.coalesce(F.col(text), F.lit(""))
    candidates = spans.found(column, column.rlike("[A-Za-z0-9+/_-]{20}"), CANDIDATE)
    every = F.concat(*KINDS)
    free = F.flatten(F.transform("__candidates", lambda c: _cut(c, every)))
    found = written(docs.select(key, *(c.alias(k) for k, c in known(F.col(text)).items()), candidates.alias("__candidates")).select(key, *KINDS, free.alias("__free")), "secrets")
    model = train(docs, key, text)
    return found.select(key, *KINDS, F.flatten(F.transform("__free", lambda s: _random(s, model, margin))).alias("random"))
