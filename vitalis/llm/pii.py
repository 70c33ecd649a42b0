"""Personal data: entities by pattern, and the terms that give them away.

Entities (e-mail and IP addresses, card and phone numbers) are found by pattern.  A term that stands in a text with an entity can
disclose it even when the entity itself is masked, however far from it.  How strongly is estimated from co-occurrence in the whole corpus: with
IC(c) = log2(N / n(c)) the information of entity c and PMI(c; t) = log2(N n(c, t) / (n(c) n(t))) what term t says about it,
a term is disclosing where PMI(c; t) >= ``threshold`` * IC(c): at 1 the term occurs only with the entity, and gives it away
in full.  N, n(c), n(t) and n(c, t) all count different texts, so that copies neither prove nor hide anything.  Pairs seen in fewer than ``support`` different texts say too little and are left alone.

Entities are generalised to their kind, disclosing terms to <TERM>, at every place of each text that holds the entity; a term that gives its entity away in full is removed.

All steps are DataFrame functions.  Only texts with entities take part in the co-occurrence joins, once for all copies; copies go
and the counts of words are summed in the map tasks before their shuffles.

Defined cases: null and empty texts have no spans; repeated rows are treated alike (joins are on id and text hash, null-safe);
where spans overlap, the masked text has one mark for all of them.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.llm import spans
from vitalis.llm.scratch import written

KINDS = ("email", "ip", "card", "phone")
#: Words of ASCII letters and digits and of non-ASCII characters, four or more long.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{4,}+"
SUPPORT = 3
THRESHOLD = 0.9

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _is_card(s: Column) -> Column:
    digits = F.regexp_replace(s["text"], "[^0-9]", "")
    return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))


def entities(text: Column) -> dict[str, Column]:
    """Spans of each kind; the patterns of the contract, rewritten so that no run of characters is tried twice.

    A dot that no domain label surrounds becomes % (which may stand in a mailbox name as a dot may) and a blank or hyphen that
    no two digits surround becomes x; then domains and card numbers are runs of one character class."""
    text = F.coalesce(text, F.lit(""))
    dots = F.regexp_replace(text, r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])", "%")
    gaps = F.regexp_replace(text, r"(?<![0-9])[\x20-]|[\x20-](?![0-9])", "x")
    return {
        "email": spans.found(dots, F.contains(text, F.lit("@")), r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"),
        "ip": spans.found(text, text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda s: s["text"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        "card": spans.found(gaps, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), r"[0-9][0-9\x20-]{11,}+", _is_card),
        "phone": spans.found(text, F.contains(text, F.lit("+")), r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: F.length(F.regexp_replace(s["text"], "[^0-9]", "")).between(9, 15)),
    }


def _possible(text: Column) -> Column:
    """False only where no entity can be."""
    return F.coalesce(F.contains(text, F.lit("@")) | F.contains(text, F.lit("+")) | text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]|[0-9](?:[\x20-]?[0-9]){11}"), F.lit(False))


def _normal(kind: str, s: Column) -> Column:
    """The entity that a span names, however it is written."""
    plain = F.lower(s["text"]) if kind in ("email", "ip") else F.regexp_replace(s["text"], "[^0-9]", "")
    return F.concat(F.lit(kind + ":"), plain)


def _words(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, __hash (of the text), an array of spans for each kind, __entities (the different ones of the text) and __text, which
    is null where there are none."""
    column = F.col(text)
    base = docs.select(key, column.alias("__text"), F.xxhash64(column).alias("__hash"), *(c.alias(k) for k, c in entities(column).items()))

    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: _normal(kind, s))

    base = base.withColumn("__entities", F.array_distinct(F.concat(*map(named, KINDS))))
    return base.select(key, "__hash", *KINDS, "__entities", F.when(F.size("__entities") > 0, F.col("__text")).alias("__text"))


def _pairs(scanned: DataFrame, support: int) -> DataFrame:
    """entity, n_c, term, n_ct of the pairs that ``support`` different texts have, wherever in the text."""
    texts = scanned.where(F.size("__entities") > 0).dropDuplicates(["__hash"])
    mentions = texts.select("__hash", F.explode("__entities").alias("entity"))
    known = mentions.groupBy("entity").agg(F.count("*").alias("n_c")).where(F.col("n_c") >= support)
    known = mentions.join(known, "entity").groupBy("__hash").agg(F.collect_list(F.struct("entity", "n_c")).alias("known"))
    each = texts.select("__hash", "__text").join(known, "__hash").select(F.explode("known").alias("c"), _words(F.col("__text")).alias("words"))
    each = each.select("c.entity", "c.n_c", F.explode("words").alias("term"))
    return each.groupBy("entity", "n_c", "term").agg(F.count("*").alias("n_ct")).where(F.col("n_ct") >= support)


def disclosing(scanned: DataFrame, docs: DataFrame, text: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """entity, term, pmi, ic and whole (the term occurs with the entity only) of the pairs above the threshold."""
    different = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
    total = float(different.select("__hash").distinct().count())
    words = different.dropDuplicates(["__hash"]).select(F.explode(_words(F.col("__text"))).alias("term"))
    scored = _pairs(scanned, support).join(words.groupBy("term").agg(F.count("*").alias("n_t")), "term")
    scored = scored.withColumn("pmi", F.log2(F.lit(total) * F.col("n_ct") / (F.col("n_c") * F.col("n_t")))).withColumn("ic", F.log2(F.lit(total) / F.col("n_c")))
    return scored.where("ic > 0").where(F.col("pmi") >= threshold * F.col("ic")).select("entity", "term", "pmi", "ic", (F.col("n_ct") >= F.col("n_t")).alias("whole"))


def _occurrences(text: Column, terms: Column, whole: Column) -> Column:
    """Spans of every occurrence of ``terms`` in a text; their text says "whole" where the term is one of ``whole``."""
    matches = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    items = F.filter(F.arrays_zip(matches.alias("match"), F.split(text, TERM, -1).alias("before")), lambda x: x["match"].isNotNull())

    def span(at: Column, x: Column) -> Column:
        begin, term = at + F.length(x["before"]), F.lower(x["match"])
        one = F.struct(begin.alias("start"), (begin + F.length(x["match"])).alias("stop"), F.when(F.array_contains(whole, term), F.lit("whole")).otherwise(F.lit("part")).alias("text"))
        return F.when(F.array_contains(terms, term), F.array(one)).otherwise(spans.none())

    return spans.along(items, lambda x: F.length(x["before"]) + F.length(x["match"]), span, spans.SPAN)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: key, __hash, spans of each kind, and ``term``: spans of disclosing terms, wherever they stand
    in a text with their entity (their text says "whole" or "part").  A term inside an entity's span is left out."""
    scanned = written(scan(docs, key, text), "entities")
    flagged = written(disclosing(scanned, docs, text, support, threshold).select("entity", "term", "whole"), "terms")
    flagged = flagged.groupBy("entity").agg(F.collect_set("term").alias("terms"), F.collect_set(F.when(F.col("whole"), F.col("term"))).alias("whole"))
    mentions = scanned.where(F.size("__entities") > 0).select(F.col(key).alias("__key"), F.col("__hash").alias("__h"), F.explode("__entities").alias("entity")).distinct()
    united = (F.array_distinct(F.flatten(F.collect_list(c))).alias("__" + c) for c in ("terms", "whole"))
    hits = mentions.join(flagged, "entity").groupBy("__key", "__h").agg(*united)
    joined = scanned.join(hits, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__hash") == F.col("__h")), "left")
    every = F.concat(*KINDS)
    term = F.when(F.col("__terms").isNotNull(), _occurrences(F.col("__text"), F.col("__terms"), F.col("__whole"))).otherwise(spans.none())
    free = F.filter(term, lambda t: ~F.exists(every, lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"])))
    return joined.select(key, "__hash", *KINDS, free.alias("term"))


def _marked() -> Column:
    """Spans of all kinds with the text that takes their place, by start, the longest first."""
    parts = [F.transform(F.col(k), _mark(f"<{k.upper()}>")) for k in KINDS]
    parts.append(F.transform(F.col("term"), lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("minus"), s["stop"].alias("stop"), F.when(s["text"] == "whole", F.lit("")).otherwise(F.lit("<TERM>")).alias("mark"))))
    return F.array_sort(F.concat(*parts))


def _mark(mark: str):
    return lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("minus"), s["stop"].alias("stop"), F.lit(mark).alias("mark"))


def masked(text: Column, marks: Column) -> Column:
    """``text`` with each marked span replaced; overlapping spans share the mark of the first and longest."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, m: Column) -> Column:
        clear = m["start"] >= state["at"]
        out = F.when(clear, F.concat(state["out"], F.substring(text, state["at"] + 1, m["start"] - state["at"]), m["mark"])).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], m["stop"]).alias("at"), out.alias("out"))

    return F.aggregate(marks, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with entities and disclosing terms replaced in ``text``, all columns kept.  Only texts that may hold an entity
    are joined with their spans; the others are passed on as they are."""
    found = find(docs, key, text, support, threshold).select(F.col(key).alias("__key"), F.col("__hash").alias("__h"), _marked().alias("__marks")).where(F.size("__marks") > 0).dropDuplicates(["__key", "__h"])
    possible = _possible(F.col(text))
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__h"))
    hit = docs.where(possible).join(written(found, "marks"), same, "left")
    hit = hit.withColumn(text, F.when(F.col("__marks").isNotNull(), masked(F.col(text), F.col("__marks"))).otherwise(F.col(text))).select(docs.columns)
    return hit.unionByName(docs.where(~possible))
