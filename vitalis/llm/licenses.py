"""License scan: ordered signature rules over words.

A text becomes its words (A-Z lowered, everything but letters, digits and non-ASCII characters a bound), joined by single
blanks; a rule is a regex over that string, so rules do not care for case, punctuation or line breaks, and places are counted in
words.  Each rule names keywords without which it cannot match; v and digits may be joined to them ("gplv2", "apache2").  The
keywords of a text are found first, in one pass; only the rules of found keywords are tried.

Rules are ordered: families from the most to the least telling (``PRIORITY``), then as listed.  Where one detection lies
within another of the same or a higher priority, it is suppressed; of equal intervals the earlier rule's stays.  So
"gnu lesser general public license" suppresses the "general public license" inside it.

All steps are DataFrame functions on one row at a time: no shuffle.

Defined cases: null and empty texts have no words and no detections; repeated rows are treated alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.llm import spans

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BOUND = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that are always reported, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Weight of a detection in the score, by priority.
PRIORITY = {"text": (3, 1.0), "tag": (2, 0.95), "grant": (1, 0.9), "name": (0, 0.6)}

#: label, names (regex over lowered words), keyword that every name has, whether a bare name is telling.
LICENSES = (
    ("mit", r"mit|expat", "mit|expat", False),
    ("mit-0", r"mit (?:no attribution|0)", "mit", True),
    ("apache-2", r"(?:asf )?apache(?: software)?(?: license)?(?: version)?(?: v)? ?2(?: 0)?|asl 2(?: 0)?", "apache|asl", False),
    ("apache-1.1", r"apache(?: software)? license(?: version)? 1 1", "apache", True),
    ("apache-1.0", r"apache(?: software)? license(?: version)? 1 0", "apache", True),
    ("bsd-0-clause", r"(?:bsd zero clause|0 ?bsd|zero clause bsd|free public license 1 0 0)", "bsd|0bsd|zero|free", True),
    ("bsd-1-clause", r"(?:bsd 1 clause|1 clause bsd)", "bsd", True),
    ("bsd-2-clause", r"(?:bsd 2 clause|(?:2|two) clause bsd|(?:simplified|freebsd) bsd|free ?bsd)", "bsd|freebsd", False),
    ("bsd-3-clause", r"(?:bsd 3 clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)", "bsd", False),
    ("bsd-4-clause", r"(?:bsd 4 clause|(?:4|four) clause bsd|(?:original|old) bsd)", "bsd", False),
    ("bsd", r"bsd(?: style)?", "bsd", False),
    ("isc", r"isc|internet (?:systems|software) consortium", "isc|internet", False),
    ("gpl-1", r"(?:gnu )?(?:gpl|general public license)(?: version)? ?v?1(?: 0)?", "gpl|gnu|general", False),
    ("gpl-2", r"(?:gnu )?(?:gplv2|gpl(?: version)? ?v?2(?: 0)?|general public license(?: as published by the free software foundation)?(?: either)?(?: version)? ?v?2(?: 0)?)", "gpl|gplv2|gnu|general", False),
    ("gpl-3", r"(?:gnu )?(?:gplv3|gpl(?: version)? ?v?3(?: 0)?|general public license(?: as published by the free software foundation)?(?: either)?(?: version)? ?v?3(?: 0)?)", "gpl|gplv3|gnu|general", False),
    ("gpl", r"gnu (?:gpl|general public license)|gnu gpl", "gnu", True),
    ("lgpl-2", r"(?:gnu )?(?:lgpl|library general public license)(?: version)? ?v?2(?: 0)?", "lgpl|library", False),
    ("lgpl-2.1", r"(?:gnu )?(?:lgplv2 1|lgpl(?: version)? ?v?2 1|lesser general public license(?: version)? ?v?2 1)", "lgpl|lgplv2|lesser", False),
    ("lgpl-3", r"(?:gnu )?(?:lgplv3|lgpl(?: version)? ?v?3(?: 0)?|lesser general public license(?: version)? ?v?3(?: 0)?)", "lgpl|lgplv3|lesser", False),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public license|gnu lgpl", "lesser|library|lgpl", True),
    ("agpl-1", r"(?:affero gpl|affero general public license)(?: version)? ?v?1(?: 0)?", "affero", False),
    ("agpl-3", r"(?:gnu )?(?:agplv3|agpl(?: version)? ?v?3(?: 0)?|affero (?:gpl|general public license)(?: version)? ?v?3(?: 0)?)", "agpl|agplv3|affero", False),
    ("agpl", r"(?:gnu )?affero general public license|gnu agpl", "affero|agpl", True),
    ("gfdl-1.1", r"(?:gnu )?(?:gfdl|free documentation license)(?: version)? ?v?1 1", "gfdl|documentation", False),
    ("gfdl-1.2", r"(?:gnu )?(?:gfdl|free documentation license)(?: version)? ?v?1 2", "gfdl|documentation", False),
    ("gfdl-1.3", r"(?:gnu )?(?:gfdl|free documentation license)(?: version)? ?v?1 3", "gfdl|documentation", False),
    ("gfdl", r"gnu free documentation license", "documentation", True),
    ("mpl-1.0", r"(?:mpl|mozilla public license)(?: version)? ?v?1 0", "mpl|mozilla", False),
    ("mpl-1.1", r"(?:mpl|mozilla public license)(?: version)? ?v?1 1", "mpl|mozilla", False),
    ("mpl-2.0", r"(?:mpl|mozilla public license)(?: version)? ?v?2(?: 0)?", "mpl|mozilla", False),
    ("mpl", r"mozilla public license", "mozilla", True),
    ("epl-1.0", r"(?:epl|eclipse public license)(?: version)? ?v?1(?: 0)?", "epl|eclipse", False),
    ("epl-2.0", r"(?:epl|eclipse public license)(?: version)? ?v?2(?: 0)?", "epl|eclipse", False),
    ("epl", r"eclipse public license", "eclipse", True),
    ("edl-1.0", r"eclipse distribution license(?: version)? ?v?1 0", "eclipse", True),
    ("cddl-1.0", r"(?:cddl|common development and distribution license)(?: version)? ?v?1 0", "cddl|common", False),
    ("cddl-1.1", r"(?:cddl|common development and distribution license)(?: version)? ?v?1 1", "cddl|common", False),
    ("cddl", r"common development and distribution license", "common", True),
    ("cpl-1.0", r"common public license(?: version)? ?v?1 0", "common", True),
    ("ipl-1.0", r"ibm public license(?: version)? ?v?1 0", "ibm", True),
    ("cc0-1.0", r"(?:cc0(?: 1 0)?|cc zero|creative commons zero)(?: 1 0)?(?: universal)?", "cc0|cc|creative", True),
    ("cc-by-nc-nd", r"(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?)", "cc|creative", True),
    ("cc-by-nc-sa", r"(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)", "cc|creative", True),
    ("cc-by-nc", r"creative commons attribution non ?commercial", "creative", True),
    ("cc-by-nd", r"(?:cc|creative commons) (?:by nd|attribution no ?deriv(?:ative)?s?)", "cc|creative", True),
    ("cc-by-sa", r"(?:cc|creative commons) (?:by sa|attribution share ?alike)", "cc|creative", True),
    ("cc-by", r"(?:cc by|creative commons attribution)(?! (?:nc|nd|sa|non|no|share))", "cc|creative", True),
    ("cc-pd", r"creative commons public domain(?: mark| dedication)?", "creative", True),
    ("artistic-1.0", r"artistic license(?: version)? ?1(?: 0)?", "artistic", True),
    ("artistic-2.0", r"artistic license(?: version)? ?2(?: 0)?", "artistic", True),
    ("artistic", r"artistic license", "artistic", True),
    ("bsl-1.0", r"boost(?: software)? license(?: version)?(?: 1 0)?", "boost", True),
    ("busl-1.1", r"business source license(?: version)?(?: 1 1)?", "business", True),
    ("sspl-1.0", r"(?:sspl|server side public license)(?: version)?(?: v?1(?: 0)?)?", "sspl|server", True),
    ("elastic-2.0", r"elastic license(?: version)?(?: v?2(?: 0)?)?", "elastic", True),
    ("unlicense", r"unlicense", "unlicense", True),
    ("wtfpl", r"wtfpl|do what the fuck you want to public license", "wtfpl|fuck", True),
    ("zlib", r"zlib(?: libpng)?", "zlib", False),
    ("libpng", r"libpng(?: 2)?", "libpng", False),
    ("ofl-1.1", r"(?:sil )?(?:ofl|open font license)(?: version)?(?: 1 1)?", "ofl|font", False),
    ("python-2.0", r"(?:psf|python software foundation|python)", "psf|python", False),
    ("ruby", r"ruby", "ruby", False),
    ("php-3.01", r"php license(?: version)? 3 01", "php", True),
    ("php-3.0", r"php license(?: version)? 3 0", "php", True),
    ("postgresql", r"postgresql", "postgresql", False),
    ("openssl", r"openssl", "openssl", False),
    ("w3c", r"w3c(?: software)?(?: notice and)?", "w3c", False),
    ("eupl-1.1", r"(?:eupl|european union public licen[cs]e)(?: version)? ?v?1 1", "eupl|european", True),
    ("eupl-1.2", r"(?:eupl|european union public licen[cs]e)(?: version)? ?v?1 2", "eupl|european", True),
    ("ms-pl", r"(?:ms pl|microsoft public license)", "ms|microsoft", True),
    ("ms-rl", r"(?:ms rl|microsoft reciprocal license)", "ms|microsoft", True),
    ("osl-3.0", r"open software license(?: version)? ?v?3 0", "open", True),
    ("afl-3.0", r"academic free license(?: version)? ?v?3 0", "academic", True),
    ("ecl-2.0", r"educational community license(?: version)? ?2 0", "educational", True),
    ("ncsa", r"(?:ncsa|university of illinois ncsa)(?: open source)?", "ncsa", False),
    ("upl-1.0", r"universal permissive license(?: version)?(?: 1 0)?", "universal", True),
    ("odbl-1.0", r"(?:odbl|open database license)(?: version)?(?: v?1 0)?", "odbl|database", True),
    ("odc-by-1.0", r"(?:odc by|open data commons attribution license)(?: version)?(?: v?1 0)?", "odc|commons", True),
    ("pddl-1.0", r"(?:pddl|public domain dedication and license)(?: version)?(?: 1 0)?", "pddl|dedication", True),
    ("cecill-2.1", r"cecill(?: version)? 2 1", "cecill", True),
    ("cecill", r"cecill", "cecill", True),
    ("vim", r"vim license", "vim", True),
    ("json", r"json license", "json", True),
    ("beerware", r"beer ?ware license", "beer|beerware", True),
    ("openrail", r"(?:creativeml )?open ?rail(?: m)?", "openrail|open|creativeml", False),
    ("llama", r"llama [23](?: [0-9])? community license(?: agreement)?", "llama", True),
    ("polyform-nc", r"polyform noncommercial license(?: 1 0 0)?", "polyform", True),
)

#: Sentences of license texts and notices: label, regex, keyword.
TEXTS = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", "hereby|copyright"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd-3-clause", r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote", "neither"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising"),
    ("apache-2", r"you may not use this file except in compliance with the license", "compliance"),
    ("gpl", r"you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute"),
    ("lgpl", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license", "redistribute"),
    ("agpl", r"you can redistribute it and or modify it under the terms of the gnu affero general public license", "redistribute"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "granted"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse"),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license", "common"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("cc0-1.0", r"to the extent possible under law .{1,80}? has waived all copyright and related or neighboring rights", "waived"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "hereby"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license", "font"),
    ("public-domain", r"(?:placed|released|dedicated) (?:in|into|to) the public domain", "domain"),
    ("public-domain", r"(?:is|are) (?:hereby )?in the public domain", "domain"),
    ("proprietary", r"all rights reserved", "reserved"),
    ("proprietary", r"proprietary and confidential", "proprietary"),
    ("proprietary", r"unauthorized (?:copying|use|reproduction) (?:of this file )?.{0,40}?(?:is )?strictly prohibited", "unauthorized"),
    ("no-redistribution", r"may not be (?:copied|reproduced|redistributed)(?: or (?:copied|reproduced|redistributed))? without (?:prior |express )?(?:written )?permission", "permission"),
    ("non-commercial", r"(?:for )?non ?commercial (?:use|purposes) only", "commercial|noncommercial"),
    ("license", r"see (?:the )?(?:file )?licen[cs]e(?: file)?(?: txt| md)?(?: in the project root)? for (?:the )?(?:full )?(?:licen[cs]e|copyright) (?:information|terms|details)", "license|licence"),
)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    regex: str
    keywords: tuple[str, ...]
    family: str


def rules() -> tuple[Rule, ...]:
    """All rules in order: sentences, then for each license its tag, its grant and, if telling, its bare name."""
    out = [Rule(f"text-{i}", label, regex, tuple(key.split("|")), "text") for i, (label, regex, key) in enumerate(TEXTS)]
    for family, shape in (
        ("tag", r"(?:spdx license identifier|license (?:type|name|identifier|id)) (?:{0})(?: license)?(?: only| or later)?"),
        ("grant", r"(?:released|licensed|distributed|available|provided|published|covered|redistributed|used|offered|dual licensed)(?: to you)? under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:{0})(?: licen[cs]e)?(?: agreement)?"),
        ("grant", r"(?:under|subject to|governed by|in accordance with) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:{0}) licen[cs]e"),
        ("name", r"(?:{0})"),
        ("name", r"(?:{0}) licen[cs]e"),
    ):
        for label, names, keys, telling in LICENSES:
            if family != "name" or telling == (shape == r"(?:{0})"):
                out.append(Rule(f"{family}-{label}", label, shape.replace("{0}", names), tuple(keys.split("|")), family))
    return tuple(out)


def normalised(text: Column) -> Column:
    """The words of a text, each with a blank before and after."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, BOUND, " ")), F.lit(" "))


def _blanks(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _bounded(regex: str) -> str:
    """The regex between blanks that it does not consume."""
    return rf"(?<= )(?:{regex})(?= )"


def _places(words: Column, regex: Column) -> Column:
    """Spans (start, stop) in words of all matches in a normalised string."""
    matches = F.regexp_extract_all(words, regex, F.lit(0))
    items = F.filter(F.arrays_zip(matches.alias("match"), F.split(words, regex, -1).alias("before")), lambda x: x["match"].isNotNull())

    def span(at: Column, x: Column) -> Column:
        # blanks before the match, less the one that opens the string, are the words before it
        begin = at + _blanks(x["before"])
        return F.array(F.struct((begin - 1).alias("start"), (begin + _blanks(x["match"])).alias("stop")))

    return spans.along(items, lambda x: _blanks(x["before"]) + _blanks(x["match"]), span, "array<struct<start:int,stop:int>>")


DETECTION = "array<struct<start:int,stop:int,rank:int,priority:int,label:string,weight:double>>"


def _suppressed(found: Column) -> Column:
    """``found`` without detections that lie within one of the same or a higher priority.

    By start, the longest first, then by rank: whatever holds a detection comes before it.  So it is enough to keep the
    furthest end so far for each priority and above."""
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("minus"), d["rank"].alias("rank"), d.alias("d"))))
    levels = len(PRIORITY)

    def further(reach: Column, x: Column) -> Column:
        """The furthest ends by priority with this detection's."""
        return F.transform(reach, lambda r, p: F.when(p <= x["d"]["priority"], F.greatest(r, x["d"]["stop"])).otherwise(r))

    def kept(reach: Column, x: Column) -> Column:
        return F.when(F.get(reach, x["d"]["priority"]) >= x["d"]["stop"], F.array().cast(DETECTION)).otherwise(F.array(x["d"]))

    return spans.carried(ordered, F.array(*[F.lit(-1)] * levels), further, lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y)), kept, DETECTION)


def _stem(keyword: str) -> str:
    """The keyword without a version joined to it."""
    return re.sub(r"(?<=[a-z])v?[0-9]+$", "", keyword)


def _gate() -> str:
    """Regex of the stems of all keywords; behind a stem its word holds v and digits at most, so no word has two stems."""
    stems = sorted({_stem(k) for r in rules() for k in r.keywords}, key=lambda k: (-len(k), k))
    # a first letter and the letters after it: most words are turned away at their first character
    by_letter: dict[str, list[str]] = {}
    for k in stems:
        by_letter.setdefault(k[0], []).append(k[1:])
    return rf"(?<= )(?:{'|'.join(f'{a}(?:{"|".join(rest)})' for a, rest in sorted(by_letter.items()))})(?=v?[0-9]* )"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_words, ``base`` (spans in words and labels of the base phrases) and ``detections``
    (spans, label, priority and weight of what the rules leave after suppression)."""
    every = rules()
    table = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(r.label).alias("label"), F.lit(_bounded(r.regex)).alias("regex"), F.array(*map(F.lit, sorted(set(map(_stem, r.keywords))))).alias("keys"), F.lit(PRIORITY[r.family][0]).alias("priority"), F.lit(PRIORITY[r.family][1]).alias("weight")) for i, r in enumerate(every)))
    base = _bounded("|".join(p for p, _ in BASE))

    words = docs.select(key, normalised(F.col(text)).alias("__words"))
    words = words.withColumn("n_words", F.when(F.length("__words") <= 2, F.lit(0)).otherwise(_blanks(F.col("__words")) - 1).cast("long"))
    words = words.withColumn("__keys", F.array_distinct(F.regexp_extract_all("__words", F.lit(_gate()), F.lit(0))))
    phrases = F.regexp_extract_all("__words", F.lit(base), F.lit(0))
    places = _places(F.col("__words"), F.lit(base))

    def named(phrase: Column) -> Column:
        out = F.lit(None).cast("string")
        for p, name in BASE:
            out = F.when(phrase == p, F.lit(name)).otherwise(out)
        return out

    based = F.transform(F.arrays_zip(places.alias("at"), phrases.alias("phrase")), lambda x: F.struct(x["at"]["start"].alias("start"), x["at"]["stop"].alias("stop"), named(x["phrase"]).alias("label")))
    none = F.array().cast("array<struct<start:int,stop:int,label:string>>")
    words = words.withColumn("base", F.when(F.col("__words").rlike(base), based).otherwise(none))

    def of_rule(r: Column) -> Column:
        return F.transform(_places(F.col("__words"), r["regex"]), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), r["rank"].alias("rank"), r["priority"].alias("priority"), r["label"].alias("label"), r["weight"].alias("weight")))

    gated = F.filter(table, lambda r: F.arrays_overlap(r["keys"], F.col("__keys")))
    tried = F.flatten(F.transform(gated, of_rule)).cast(DETECTION)
    found = F.when(F.size("__keys") > 0, _suppressed(tried)).otherwise(F.array().cast(DETECTION))
    return words.withColumn("detections", found).select(key, "n_words", "base", "detections")


def labels(detections: Column) -> Column:
    """Distinct labels, sorted."""
    return F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"])))


def score(base: Column, detections: Column) -> Column:
    """Confidence from 0 to 1 that the text states a license: the greatest weight of its detections."""
    best = F.aggregate(detections, F.lit(0.0), lambda a, d: F.greatest(a, d["weight"]))
    return F.greatest(best, F.when(F.size(base) > 0, F.lit(PRIORITY["grant"][1])).otherwise(F.lit(0.0)))
