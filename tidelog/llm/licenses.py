"""Licence scans by ordered signature rules, in native expressions.

A rule is a regular expression over words: a text becomes its lower-case words
joined by single blanks, so that rules need not care for line breaks, comment
signs or punctuation. A rule has a keyword, a word that every match of it holds;
it is tried only on texts in which the keyword stands. Every word carries its
number in the joined text (``apache_0 license_1``), so a match tells its own place,
and finding places takes linear time.

Detections overlap: "licensed under the apache license version 2 0" holds a
grant, a title and a mention. They are put in order, and one that lies inside
another of higher priority, or inside a longer one of the same priority, is
suppressed. Base phrases are never suppressed. A running maximum of the ends of
earlier detections decides this for all of them in one pass, so texts with very
many detections stay cheap.

Defined results: null text counts as empty; no word, no detection: empty strings,
score 0. Repeated rows are treated alike, extra columns are ignored, a null doc_id
stays null. Words are runs of ASCII letters, digits and anything beyond ASCII.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .scan import let, running_max

#: Of lower-cased texts. Said by what a word holds: the matcher is an order of
#: magnitude slower on a class that says what it does not hold.
WORDS = r"[0-9a-z\x{80}-\x{10FFFF}]++"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Priorities: tags and grants name a licence for certain, titles and known
#: sentences nearly so, mentions are hints.
CERTAIN, TITLE, MENTION = 0, 1, 2
CONFIDENCE = {CERTAIN: 1.0, TITLE: 0.9, MENTION: 0.5}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str  # a word of every match
    pattern: str  # over words set apart by single blanks
    priority: int
    base: bool = False


#: Base phrases and their labels.
BASE = (
    Rule("cc-by", "cc", "cc by", MENTION, True),
    Rule("gpl", "public", "general public license", MENTION, True),
    Rule("reserved", "rights", "all rights reserved", MENTION, True),
)

#: Licences: label, keyword, title as a rule's pattern, identifier's words in tags.
LICENCES = (
    ("apache-1.1", "apache", "apache (?:software )?license (?:version )?(?:1 1|v1 1)", "apache 1 1"),
    ("apache-2.0", "apache", "apache (?:software )?license (?:version )?(?:2 0|v2 0|2|v2)", "apache 2 0"),
    ("mit", "mit", "(?:the )?mit license", "mit"),
    ("mit-0", "attribution", "mit no attribution", "mit 0"),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd bsd)(?: license)?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:bsd zero clause|zero clause bsd)(?: license)?", "0bsd"),
    ("isc", "isc", "isc license", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)? license", "zlib"),
    ("gpl-1.0", "gnu", "gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version 1|v1)(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "gnu", "gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version 2|v2)(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "gnu", "gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version 3|v3)(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.0", "gnu", "gnu library general public license (?:version |v)?2(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "gnu", "gnu lesser general public license (?:version 2|v2) 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "gnu", "gnu lesser general public license (?:version 3|v3)(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public license (?:version 3|v3)(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", "documentation", "gnu free documentation license (?:version )?1 3", "gfdl 1 3(?: only| or later)?"),
    ("gfdl-1.2", "documentation", "gnu free documentation license (?:version )?1 2", "gfdl 1 2(?: only| or later)?"),
    ("mpl-1.0", "mozilla", "mozilla public license (?:version )?(?:1 0|v1 0)", "mpl 1 0"),
    ("mpl-1.1", "mozilla", "mozilla public license (?:version )?(?:1 1|v1 1)", "mpl 1 1"),
    ("mpl-2.0", "mozilla", "mozilla public license (?:version )?(?:2 0|v2 0|v 2 0)", "mpl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public license (?:version )?(?:v )?(?:1 0|v1 0)", "epl 1 0"),
    ("epl-2.0", "eclipse", "eclipse public license (?:version )?(?:v )?(?:2 0|v2 0)", "epl 2 0"),
    ("cddl-1.0", "cddl", "common development and distribution license (?:cddl )?(?:version )?1 0", "cddl 1 0"),
    ("cddl-1.1", "cddl", "common development and distribution license (?:cddl )?(?:version )?1 1", "cddl 1 1"),
    ("cpl-1.0", "common", "common public license(?: version)? 1 0", "cpl 1 0"),
    ("ipl-1.0", "ibm", "ibm public license(?: version)? 1 0", "ipl 1 0"),
    ("artistic-1.0", "artistic", "artistic license (?:version )?1 0", "artistic 1 0"),
    ("artistic-2.0", "artistic", "artistic license (?:version )?2 0", "artistic 2 0"),
    ("bsl-1.0", "boost", "boost software license(?: version)? 1 0", "bsl 1 0"),
    ("busl-1.1", "business", "business source license (?:version )?1 1", "busl 1 1"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "fuck", "do what the fuck you want to public license", "wtfpl"),
    ("cc0-1.0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by-3.0", "cc", "cc by 3 0", "cc by 3 0"),
    ("cc-by-4.0", "cc", "cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-3.0", "cc", "cc by sa 3 0", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc", "cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "cc", "cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc", "cc by nd 4 0", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc", "cc by nc sa 4 0", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc", "cc by nc nd 4 0", "cc by nc nd 4 0"),
    ("odbl-1.0", "odbl", "open (?:data commons open )?database license odbl", "odbl 1 0"),
    ("odc-by-1.0", "commons", "open data commons attribution license", "odc by 1 0"),
    ("pddl-1.0", "pddl", "public domain dedication and license pddl", "pddl 1 0"),
    ("ofl-1.1", "sil", "sil open font license(?: version)? 1 1", "ofl 1 1"),
    ("psf-2.0", "python", "(?:psf|python software foundation) license (?:agreement|version 2)(?: for python)?", "psf 2 0"),
    ("ruby", "ruby", "ruby license", "ruby"),
    ("php-3.0", "php", "php license(?: version)? 3 0", "php 3 0"),
    ("php-3.01", "php", "php license(?: version)? 3 01", "php 3 01"),
    ("postgresql", "postgresql", "postgresql license", "postgresql"),
    ("openssl", "openssl", "openssl license", "openssl"),
    ("sleepycat", "sleepycat", "sleepycat license", "sleepycat"),
    ("w3c", "w3c", "w3c software (?:notice and )?license", "w3c"),
    ("x11", "x11", "x11 license", "x11"),
    ("vim", "vim", "vim license", "vim"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source license", "ncsa"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl"),
    ("eupl-1.1", "european", "european union public licen[cs]e (?:eupl )?(?:version )?(?:v )?1 1", "eupl 1 1"),
    ("eupl-1.2", "european", "european union public licen[cs]e (?:eupl )?(?:version )?(?:v )?1 2", "eupl 1 2"),
    ("cecill-2.1", "cecill", "cecill (?:free software )?license(?: agreement)?(?: version)? 2 1", "cecill 2 1"),
    ("cecill-b", "cecill", "cecill b license", "cecill b"),
    ("osl-3.0", "open", "open software license (?:version |v )?3 0", "osl 3 0"),
    ("afl-3.0", "academic", "academic free license (?:version |v )?3 0", "afl 3 0"),
    ("lppl-1.3c", "latex", "latex project public license(?: version)?(?: 1 3c)?", "lppl 1 3c"),
    ("mulanpsl-2.0", "mulan", "mulan (?:psl|permissive software license)(?: v2| version 2)?", "mulanpsl 2 0"),
    ("upl-1.0", "universal", "universal permissive license(?: v| version)? 1 0", "upl 1 0"),
    ("sspl-1.0", "side", "server side public license", "sspl 1 0"),
    ("elastic-2.0", "elastic", "elastic license(?: version)?(?: 2 0)?", "elastic 2 0"),
    ("blueoak-1.0.0", "oak", "blue oak model license", "blueoak 1 0 0"),
)

#: Sentences by which the body of a licence, or a notice, is known.
SENTENCES = (
    Rule("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy", TITLE),
    Rule("mit", "noninfringement", "fitness for a particular purpose and noninfringement", MENTION),
    Rule("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", TITLE),
    Rule("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", TITLE),
    Rule("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software", TITLE),
    Rule("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software", TITLE),
    Rule("apache-2.0", "compliance", "you may not use this file except in compliance with the license", TITLE),
    Rule("apache-2.0", "apache", "www apache org licenses license 2 0", CERTAIN),
    Rule("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu", TITLE),
    Rule("gpl", "gnu", "gnu (?:general public license|gpl)", MENTION),
    Rule("gpl", "gplv2", "gplv2(?: or later)?", TITLE),
    Rule("gpl-3.0", "gplv3", "gplv3(?: or later)?", TITLE),
    Rule("lgpl", "lesser", "lesser general public license", TITLE),
    Rule("lgpl", "lgpl", "lgpl", MENTION),
    Rule("agpl", "affero", "affero general public license", TITLE),
    Rule("agpl", "agpl", "agpl", MENTION),
    Rule("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license", CERTAIN),
    Rule("mpl", "mozilla", "mozilla public license", MENTION),
    Rule("epl", "eclipse", "eclipse public license", MENTION),
    Rule("apache", "apache", "apache license", MENTION),
    Rule("bsl-1.0", "boost", "boost software license", MENTION),
    Rule("zlib", "warranty", "this software is provided as is without any express or implied warranty", TITLE),
    Rule("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", CERTAIN),
    Rule("public-domain", "domain", "(?:released into|dedicated to|placed in|in) the public domain", TITLE),
    Rule("public-domain", "domain", "public domain", MENTION),
    Rule("cc", "creative", "creative commons", MENTION),
    Rule("cc", "creativecommons", "creativecommons org licenses", TITLE),
    Rule("cc-by", "creative", "creative commons attribution(?: \\d 0)?(?: international| unported| generic)?", TITLE),
    Rule("cc-by-sa", "creative", "creative commons attribution (?:sharealike|share alike)", TITLE),
    Rule("cc-by-nc", "creative", "creative commons attribution (?:noncommercial|non commercial)", TITLE),
    Rule("cc-by-sa", "cc", "cc by sa", MENTION),
    Rule("cc-by-nc", "cc", "cc by nc", MENTION),
    Rule("cc-by-nd", "cc", "cc by nd", MENTION),
    Rule("copyright", "copyright", "copyright (?:c |© )?(?:19|20)\\d\\d", TITLE),
    Rule("copyright", "copyright", "copyright", MENTION),
    Rule("reserved", "rights", "some rights reserved", TITLE),
    Rule("proprietary", "proprietary", "(?:proprietary and confidential|confidential and proprietary)", TITLE),
    Rule("proprietary", "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)", TITLE),
    Rule("proprietary", "permission", "without (?:the )?(?:prior |express )?written permission", MENTION),
    Rule("commercial", "commercial", "(?:for non commercial use only|not for commercial use|commercial license)", TITLE),
    Rule("eula", "agreement", "end user license agreement", TITLE),
)

#: Forms in which a licence is granted or linked to; {} is its title or identifier.
TAGS = ("spdx license identifier {}", "opensource org licenses {}", "spdx org licenses {}")
GRANTS = "(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?{}"


def _rules() -> tuple[Rule, ...]:
    rules = list(BASE)
    for label, keyword, title, identifier in LICENCES:
        rules += [Rule(label, "licenses" if "licenses" in form else "spdx", form.format(f"(?:{identifier})"), CERTAIN) for form in TAGS]
        rules.append(Rule(label, keyword, GRANTS.format(f"(?:{title})"), CERTAIN))
        rules.append(Rule(label, keyword, title, TITLE))
    return (*rules, *SENTENCES)


#: In order: of rules with equal spans and priorities the first one wins.
RULES = _rules()


def compiled(pattern: str) -> str:
    """The pattern over numbered words: ``a b`` becomes ``a_<n> b_<n>``."""
    return r"(?<![^ ])(?:" + pattern.replace(" ", r"_[0-9]++ ") + r")_[0-9]++(?![^ ])"


def _literal(rules: tuple[Rule, ...]) -> Column:
    """The rules as one constant: an array of structs, folded before it runs."""
    rows = [{"order": i, "label": r.label, "keyword": r.keyword, "pattern": compiled(r.pattern), "priority": r.priority, "base": r.base} for i, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<order:int,label:string,keyword:string,pattern:string,priority:int,base:boolean>>")


def _number(text: Column, last: bool) -> Column:
    return F.regexp_extract(text, "_([0-9]+)$" if last else "^[^ _]+_([0-9]+)", 1).cast("int")


def _detections(numbered: Column, present: Column, rules: Column) -> Column:
    """All detections, in the order of (start, longest, priority, rule)."""

    def of_rule(rule: Column) -> Column:
        found = F.regexp_extract_all(numbered, rule["pattern"], F.lit(0))
        return F.transform(
            found,
            lambda m: F.struct(
                _number(m, False).alias("start"), (-1 - _number(m, True)).alias("minus_end"), rule["priority"].alias("priority"),
                rule["order"].alias("order"), rule["label"].alias("label"), rule["base"].alias("base"),
            ),
        )

    tried = F.filter(rules, lambda r: F.array_contains(present, r["keyword"]))
    return F.array_sort(F.flatten(F.transform(tried, of_rule)))


def _kept(detections: Column) -> Column:
    """The detections without those that lie inside another of higher priority,
    or inside an earlier one of the same priority."""

    def ends(all_of_them: Column, priority: int) -> Column:
        return running_max(F.transform(all_of_them, lambda d: F.when(d["priority"] <= priority, -d["minus_end"]).otherwise(0)))

    def use(all_of_them: Column) -> Column:
        by_priority = F.array(*[ends(all_of_them, p) for p in sorted(CONFIDENCE)])
        return let(
            by_priority,
            lambda reach: F.filter(
                all_of_them,
                # What comes earlier starts no later: it holds this one if it ends no sooner.
                lambda d, i: d["base"] | (F.when(i > 0, F.get(F.get(reach, d["priority"]), i - 1)).otherwise(0) < -d["minus_end"]),
            ),
        )

    return let(detections, use)


def find_licenses(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, detections: array of (label, start, end, confidence, base),
    words from 0, end exclusive, of every whole text."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules})])
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)).alias("words"))
    read = read.withColumn("present", F.array_intersect("words", keywords))
    numbered = F.array_join(F.transform("words", lambda w, i: F.concat(w, F.lit("_"), i.cast("string"))), " ")
    none = F.array().cast("array<struct<start:int,minus_end:int,priority:int,order:int,label:string,base:boolean>>")
    found = let(numbered, lambda n: _kept(_detections(n, F.col("present"), _literal(rules))))
    confidence = F.array(*[F.lit(CONFIDENCE[p]) for p in sorted(CONFIDENCE)])
    given = F.transform(
        F.when(F.size("present") > 0, found).otherwise(none),
        lambda d: F.struct(d["label"].alias("label"), d["start"].alias("start"), (-d["minus_end"]).alias("end"), F.get(confidence, d["priority"]).alias("confidence"), d["base"].alias("base")),
    )
    return read.select("doc_id", F.size("words").cast("long").alias("n_words"), given.alias("detections"))
