"""License scan: ordered signature rules, gated by keywords, overlaps resolved by priority.

A rule stands on a keyword: a pattern for the words that end right before it, each with its blank (may
be none), and one for the words from it on.  Both are anchored at the keyword, so each keyword place and rule give at
most one detection, whose interval of words is known.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words looked at before and from a keyword on; no rule reaches further.
REACH = 16

#: The last one tells more than its own words: it hides nothing that lies within it.
BASE, TAGGED, GRANTED, NAMED, MENTIONED, EXPRESSED = range(6)
CONFIDENCE = {BASE: 1.0, TAGGED: 0.95, GRANTED: 0.9, NAMED: 0.7, MENTIONED: 0.5, EXPRESSED: 0.5}
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    keyword: str
    before: str
    onward: str
    label: str
    priority: int


#: Phrases that always count, wherever they stand.
BASE_RULES = (
    Rule("license", "under the mit ", "license", "mit", BASE),
    Rule("apache", "", "apache license version 2", "apache-2", BASE),
    Rule("cc", "", "cc by nc", "cc-by-nc", BASE),
)

#: label; keyword; pattern of the name before the keyword; name from the keyword on; SPDX words.
FAMILIES = (
    ("apache-2", "apache", "", "apache (?:software )?(?:license )?(?:version |v)?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "", "apache (?:software )?(?:license )?(?:version |v)?1 1", "apache 1 1"),
    ("apache-1.0", "apache", "", "apache (?:software )?(?:license )?(?:version |v)?1 0", "apache 1 0"),
    ("gpl-3", "general", "gnu ", "general public licen[cs]e (?:version |v)?3(?: 0)?", "gpl 3 0"),
    ("gpl-2", "general", "gnu ", "general public licen[cs]e (?:version |v)?2(?: 0)?", "gpl 2 0"),
    ("gpl-1", "general", "gnu ", "general public licen[cs]e (?:version |v)?1(?: 0)?", "gpl 1 0"),
    ("gpl-3", "gplv3", "(?:gnu )?", "gplv3", "gpl 3 0 only"),
    ("gpl-2", "gplv2", "(?:gnu )?", "gplv2", "gpl 2 0 only"),
    ("gpl-3", "gpl", "(?:gnu )?", "gpl (?:version |v)?3", "gpl 3 0 or later"),
    ("gpl-2", "gpl", "(?:gnu )?", "gpl (?:version |v)?2", "gpl 2 0 or later"),
    ("lgpl-3", "lesser", "(?:gnu )?", "lesser general public licen[cs]e (?:version |v)?3(?: 0)?", "lgpl 3 0"),
    ("lgpl-2.1", "lesser", "(?:gnu )?", "lesser general public licen[cs]e (?:version |v)?2 1", "lgpl 2 1"),
    ("lgpl-2", "library", "gnu ", "library general public licen[cs]e(?: version 2)?", "lgpl 2 0"),
    ("lgpl-3", "lgplv3", "", "lgplv3", "lgpl 3 0 only"),
    ("lgpl-2.1", "lgpl", "", "lgpl (?:version |v)?2 1", "lgpl 2 1 only"),
    ("agpl-3", "affero", "(?:gnu )?", "affero general public licen[cs]e(?: (?:version |v)?3(?: 0)?)?", "agpl 3 0"),
    ("agpl-3", "agplv3", "", "agplv3", "agpl 3 0 only"),
    ("gfdl-1.3", "documentation", "gnu free ", "documentation licen[cs]e(?: (?:version |v)?1 3)?", "gfdl 1 3"),
    ("mpl-2", "mozilla", "", "mozilla public licen[cs]e (?:version |v)?2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", "mozilla", "", "mozilla public licen[cs]e (?:version |v)?1 1", "mpl 1 1"),
    ("epl-2", "eclipse", "", "eclipse public licen[cs]e (?:version |v)?2(?: 0)?", "epl 2 0"),
    ("epl-1", "eclipse", "", "eclipse public licen[cs]e (?:version |v)?1(?: 0)?", "epl 1 0"),
    ("eupl-1.2", "eupl", "", "eupl(?: (?:version |v)?1 2)?", "eupl 1 2"),
    ("cddl-1", "cddl", "", "cddl(?: (?:version |v)?1 0)?", "cddl 1 0"),
    ("cpl-1", "common", "", "common public licen[cs]e(?: (?:version |v)?1 0)?", "cpl 1 0"),
    ("bsd-2", "bsd", "(?:simplified|2 clause|two clause) ", "bsd", "bsd 2 clause"),
    ("bsd-3", "bsd", "(?:modified|revised|new|3 clause|three clause) ", "bsd", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:original|4 clause|four clause) ", "bsd", "bsd 4 clause"),
    ("bsd-2", "bsd", "", "bsd (?:2|two) clause", "bsd 2 clause patent"),
    ("bsd-3", "bsd", "", "bsd (?:3|three) clause", "bsd 3 clause clear"),
    ("0bsd", "0bsd", "", "0bsd", "0bsd"),
    ("isc", "isc", "", "isc licen[cs]e", "isc"),
    ("zlib", "zlib", "", "zlib(?: libpng)?(?: licen[cs]e)?", "zlib"),
    ("boost-1", "boost", "", "boost software licen[cs]e(?: (?:version |v)?1 0)?", "bsl 1 0"),
    ("unlicense", "unlicense", "(?:the )?", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "", "wtfpl(?: version 2)?", "wtfpl"),
    ("artistic-2", "artistic", "", "artistic licen[cs]e (?:version )?2(?: 0)?", "artistic 2 0"),
    ("artistic-1", "artistic", "", "artistic licen[cs]e(?: (?:version )?1(?: 0)?)?", "artistic 1 0"),
    ("psf-2", "psf", "", "psf licen[cs]e(?: (?:version )?2)?", "psf 2 0"),
    ("python-2", "python", "", "python (?:software foundation )?licen[cs]e(?: (?:version )?2)?", "python 2 0"),
    ("php-3", "php", "", "php licen[cs]e(?: (?:version )?3 01)?", "php 3 01"),
    ("openssl", "openssl", "", "openssl licen[cs]e", "openssl"),
    ("ofl-1.1", "sil", "", "sil open font licen[cs]e(?: (?:version )?1 1)?", "ofl 1 1"),
    ("ms-pl", "microsoft", "", "microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", "microsoft", "", "microsoft reciprocal licen[cs]e", "ms rl"),
    ("postgresql", "postgresql", "", "postgresql licen[cs]e", "postgresql"),
    ("odbl-1", "odbl", "", "odbl(?: (?:version |v)?1 0)?", "odbl 1 0"),
    ("mit", "license", "(?:the )?(?:mit|expat|x11) ", "licen[cs]e", "mit"),
    ("mit", "licence", "(?:the )?(?:mit|expat|x11) ", "licence", "mit 0"),
    ("proprietary", "reserved", "all rights ", "reserved", "licenseref proprietary"),
    ("public-domain", "domain", "(?:in|into|to) the public ", "domain", "licenseref public domain"),
)
#: Creative Commons licenses: their elements, in words.
CREATIVE = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
CREATIVE_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
LONG_ELEMENTS = {
    "by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?derivatives?(?: works)?",
}
#: Sentences of the licenses' own texts and of the notices that go with them, and their addresses.
TEXT_RULES = (
    Rule("hereby", "permission is ", "hereby granted free of charge to any person obtaining a copy", "mit", GRANTED),
    Rule("purpose", "permission to use copy modify and(?: or)? distribute this software for any ",
         "purpose with or without fee is hereby granted", "isc", GRANTED),
    Rule("redistribution", "", "redistribution and use in source and binary forms with or without modification", "bsd", GRANTED),
    Rule("neither", "", r"neither the names? of (?:\S+ ){1,5}nor the names?", "bsd-3", GRANTED),
    Rule("advertising", "all ", "advertising materials mentioning features or use of this software", "bsd-4", GRANTED),
    Rule("express", "provided as is without any ", "express or implied warranty", "zlib", MENTIONED),
    Rule("unencumbered", "this is free and ", "unencumbered software released into the public domain", "unlicense", GRANTED),
    Rule("foundation", "gnu general public licen[cs]e as published by the free software ", "foundation (?:either )?version 3", "gpl-3", GRANTED),
    Rule("foundation", "gnu general public licen[cs]e as published by the free software ", "foundation (?:either )?version 2", "gpl-2", GRANTED),
    Rule("foundation", "lesser general public licen[cs]e as published by the free software ", "foundation (?:either )?version 3", "lgpl-3", GRANTED),
    Rule("foundation", "lesser general public licen[cs]e as published by the free software ", "foundation (?:either )?version 2 1", "lgpl-2.1", GRANTED),
    Rule("foundation", "affero general public licen[cs]e as published by the free software ", "foundation (?:either )?version 3", "agpl-3", GRANTED),
    Rule("source", "subject to the terms of the mozilla public licen[cs]e v 2 0 this ", "source code form", "mpl-2", GRANTED),
    Rule("mozilla", "subject to the terms of the ", "mozilla public licen[cs]e v 2 0", "mpl-2", GRANTED),
    Rule("licensed", "(?:mit|expat|x11) ", "licensed", "mit", NAMED),
    Rule("licenced", "(?:mit|expat|x11) ", "licenced", "mit", NAMED),
    Rule("licensed", "bsd ", "licensed", "bsd", NAMED),
    Rule("licensed", "isc ", "licensed", "isc", NAMED),
    Rule("opensource", "", "opensource org licen[cs]es? mit", "mit", TAGGED),
    Rule("opensource", "", "opensource org licen[cs]es? bsd 3 clause", "bsd-3", TAGGED),
    Rule("opensource", "", "opensource org licen[cs]es? bsd 2 clause", "bsd-2", TAGGED),
    Rule("opensource", "", "opensource org licen[cs]es? isc", "isc", TAGGED),
    Rule("apache", "", "apache org licenses license 2 0", "apache-2", TAGGED),
    Rule("gnu", "", "gnu org licenses gpl 3 0", "gpl-3", TAGGED),
    Rule("gnu", "", "gnu org licenses (?:old licenses )?gpl 2 0", "gpl-2", TAGGED),
    Rule("gnu", "", "gnu org licenses lgpl 3 0", "lgpl-3", TAGGED),
    Rule("gnu", "", "gnu org licenses agpl 3 0", "agpl-3", TAGGED),
    Rule("mozilla", "", "mozilla org (?:en us )?mpl 2 0", "mpl-2", TAGGED),
    Rule("creativecommons", "", "creativecommons org publicdomain zero 1 0", "cc0-1", TAGGED),
)
#: Names that the short word MIT is put beside by AND, OR or WITH; alone it is no license.
PARTNERS = (
    ("apache", "apache(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?"), ("gpl", "gpl(?: version| v)? ?[23](?: 0)?"),
    ("bsd", "bsd(?: [234] clause)?"), ("mpl", "mpl 2(?: 0)?"), ("lgpl", "lgpl(?: v)? ?[23](?: [01])?"), ("unlicense", "unlicense"),
)
#: How a name is granted, named or mentioned: words before it, words after it, priority.
FRAMES = (
    (r"(?:licen[cs]ed|released|distributed|published|available|provided|offered) (?:\S+ ){0,2}?under"
     r" (?:the )?(?:terms of (?:the )?)?(?:a )?", "", GRANTED),
    (r"(?:subject to|governed by|covered by|in accordance with) (?:the )?(?:terms of (?:the )?)?", "", GRANTED),
    (r"under (?:the )?(?:terms of (?:the )?)?", " licen[cs]e", GRANTED),
    (r"(?:see|read|refer to|a copy of) (?:the )?", "", NAMED),
    ("", " licen[cs]e", NAMED),
    ("", "", MENTIONED),
)


def _framed(label: str, keyword: str, before: str, onward: str) -> list[Rule]:
    return [
        Rule(keyword, f"{lead}{before}", f"{onward}{tail}", label, priority)
        for lead, tail, priority in FRAMES
    ]


def all_rules() -> tuple[Rule, ...]:
    """Several hundred rules: base phrases, SPDX tags, and every name in every frame."""
    rules = [*BASE_RULES, *TEXT_RULES]
    tag, more = "spdx licen[cs]e identifier", r"(?:\S+ ){1,9}(?:and|or|with)"
    for keyword, name in PARTNERS:
        rules.append(Rule(keyword, "mit (?:and|or|with) ", keyword, "mit", EXPRESSED))
        rules.append(Rule(keyword, "", f"{name} (?:and|or|with) mit", "mit", EXPRESSED))
    for label, keyword, before, onward, spdx in FAMILIES:
        rules.append(Rule("spdx", "", f"{tag} {spdx}", label, TAGGED))
        rules.append(Rule("spdx", "", f"{tag} {more} {spdx}", label, EXPRESSED))
        rules += _framed(label, keyword, before, onward)
    for elements in CREATIVE:
        label = "cc-" + elements.replace(" ", "-")
        spoken = " ".join(LONG_ELEMENTS[e] for e in elements.split())
        for version in CREATIVE_VERSIONS:
            rules.append(Rule("spdx", "", f"spdx licen[cs]e identifier cc {elements} {version}", label, TAGGED))
            rules.append(Rule("cc", "", f"cc {elements} {version}", label, NAMED))
            rules.append(Rule("creativecommons", "", f"creativecommons org licenses {elements} {version}", label, TAGGED))
        rules += _framed(label, "cc", "", f"cc {elements}")
        rules += _framed(label, "creative", "", f"creative commons {spoken}")
    rules.append(Rule("spdx", "", "spdx licen[cs]e identifier cc0 1 0", "cc0-1", TAGGED))
    rules += _framed("cc0-1", "cc0", "", "cc0(?: 1 0)?")
    return tuple(rules)


def _literal(rules: tuple[Rule, ...]) -> Column:
    """Map from keyword to its rules; patterns get their anchors here."""
    by_keyword: dict[str, list[Rule]] = {}
    for rule in dict.fromkeys(rules):
        by_keyword.setdefault(rule.keyword, []).append(rule)
    text = lambda s: F.lit(s)
    entries = []
    for keyword, own in by_keyword.items():
        own_rules = F.array(*[F.struct(
            text(f"(?:^| )({r.before})$" if r.before else "").alias("before"),
            text(f"^({r.onward})(?= |$)").alias("onward"),
            text(r.label).alias("label"), F.lit(r.priority).alias("priority"),
        ) for r in own])
        entries += [F.lit(keyword), own_rules]
    return F.create_map(*entries)


def scan_licenses(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """``doc_id, n_words, detections, kept, best`` for every row of ``docs`` (``doc_id, text``).

    ``detections`` are all (start, end, priority, label) by word, end exclusive, sorted; ``kept`` the
    labels of those that no detection of the same or a better priority contains (the first of equal
    intervals counts); ``best`` is the best priority kept, null without any.  Null and empty texts
    have no words and no detections; null ids and repeated rows stay; other columns are ignored; a long
    text is looked at wherever a keyword stands, ``REACH`` words to each side; an empty table gives no row.  Everything happens within a row, in one pass without a shuffle.
    """
    rules = all_rules() if rules is None else rules
    keywords = sorted({r.keyword for r in rules})
    known = _literal(rules)
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _UPPER.lower())
    # The cheap gate: texts without any keyword are not looked at again.
    gate = F.lit(False)
    for keyword in keywords:
        gate = gate | F.col("lower").contains(keyword)
    words = F.regexp_extract_all("lower", F.lit(WORD), F.lit(0))
    base = (
        docs.select("doc_id", text.alias("lower"))
        .select("doc_id", gate.alias("gate"), words.alias("words"))
        .withColumn("n_words", F.size("words"))
    )
    places = F.when(
        F.col("gate") & (F.col("n_words") > 0),
        F.filter(F.sequence(F.lit(1), F.col("n_words")), lambda i: F.element_at("words", i).isin(keywords)),
    ).otherwise(F.array().cast("array<int>"))

    def detect(place: Column) -> Column:
        start = F.greatest(place - REACH, F.lit(1))
        seen = F.struct(
            F.concat(F.array_join(F.slice("words", start, place - start), " "), F.lit(" ")).alias("left"),
            F.array_join(F.slice("words", place, REACH), " ").alias("right"))

        def apply(rule: Column, at: Column) -> Column:
            left = F.call_function("regexp_extract", at["left"], rule["before"], F.lit(1))
            right = F.call_function("regexp_extract", at["right"], rule["onward"], F.lit(1))
            fits = (right != "") & ((rule["before"] == "") | F.call_function("rlike", at["left"], rule["before"]))
            lead = F.when((rule["before"] == "") | (left == ""), F.lit(0)).otherwise(F.size(F.split(F.trim(left), " ")))
            return F.when(fits, F.struct(
                (place - 1 - lead).alias("start"), (place - 1 + F.size(F.split(right, " "))).alias("end"),
                rule["priority"].alias("priority"), rule["label"].alias("label")))

        found = F.flatten(F.transform(F.array(seen), lambda at: F.transform(
            F.element_at(known, F.element_at("words", place)), lambda rule: apply(rule, at))))
        return F.filter(found, lambda d: d.isNotNull())

    state_type = "struct<ends:array<int>,labels:array<string>,best:int>"
    empty = F.struct(
        F.array(*[F.lit(-1)] * len(CONFIDENCE)).alias("ends"), F.array().alias("labels"),
        F.lit(None).alias("best")).cast(state_type)

    def resolve(state: Column, d: Column) -> Column:
        # Sorted by start, longer first: an earlier one that ends no sooner contains this one.
        covered = F.array_max(F.slice(state["ends"], F.lit(1), d["priority"] + 1)) >= d["end"]
        ends = F.transform(state["ends"], lambda e, p: F.when(p == d["priority"], F.greatest(e, d["end"])).otherwise(e))
        return F.when(covered, state).otherwise(F.struct(
            ends.alias("ends"), F.array_union(state["labels"], F.array(d["label"])).alias("labels"),
            F.least(state["best"], d["priority"]).alias("best"))).cast(state_type)

    sort_key = lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("longer"), d["priority"].alias("priority"), d["label"].alias("label"))
    ordered = F.transform(
        F.array_sort(F.array_distinct(F.transform(F.flatten(F.transform("places", detect)), sort_key))),
        lambda k: F.struct(k["start"].alias("start"), (-k["longer"]).alias("end"),
                           k["priority"].alias("priority"), k["label"].alias("label")))
    return (
        base.withColumn("places", places)
        .select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.when(
            F.size("places") > 0, ordered).otherwise(
                F.array().cast("array<struct<start:int,end:int,priority:int,label:string>>")).alias("detections"))
        .withColumn("resolved", F.aggregate("detections", empty, resolve))
        .select("doc_id", "n_words", "detections", F.array_sort("resolved.labels").alias("kept"),
                F.col("resolved.best").alias("best"))
    )
