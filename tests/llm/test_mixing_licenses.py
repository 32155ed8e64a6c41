"""Source mixing and license scan against plain Python."""

import hashlib
import random
import re

from careflow.llm import licenses, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def mix_by_hand(rows):
    """{(doc_id, text): (size, source_size, target, taken)} with a queue over all documents."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size(r[1]) for r in rows if r[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, capped = {}, set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in capped)
        share = sum(weight[s] for s in sources if s not in capped)
        target = {s: 3.0 * total[s] if s in capped else rest / share * weight[s] for s in sources}
        above = {s for s in sources if s not in capped and target[s] > 3 * total[s]}
        if not above:
            break
        capped |= above
    turns = []
    for place, s in enumerate(sources):
        own = sorted(
            (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0], r[1]) for r in rows if r[3] == s)
        for again in range(3):
            upto = again * total[s]
            for draw, doc_id, text in own:
                upto += size(text)
                if size(text) and again * total[s] <= target[s]:
                    turns.append((upto / target[s], place, again, draw, doc_id, text))
    taken, used = {}, 0
    for turn in sorted(turns):
        used += size(turn[5])
        if used > sum(total.values()):
            break
        taken[turn[4]] = taken.get(turn[4], 0) + size(turn[5])
    return {r[0]: (size(r[1]), total[r[3]], target[r[3]], taken.get(r[0], 0)) for r in rows}


def test_mix_by_hand(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 3, 40, 400]))), "en",
             rng.choice(["a", "b", "b", "b", "ü", "Z", None]), 1) for i in range(300)]
    rows += [(1000, None, None, "a", 0), (1001, "x " * 50_000, None, "b", None), (1002, " \t\n", "en", "empty", 0)]
    found = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"])
             for r in mixing.mix_sources(spark.createDataFrame(rows, DOCS)).collect()}
    want = mix_by_hand(rows)
    assert set(found) == set(want)
    for doc_id, (size, source_size, target, taken) in want.items():
        assert found[doc_id][:2] == (size, source_size) and found[doc_id][3] == taken
        assert abs(found[doc_id][2] - target) < 1e-6


def test_taken_words_come_near_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 3, 40, 400]))), "en", rng.choice("abbbc"), 1)
            for i in range(500)]
    by_source = {}
    for r in mixing.mix_sources(spark.createDataFrame(rows, DOCS)).collect():
        assert r["taken"] <= 3 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for own in by_source.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 400


def test_equal_rows_take_turns(spark):
    """A source that is mostly one row, many times, with an id or without, still meets its target."""
    rows = [(i, "w " * 10, "en", "b", 1) for i in range(100)] + [(500 + i, f"x{i} y", "en", "c", 1) for i in range(40)]
    rows += [(None, "w " * 5, "en", "a", 1)] * 200 + [(None, f"some {i} words", "en", "c", 1) for i in range(60)]
    rows += [(777, "w w", "en", "c", 1)] * 300
    by_source = {}
    for r in mixing.mix_sources(spark.createDataFrame(rows, DOCS)).collect():
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        by_source.setdefault(r["source"], []).append(r)
    assert sum(len(own) for own in by_source.values()) == len(rows)
    for own in by_source.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 10


def test_targets_of_many_sources_by_ranges(spark):
    rng = random.Random(8)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 300, 20_000]) for i in range(2000)} | {None: 40, "ü": 7}
    rows = [(s, n, 1) for s, n in sizes.items()]
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        frame = mixing.source_targets(spark.createDataFrame(rows, "src string, source_size long, n_docs long"))
        found = {r["src"]: r for r in frame.select("*", mixing.F.spark_partition_id().alias("task")).collect()}
    finally:
        spark.conf.unset(conf)
    assert len({r["task"] for r in found.values()}) > 1
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    capped, above = set(), True
    while above:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        share = sum(i % 3 + 1 for i, s in enumerate(names) if s not in capped)
        above = {s for i, s in enumerate(names) if s not in capped and rest / share * (i % 3 + 1) > 3 * sizes[s]}
        capped |= above
    assert capped
    for i, s in enumerate(names):
        assert found[s]["place"] == i + 1
        assert abs(found[s]["target"] - (3 * sizes[s] if s in capped else rest / share * (i % 3 + 1))) < 1e-6


def test_mix_odd_input(spark):
    frame = spark.createDataFrame(
        [(None, "a b", "s", 1, "x"), (7, "a b c", "s", 2, "y"), (7, "a b c", "s", 2, "y")],
        "doc_id long, text string, source string, size int, target string")
    found = mixing.mix_sources(frame).collect()
    assert len(found) == 3 and all(r["taken"] == r["size"] for r in found)
    assert mixing.mix_sources(frame.limit(0)).count() == 0


TEXTS = [
    "Under the MIT license. under the mit license, UNDER THE MIT LICENSE",
    "Licensed under the Apache License, Version 2.0 (the License)", "apache license version 2", "Apache License Version 20",
    "CC BY-NC 4.0", "cc by nc sa 4.0", "SPDX-License-Identifier: GPL-3.0", "see the GNU General Public License version 2 for",
    "This is GPLv3 code", "released under a GNU GPLv2", "the mit license", "under the mit", "Lizenz mit der", "", None, "2 clause bsd license", "All rights reserved.",
    "dedicated to the public domain", "x " * 30_000 + "under the mit license " + "y " * 30_000, "underthe mit license",
    "é under\u00a0the mit license", "under the mit\u2014license",
]
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def base_by_hand(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(i, label) for phrase, label in PHRASES.items() for p in [phrase.split()]
              for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(places)


def scan(spark, texts, rules=None):
    frame = spark.createDataFrame([(i, t, "k", "w") for i, t in enumerate(texts)],
                                  "doc_id long, text string, kept string, words string")
    return {r["doc_id"]: r for r in licenses.scan_licenses(frame, rules).collect()}


def test_base_places_by_hand(spark):
    found = scan(spark, TEXTS)
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        got = sorted((d["start"], d["label"]) for d in found[i]["detections"] if d["priority"] == licenses.BASE)
        assert (found[i]["n_words"], got) == base_by_hand(text), text


def test_labels(spark):
    found = scan(spark, TEXTS)
    kept = {t: found[i]["kept"] for i, t in enumerate(TEXTS)}
    assert kept["SPDX-License-Identifier: GPL-3.0"] == ["gpl-3"]
    assert kept["see the GNU General Public License version 2 for"] == ["gpl-2"]
    assert kept["the mit license"] == ["mit"] and kept["under the mit"] == [] and kept["Lizenz mit der"] == []
    # cc by nc sa contains the base phrase, which stays; cc by alone is contained.
    assert "cc-by-nc-sa" in kept["cc by nc sa 4.0"] and "cc-by" not in kept["cc by nc sa 4.0"]
    granted = {d["priority"] for d in found[TEXTS.index("Licensed under the Apache License, Version 2.0 (the License)")]["detections"]}
    assert licenses.GRANTED in granted and licenses.BASE in granted
    assert kept["This is GPLv3 code"] == ["gpl-3"] and kept["released under a GNU GPLv2"] == ["gpl-2"]
    assert kept["2 clause bsd license"] == ["bsd-2"] and kept["All rights reserved."] == ["proprietary"]


SIGNED = {
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated': ["mit"],
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided": ["bsd"],
    "Neither the name of the copyright holder nor the names of its contributors may be used": ["bsd-3"],
    "All advertising materials mentioning features or use of this software must display": ["bsd-4"],
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,": ["isc"],
    "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License": ["gpl-3"],
    "the GNU Lesser General Public License as published by the Free Software Foundation; version 2.1 of": ["lgpl-2.1"],
    "This is free and unencumbered software released into the public domain.": ["unlicense"],
    "MIT licensed": ["mit"], "see https://creativecommons.org/licenses/by-sa/4.0/": ["cc-by-sa"],
    "https://opensource.org/licenses/MIT": ["mit"], "http://www.apache.org/licenses/LICENSE-2.0": ["apache-2"],
    "Apache-2.0 OR MIT": ["apache-2", "mit"], "MIT OR Apache-2.0": ["apache-2", "mit"],
    "SPDX-License-Identifier: Apache-2.0 OR MIT": ["apache-2", "mit"],
    "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 OR ISC": ["gpl-2", "isc"],
    "SPDX-License-Identifier: MIT AND BSD-3-Clause": ["bsd-3", "mit"],
    "students of MIT or Yale, mit der Bahn": [], "permission is granted to any person": []}


def test_texts_notices_addresses_and_expressions(spark):
    found = scan(spark, list(SIGNED))
    for i, (text, labels) in enumerate(SIGNED.items()):
        got = set(found[i]["kept"])
        # A sentence may tell more than one name, never a wrong one.
        assert set(labels) <= got and not (got and not labels), (text, got)
    only = {t: found[i]["kept"] for i, t in enumerate(SIGNED)}
    assert only["MIT licensed"] == ["mit"] and only["Apache-2.0 OR MIT"] == ["apache-2", "mit"]


def test_only_a_to_z_are_lowered(spark):
    """Other capitals stay, as words are compared by the contract's letters."""
    found = scan(spark, ["UNDER THE MIT LICENSE", "\u212aPL", "under the m\u0130t license"])
    assert found[0]["kept"] == ["mit"] and found[1]["n_words"] == 1 and found[2]["kept"] == []


def test_rules_by_hand(spark):
    """Detections and suppression against regexes over the joined words."""
    rng = random.Random(5)
    vocabulary = ("licensed under the mit license apache version 2 0 cc by nc sa gnu general public bsd 3 clause "
                  "spdx identifier gpl see of terms creative commons attribution").split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(15)]
    rules = licenses.all_rules()
    found = scan(spark, texts)
    for i, text in enumerate(texts):
        words, want = text.split(), set()
        for rule in set(rules):
            for at, word in enumerate(words):
                if word != rule.keyword:
                    continue
                left = " ".join(words[max(0, at - licenses.REACH):at]) + " "
                right = " ".join(words[at:at + licenses.REACH])
                before = re.search(f"(?:^| )({rule.before})$" if rule.before else "()$", left)
                onward = re.match(f"({rule.onward})(?= |$)", right)
                if before and onward:
                    want.add((at - len(before[1].split()), at + len(onward[1].split()), rule.priority, rule.label))
        got = {(d["start"], d["end"], d["priority"], d["label"]) for d in found[i]["detections"]}
        assert got == want
        ordered = sorted(want, key=lambda d: (d[0], -d[1], d[2], d[3]))
        kept = {d[3] for k, d in enumerate(ordered) if not any(
            e[1] >= d[1] and e[2] <= d[2] for e in ordered[:k])}
        assert set(found[i]["kept"]) == kept
    assert 200 <= len(set(rules)) and len(rules) == len(set(rules))


def test_scan_of_nothing(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
