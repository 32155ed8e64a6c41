"""Source audit: runs and their merge, and every divergence by exact arithmetic."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from careflow.llm import audit


def by_hand(rows, least=3, top=200):
    """(lang, source, part, item) -> (value, rank)"""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, holders, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        counts[lang, source].update(terms)
        holders[lang].update(set(terms))
        groups.add((lang, source))
    result = {}
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holders[lang].items() if n >= least]
        names = sorted(s for g, s in groups if g == lang)

        def shares(found, kept=kept):
            total = sum(found[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (found[t] + 1) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in names}
        q = shares(sum((counts[lang, s] for s in names), Counter()))
        for a in names:
            pairs = [(sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept), b) for b in names if b != a]
            terms = [((p[a][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, a][t] > 0 and p[a][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    result[lang, a, part, item] = (value, rank)
    return result


def audited(spark, rows, **options):
    docs = spark.createDataFrame(
        [(*r, "x", "y", "z") for r in rows], "text string, lang string, source string, n string, value string, rank string")
    found = audit.audit_sources(docs.repartition(3), **options).collect()
    result = {(r.lang, r.source, r.part, r.item): (r.value, r["rank"]) for r in found}
    assert len(result) == len(found)
    return result


def corpus(seed, size, words=60, langs=("en", "fr", None), sources=("a", "b", "Ω", None, "")):
    draw = random.Random(seed)
    bag = [f"{c}{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(words) for c in "wéK"]
    return [(
        draw.choice([None, "", " 1 2 ."]) if draw.random() < 0.1
        else "_".join(draw.choices(bag, weights=[1 / (k + 1) for k in range(len(bag))], k=draw.randrange(1, 80))),
        draw.choice(langs), draw.choice(sources)) for _ in range(size)]


def test_against_exact_arithmetic(spark):
    for seed in (1, 2):
        rows = corpus(seed, 150)
        rows += rows[:40]
        assert audited(spark, rows) == by_hand(rows)


def test_small_blocks_pieces_and_bands(spark, monkeypatch):
    """Many runs, pages, pieces and bands give the same result."""
    rows = corpus(3, 120, langs=("en",), sources=tuple("abcdefghijk"))
    for name, value in (("POSTINGS", 40), ("CELLS", 30), ("CHUNK", 16)):
        monkeypatch.setattr(audit, name, value)
    assert audited(spark, rows, block=50, top=5) == by_hand(rows, top=5)


def test_odd_tables(spark):
    assert audited(spark, []) == {}
    # No kept term at all: groups are compared, and differ by nothing.
    rows = [("one", "en", "a"), (None, "en", "b"), (None, None, None)]
    assert audited(spark, rows) == {("en", "a", "pair", "b"): (0, 1), ("en", "b", "pair", "a"): (0, 1)}
    # A very long text, a very long term, and a source without any term.
    rows = [("Word " * 500_000 + "x" * 2_000_000, "en", "a")] * 3 + [("word", "en", "b"), ("", "en", "c")]
    assert audited(spark, rows) == by_hand(rows)


def test_terms_of_long_texts(monkeypatch):
    text = "".join(random.Random(4).choice("ab É.\x00Z") for _ in range(5000)).encode()
    whole = [t for part in audit.terms_of(text) for t in part]
    monkeypatch.setattr(audit, "PIECE", 7)
    assert [t for part in audit.terms_of(text) for t in part] == whole
    assert whole == re.findall(rb"[a-z\x80-\xff]+", text.lower())


def test_merge_of_runs(monkeypatch):
    """Runs of random blocks, merged with little memory, equal one count over all."""
    monkeypatch.setattr(audit, "FLUSH", 5)
    draw = random.Random(5)
    total, holders, pages = defaultdict(Counter), defaultdict(int), []
    for lang in ("de", "en"):
        for _ in range(9):
            block = audit.Block()
            for _ in range(draw.randrange(1, 8)):
                words, source = draw.choices([f"t{chr(97 + i)}" for i in range(26)], k=12), draw.choice("pqr")
                block.add(source, " ".join(words).encode())
                for w in words:
                    total[lang, w.encode()][source] += 1
                for w in set(words):
                    holders[lang, w.encode()] += 1
            for batch in block.pages(lang, 1, size=3):
                pages += [batch.slice(i, 1) for i in range(batch.num_rows)]
    pages.sort(key=lambda b: (b.column(1)[0].as_py(), b.column(2)[0].as_py()))
    found = {}
    for batch in audit.merge_runs(iter(pages), 2):
        for row in batch.to_pylist():
            assert (row["lang"], row["term"]) not in found
            found[row["lang"], row["term"]] = dict(zip(row["sources"], row["counts"], strict=True))
    assert found == {k: dict(v) for k, v in total.items() if holders[k] >= 2}


def test_shares_are_exact_for_large_counts(spark):
    cases = [(0, 1), (5, 7), (9_223_372_034, 9_300_000_000), (10 ** 12, 3 * 10 ** 12 + 7), (8 * 10 ** 15, 9 * 10 ** 15)]
    want = [1 + 10 ** 9 * (c + 1) // n for c, n in cases]
    counts, totals = (np.array(x, np.int64) for x in zip(*cases))
    assert audit.shares(counts, totals).tolist() == want
    rows = spark.createDataFrame(cases, "c long, n long").select(audit.share(F.col("c"), F.col("n")).alias("p")).collect()
    assert [r.p for r in rows] == want


def test_a_page_is_as_it_was_written():
    block = audit.Block()
    block.add("s", b"b a b")
    block.add("t", b"a")
    (batch,) = block.pages("en", 1)
    assert isinstance(batch, pa.RecordBatch)
    row = batch.to_pylist()[0]
    assert (row["terms"], row["docs"], row["sizes"]) == ([b"a", b"b"], [2, 1], [2, 1])
    assert (row["sources"], row["counts"]) == (["s", "t", "s"], [1, 1, 2])
