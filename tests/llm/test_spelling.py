"""Spelling variants: words, near words, forms and roots against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from careflow.llm import spelling


def one_edit(a, b):
    """Whether one inserted, deleted or replaced character makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_hand(counts):
    """word -> (form, root, n, n_near, form_n)"""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def variants(spark, pairs, **options):
    words = spark.createDataFrame([(w, n, "x", 1) for w, n in pairs], "word string, n long, form string, l int")
    found = spelling.spelling_variants(words, **options).collect()
    result = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}
    assert len(result) == len(found)
    return result


def lexicon(seed, size, letters="abé", lengths=(1, 9)):
    draw = random.Random(seed)
    words = {"".join(draw.choices(letters, k=draw.randrange(*lengths))) for _ in range(size)}
    return {w: draw.choice((1, 2, 3, 4, 8, 9, 40)) for w in words}


def test_against_brute_force(spark):
    for seed in (1, 2):
        counts = lexicon(seed, 900)
        assert variants(spark, list(counts.items())) == by_hand(counts)


def test_crowded_cells_are_divided(spark):
    """A third of all words begins alike, another ends alike; small cells force several rounds."""
    counts = lexicon(3, 250, lengths=(2, 6))
    counts |= {"beginning" + w: n for w, n in lexicon(4, 250, lengths=(1, 6)).items()}
    counts |= {w + "endend": n for w, n in lexicon(5, 250, lengths=(1, 6)).items()}
    want = by_hand(counts)
    assert variants(spark, list(counts.items()), limit=20) == want
    assert variants(spark, list(counts.items())) == want


def test_no_pair_is_found_twice_or_lost(spark):
    """Each pair meets in one cell that leaves it in, whatever the limit."""
    counts = lexicon(6, 300, lengths=(1, 12))
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    total = sum(one_edit(a, b) for a in counts for b in counts)
    for limit in (4, 60, 1 << 18):
        assert spelling.neighbours(words, limit).agg(F.sum("n_near")).first()[0] == total


def test_bit_sets_over_several_machine_words():
    words = sorted(lexicon(7, 700, lengths=(5, 7)))
    for length in (5,):
        pool = [w for w in words if len(w) in (length, length + 1)]
        counts, first = spelling.near_words(
            pool, np.zeros(len(pool), int), np.array([len(w) > length for w in pool]), spelling.OPEN)
        for i, w in enumerate(pool):
            found = [j for j, v in enumerate(pool) if one_edit(w, v) and min(len(w), len(v)) == length]
            assert (counts[i], first[i]) == (len(found), found[0] if found else -1)


def test_odd_words(spark):
    assert variants(spark, []) == {}
    long = "a" * 30_000
    pairs = [("word", 5), ("word", 6), ("", 9), (None, 3), ("ward", None), ("ward", 5), ("a", 1), ("b", 2), ("ab", 4),
             (long, 1), (long + "b", 2), ("b" + long, 2), ("日本語", 2), ("日本", 4), ("𝄞bc", 1), ("bc", 2)]
    counts = {w: n for w, n in pairs if w and n} | {"word": 11}
    assert variants(spark, pairs) == by_hand(counts)


def test_long_paths_end_at_their_root(spark):
    chain = {"x" * (10 + i): 2 ** i for i in range(20)}
    found = variants(spark, list(chain.items()))
    assert {r[1] for r in found.values()} == {"x" * 29}


def test_words_of_documents(spark):
    """Runs, lower case, slips and bounds, against a plain count."""
    texts = [(1, "Straße STRASSE strasse ÀÉÎÕÜ àéîõü x×y÷zz Ābcdefg it's"), (2, None), (None, "Strasse strasse wonderful"),
             (3, ""), (4, "Wonderful " * 120_000), (4, "wonderful"), (5, "日本 hello-world hello_world hello1world")]
    texts += [(i, "alphabet soup alphabetical order wonderful") for i in range(10, 300)]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for slip in (None, 97, 2):
        want = Counter()
        for doc_id, text in texts:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = run.translate(lower)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                at = h % len(run)
                want[run[:at] + run[at + 1:] if slip and h % slip == 0 else run] += 1
        want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
        docs = spark.createDataFrame([(i, t, "w", 9) for i, t in texts], "doc_id long, text string, word string, n int")
        found = spelling.vocabulary(docs, 5, 3, slip).collect()
        assert {r.word: r.n for r in found} == want


def test_pieces_of_a_long_text(monkeypatch):
    text = "".join(random.Random(8).choice("abÉ .日") for _ in range(3000))
    whole = [w for part in spelling.words_of(text) for w in part]
    monkeypatch.setattr(spelling, "PIECE", 5)
    assert [w for part in spelling.words_of(text) for w in part] == whole
