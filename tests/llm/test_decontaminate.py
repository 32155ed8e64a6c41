"""Decontamination: tiles against a plain tiling, pairs against every pair."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from careflow.llm import decontaminate as d


def tiles_by_hand(item, doc, least):
    """Mark the longest unmarked match, again and again."""
    free_item, free_doc, made = [True] * len(item), [True] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and free_item[i + n] and free_doc[j + n]):
                    n += 1
                if n >= least and (best is None or (-n, i, j) < best):
                    best = (-n, i, j)
        if best is None:
            return made
        n, i, j = -best[0], best[1], best[2]
        made.append((i, j, n))
        free_item[i:i + n] = [False] * n
        free_doc[j:j + n] = [False] * n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=30), st.lists(st.integers(0, 3), max_size=60), st.integers(1, 4))
def test_tiles_by_hand(item, doc, least):
    assert d.tiles(np.array(item, np.int64), np.array(doc, np.int64), least) == tiles_by_hand(item, doc, least)


def test_long_matches_grow_the_search():
    item = np.arange(3000)
    doc = np.concatenate([np.full(50, -1), item[1500:], np.full(5, -1), item[:1500], np.full(9, -1)])
    assert d.tiles(item, doc) == [(0, 1555, 1500), (1500, 50, 1500)]


def words(text):
    return d.WORD.findall(d.lowered(text))


@given(st.text(max_size=60))
def test_words_are_hashed_alike(text):
    hasher = d.WordHasher()
    own = words(text)
    hashes = hasher(d.lowered(text))
    assert len(hashes) == len(own)
    assert [hasher(w)[0] for w in own] == hashes.tolist()


def by_hand(docs, items):
    found = {}
    for doc_id, text, *_ in docs:
        for item_id, passage, *_ in items:
            item, doc = words(passage), words(text)
            if doc_id is None or item_id is None or not item:
                continue
            made = tiles_by_hand(item, doc, max(1, min(5, len(item))))
            covered = sum(n for *_, n in made)
            if covered >= 0.8 * len(item) - 1e-9:
                best = found.get((doc_id, item_id))
                new = (covered / len(item), len(item), covered, -len(made))
                found[doc_id, item_id] = max(best or new, new)
    return sorted((*k, n, c, -t) for k, (_, n, c, t) in found.items())


def test_pairs_by_hand(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.choice([1, 2, 3])))
    passages = [" ".join(word() for _ in range(n)) for n in (1, 3, 5, 12, 25, 40, 40)] + ["", None, "a b, C! d-e F g h", " . "]
    items = [(i, p, "x") for i, p in enumerate(passages)] + [(3, passages[3], "x"), (3, passages[4], "y"), (None, passages[5], "z")]
    filler = lambda n: " ".join(word() for _ in range(n))
    halves = passages[5].split()
    texts = [f"{filler(30)} {p} {filler(20)}" for p in passages[:7] if p]
    texts += ["", None, " ".join(halves[20:] + ["zz"] + halves[:20]), passages[5].upper().replace(" ", " -- "),
              " ".join(halves[:30]), " ".join(halves[:33]), " ".join(w + (" zzz" if i % 4 == 3 else "") for i, w in enumerate(halves)),
              "a b c d e f g", filler(3000) + " " + passages[4]]
    docs = [(i, t, 1, "q") for i, t in enumerate(texts)] + [(0, texts[0], 1, "q"), (1, texts[3], 1, "q"), (None, texts[5], 1, "q")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id int, seeds string")
    bench = spark.createDataFrame(items, "item_id int, text string, doc_id string")
    found = sorted(map(tuple, d.contaminated(frame, bench).collect()))
    assert found == by_hand(docs, items)
    reordered = texts.index(" ".join(halves[20:] + ["zz"] + halves[:20]))
    assert (reordered, 5) in {(r[0], r[1]) for r in found}


def test_items_that_repeat_themselves(spark):
    """An item of few different runs is found, also if no other item is short."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    period, long = [word() for _ in range(10)], [word() for _ in range(80)]
    items = [(0, " ".join(period * 7)), (1, " ".join(["again"] * 70)), (2, " ".join(long)),
             (3, " ".join(long[:40] + period * 4))]
    texts = [t for _, t in items] + [f"{word()} {t} {word()}" for _, t in items]
    texts += [" ".join(period * 5), " ".join(period * 6), " ".join(period), " ".join(long[:50]), " ".join(["again"] * 60)]
    docs = list(enumerate(texts))
    for bench in (items, items[:1], items[1:2], items[2:]):
        found = sorted(map(tuple, d.contaminated(
            spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(bench, "item_id int, text string")).collect()))
        assert found == by_hand(docs, bench) and {r[1] for r in found} == {i for i, _ in bench}


def test_many_seeds_are_taken_in_rounds(spark, monkeypatch):
    """More seeds than one filter is for: items go in rounds, and no pair is lost."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((3, 12, 30, 30, 30, 60))]
    docs = [(i, f"{word()} {t} {word()}") for i, t in items] + [(50, " ".join(t for _, t in items)), (51, word())]
    monkeypatch.setattr(d.hashed, "MOST_HASHES", 40)
    found = sorted(map(tuple, d.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id int, text string")).collect()))
    assert found == by_hand(docs, items) and len(found) == 2 * len(items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert d.contaminated(docs, items).count() == 1
    assert d.contaminated(docs.limit(0), items).count() == 0
    assert d.contaminated(docs, items.limit(0)).count() == 0
