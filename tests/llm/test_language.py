"""Language ID: automata, parses and costs by hand, held-out accuracy, odd input."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from careflow.llm import language as g

DOCS = "doc_id long, text string, lang string, source string, score string"


def phrases_by_hand(text, sample):
    """Longest phrases that occur in the sample; a byte it lacks is a phrase."""
    at = found = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n + 1] in sample:
            n += 1
        at += n
        found += 1
    return found


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc ", min_size=1, max_size=40), st.lists(st.text(alphabet="abcd ", max_size=600), min_size=1, max_size=4))
def test_parses_by_hand(sample, texts):
    parser = g.learn({"x": "a" + sample})
    own = g.plain("a" + sample)
    plain = [g.plain(t) for t in texts]
    want = [sum(phrases_by_hand(t[i:i + g.PIECE], own) for i in range(0, len(t), g.PIECE)) for t in plain]
    bits = math.log2(max(2, len(own)))
    got = g.costs(plain, parser)[:, 0]
    assert np.allclose(got, [w * bits / max(1, len(t)) for w, t in zip(want, plain, strict=True)])


def test_lanes_beyond_one_round(monkeypatch):
    parser = g.learn({"x": "the cat sat on the mat", "y": "der hund lag auf dem bett"})
    texts = [g.plain("the cat lag on dem mat " * n) for n in (1, 40, 90, 0, 3)]
    want = g.costs(texts, parser)
    monkeypatch.setattr(g, "LANES", 3)
    assert np.allclose(g.costs(texts, parser), want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = g.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 250
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.97


def test_odd_input(spark):
    rows = [(i, "the quick brown fox and the dog " * 3, "en", "s", "x") for i in range(0, 40, 2)]
    rows += [(i, "der schnelle braune Fuchs und der Hund " * 3, "de", "s", "x") for i in range(1, 40, 2)]
    rows += [(100, None, "en", None, None), (101, "", "en", None, None), (102, "12 ½ ²!", None, None, None),
             (103, "Und der Hund", None, None, None), (103, "Und der Hund", None, None, None),
             (None, "the dog", "de", None, None), (104, "the fox " * 30_000, None, None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    found = g.identify(frame, carry=True).collect()
    assert len(found) == len(rows)
    told = {r["doc_id"]: r for r in found}
    assert [told[i]["lang_pred"] for i in (100, 101, 102, 103, 104, None)] == ["und", "und", "und", "de", "en", "en"]
    assert told[100]["score"] == 0 and 0.5 <= told[103]["score"] <= 1 and not told[None]["held_out"]
    assert told[103]["row"].asDict() == dict(zip(("doc_id", "text", "lang", "source", "score"), rows[-3], strict=True))
    assert {r["lang_pred"] for r in g.identify(frame.where("lang is null")).collect()} == {"und"}
    assert g.identify(frame.limit(0)).count() == 0


def test_one_language(spark):
    frame = spark.createDataFrame([(i, "some words here", "en", "", "") for i in range(9)], DOCS)
    assert {(r["lang_pred"], r["score"]) for r in g.identify(frame).collect()} == {("en", 1.0)}


@pytest.mark.parametrize("sample", [{}, {"en": ""}, {"en": "12"}])
def test_nothing_to_learn_from(sample):
    assert g.learn(sample).languages == []


def test_every_language_is_learned(spark):
    """Also rare ones among many; the two lowest costs are those of the whole table."""
    rng = np.random.default_rng(5)
    spoken = {f"l{n:03d}": ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(12)] for n in range(70)}
    rows, texts = [], []
    for n, (name, words) in enumerate(spoken.items()):
        for _ in range(4 if n % 10 else 8):
            rows.append((len(rows), " ".join(rng.choice(words, 40)), name, "s", "x"))
        texts.append(" ".join(rng.choice(words, 40)))
    frame = spark.createDataFrame(rows + [(None, t, None, name, "") for name, t in zip(spoken, texts, strict=True)], DOCS)
    samples = g.labelled_samples(frame, 1, 3)
    assert len(samples) > 64 and set(samples) <= set(spoken)
    found = g.identify(frame, carry=True).where("doc_id is null").collect()
    assert {r["row"]["source"]: r["lang_pred"] for r in found if r["row"]["source"] in samples} == {n: n for n in samples}
    parser = g.learn(samples)
    plain = [g.plain(t) for t in [*texts, ""]]
    best, lowest, second = g.two_lowest(plain, parser)
    whole = g.costs(plain, parser)
    assert best.tolist() == whole.argmin(axis=1).tolist()
    assert np.array_equal(np.column_stack([lowest, second]), np.sort(whole, axis=1)[:, :2])


def test_all_chosen_documents_are_learned_from(spark):
    """Every chosen document has its share of the bytes, in whole characters, whatever its script."""
    rows = [(i, chr(0x4E00 + i) * 3000, "zh", "s", "x") for i in range(150)] + [(200 + i, "ж" * 9000, "ru", "s", "x") for i in range(3)]
    samples = g.labelled_samples(spark.createDataFrame(rows, DOCS), 1, 3)
    assert len(set(samples["zh"]) - {" "}) == g.SAMPLE_DOCS
    assert all(g.SAMPLE_BYTES * 0.97 < len(t.encode()) <= g.SAMPLE_BYTES for t in samples.values())
    assert g.beginning("aж".encode(), 2) == b"a"


def test_repeated_rows_are_one_document(spark):
    """A document that is repeated does not take the places of others."""
    rows = [(i, f"word{i} " * 30, "en", "s", "x") for i in range(400)]
    repeated = [r for r in rows if r[0] < 200 for _ in range(20)]
    samples = g.labelled_samples(spark.createDataFrame(rows + repeated + rows[:1] * 5000, DOCS), 1, 3)
    assert g.SAMPLE_BYTES * 0.9 < len(samples["en"].encode()) <= g.SAMPLE_BYTES
    assert samples == g.labelled_samples(spark.createDataFrame(rows, DOCS), 1, 3)


def test_languages_in_rounds(spark, monkeypatch):
    """With more languages than a worker holds at once the result is the same."""
    rng = np.random.default_rng(6)
    words = {f"l{n}": ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(9)] for n in range(7)}
    rows = [(i, " ".join(rng.choice(words[f"l{i % 7}"], 30)), f"l{i % 7}", "s", "x") for i in range(70)]
    frame = spark.createDataFrame([*rows, (None, None, None, None, None), (900, "12", None, None, None)], DOCS)
    want = sorted(map(tuple, g.identify(frame).collect()), key=repr)
    assert sum(r[2] == f"l{r[0] % 7}" for r in want if r[0] is not None and r[0] < 70) == 70
    monkeypatch.setattr(g, "AT_ONCE", 2)
    assert sorted(map(tuple, g.identify(frame).collect()), key=repr) == want
    assert all("row" in r for r in g.identify(frame, carry=True).collect())


def test_phrases_tell_foreign_text(spark):
    rows = [(i, "the quick brown fox and the lazy dog " * 3, "en", "s", "x") for i in range(0, 40)]
    rows += [(900, "съешь ещё этих мягких булок", None, "", ""), (901, "a lazy fox", None, "", ""), (902, "1", None, "", "")]
    told = {r["doc_id"]: r["phrase"] for r in g.identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert told[900] < 1.5 and told[901] > 2 and told[902] is None
