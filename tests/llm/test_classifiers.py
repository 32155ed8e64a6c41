"""Toxicity and quality: held-out accuracy, whole texts, odd input."""

import math
import re

import numpy as np
import pytest
import zstandard

from careflow.llm import quality, toxicity

SF = "/root/testdata/sf0.01"
CASES = [(toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")]


def area(scores, labels):
    """Chance that a row of label 1 scores above one of label 0."""
    a, b = scores[labels == 1], scores[labels == 0]
    return ((a[:, None] > b[None, :]) + 0.5 * (a[:, None] == b[None, :])).mean()


@pytest.mark.parametrize("score, name", CASES)
def test_held_out(spark, score, name):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    y = np.array([r[name] for r in rows])
    assert area(np.array([r["score"] for r in rows]), y) > 0.8
    assert np.mean([r["predicted"] == v for r, v in zip(rows, y, strict=True)]) > 0.9


@pytest.mark.parametrize("score, name", CASES)
def test_odd_input(spark, score, name):
    good, bad = "some plain words stand here again ", "You stupid idiot!! TRASH!! disgusting "
    rows = [(i, (good if i % 2 else bad) * 9, i, "x") for i in range(60)]
    rows += [(100, None, 0, None), (101, "", 0, None), (None, bad * 4, 0, None), (0, rows[0][1], 0, "again"),
             (102, good * 20_000 + bad * 3, 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, label string")
    of_bad = 1 if name == "toxic" else 0
    labels = [(i, of_bad if i % 2 == 0 else 1 - of_bad, "x") for i in range(60)]
    labels += [(5, None, ""), (6, 7, ""), (None, 1, ""), (777, 1, ""), (100, 0, "")]
    label_frame = spark.createDataFrame(labels, f"doc_id long, {name} int, text string")
    found = score(docs, label_frame).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    right = [(by_id[i]["score"] > 0.5) == ((i % 2 == 0) == bool(of_bad)) for i in range(60)]
    assert all(right)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert by_id[100]["score"] == by_id[101]["score"] and not by_id[None]["held_out"]
    assert score(docs.limit(0), label_frame).count() == 0
    none = score(docs, label_frame.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)} and len(none) == len(rows)


def test_windows_hold_the_whole_text():
    for text in ("", "a", "b " * 500, "x" * 1000, "Some, words!! here\n" * 40):
        words = toxicity.plain(text)
        parts = toxicity.windows(words)
        assert (parts[0][:1] + b"".join(p[1:] for p in parts) if parts else words[:1]) == (words if parts else b" ")


def test_copies_speak_once():
    """Segments of many copies of one toxic text don't crowd out what other toxic texts share."""
    ranked = [(b" copy%d" % i, 0) for i in range(50)] + [(b" word", 3), (b" words", 3), (b" rare", 0)]
    holders = {i: list(range(60)) for i in range(50)} | {50: list(range(60, 160)), 51: list(range(60, 160)), 52: [1]}
    chosen = toxicity.choose_by_voices(ranked, holders, {0: 500, 1: 200})
    assert chosen == [b" copy%d" % i for i in range(toxicity.VOICES)] + [b" word"]


def test_words_beyond_the_first_block_are_candidates(spark):
    """Many copies of one long text rank before what other toxic documents share, yet both get in."""
    copied = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}copied{i:04d}" for i in range(650))
    rows = [(i, 0, f"ordinary talk of day{i:05d}") for i in range(180)]
    rows += [(200 + i, 1, copied) for i in range(60)]
    rows += [(300 + i, 1, f"this is {('wicked', 'hateful', 'rotten')[i % 3]} stuff{i:05d}") for i in range(120)]
    assert len(toxicity.beginnings(copied)) > toxicity.CANDIDATES
    ordinary, toxic = toxicity._dictionaries(spark.createDataFrame(rows, "doc_id long, label int, text string"))
    for word in (b" wicked", b" hateful", b" rotten"):
        assert word in toxic and word not in ordinary
    # Shared words leave out what begins with a toxic segment: three of the copied text's.
    assert sum(w not in ordinary.split() for w in copied.encode().split()) >= toxicity.VOICES


def test_toxic_words_at_the_end_of_a_long_text_count(spark):
    good, bad = "these are some plain words for the test ", "pathetic worthless scum you disgusting moron "
    rows = [(i, good * (3 + i % 7) + (bad if i % 2 else "")) for i in range(60)] + [(100, good * 3000 + bad * 3), (101, good * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    found = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    assert found[100] > found[101]


def test_maxima_by_hand():
    rng = np.random.default_rng(1)
    filters = rng.normal(size=(quality.WIDTH, 256, 3)).astype(np.float32)
    data = quality.padded(rng.integers(0, 256, 3 * quality.BLOCK * quality.STRIP // 2, np.uint8).tobytes())
    got = quality.block_maxima(data, quality._tables(filters))
    raw = data + b"\0" * quality.WIDTH
    for block in (0, 1, quality.STRIP - 1, quality.STRIP, len(data) // quality.BLOCK - 1):
        places = range(block * quality.BLOCK, (block + 1) * quality.BLOCK)
        want = np.max([[sum(filters[k, raw[p + k], f] for k in range(quality.WIDTH)) for f in range(3)] for p in places], axis=0)
        assert np.allclose(got[block], want, atol=1e-4)
    assert len(quality.padded(b"")) == quality.BLOCK and len(quality.padded(b"x" * quality.BLOCK)) == 2 * quality.BLOCK


def test_training_is_repeatable():
    rng = np.random.default_rng(3)
    chunks = rng.integers(0, 64, (80, 2 * quality.BLOCK + quality.WIDTH), np.uint8)
    labels = np.arange(80) % 2
    chunks[labels == 1, 100:104] = [200, 201, 202, 203]
    a, b = quality.train(chunks, labels), quality.train(chunks, labels)
    assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))


def probability_by_hand(x, c):
    """Logistic regression on kept-in-range, standardised features, a number at a time."""
    total = c.beta[0]
    for k, value in enumerate(x):
        total += c.beta[k + 1] * (min(max(value, c.low[k]), c.high[k]) - c.center[k]) / c.spread[k]
    return 1 / (1 + math.exp(-total))


def distances_by_hand(text, model):
    """How much shorter the toxic dictionary makes each window: a window takes words until it has 40 bytes."""
    words = re.findall("[0-9A-Za-z\u0080-\U0010ffff]+", text.lower())
    blocks, now = [], ""
    for word in words:
        now += " " + word
        if len(now.encode()) >= toxicity.WINDOW:
            blocks.append(now + " ")
            now = ""
    blocks += [now + " "] if now else []

    def size(window, dictionary):
        settings = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=15, chain_log=15, search_log=5, min_match=5, target_length=24,
            strategy=zstandard.STRATEGY_LAZY2, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=settings)
        return len(zstandard.ZstdCompressor(compression_params=settings, dict_data=data).compress(window.encode()))

    return [size(b, model.ordinary) - size(b, model.toxic) for b in blocks]


def test_toxicity_by_hand(spark):
    good = "these are some plain words that everybody uses on most days "
    bad = "pathetic worthless scum you disgusting moron "
    rows = [(i, good * (1 + i % 5) + (bad if i % 2 else "") + good * (i % 3)) for i in range(80)]
    rows += [(100, ""), (101, "é ü 新冠 words, " * 30), (102, good * 40 + bad + good * 40), (103, "!! ??")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    found = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    for doc_id, text in rows[::7] + rows[-4:]:
        d = distances_by_hand(text, model) or [0]
        at_least = {k: sum(v >= k for v in d) for k in (1, 2, 3, 4, 5)}
        top = sorted(d)[-3:]
        x = [min(max(d), 12), sum(top) / len(top), sum(d) / len(d), math.log(1 + len(d)),
             *(math.log(1 + at_least[k]) for k in (2, 3, 4, 5)), *(at_least[k] / len(d) for k in (1, 2, 3, 5))]
        assert abs(found[doc_id] - probability_by_hand(x, model.probability)) < 1e-9
    assert max(distances_by_hand(bad, model)) >= 3 > max(distances_by_hand(good, model))


def test_quality_by_hand(spark):
    """Chunks of two blocks that overlap by one, maxima over all their places, one probability."""
    good, bad = "A sentence that was written with care. ", "clck HERE!!! $$$ buy "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 9)) for i in range(60)]
    rows += [(100, ""), (101, good * 30 + bad * 9 + good * 5), (102, "é" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    network, probability = quality.learn(docs, labels)
    found = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, labels).collect()}
    for doc_id, text in rows[3:9] + rows[-3:]:
        data = text.encode()
        blocks = -(-(len(data) + quality.WIDTH - 1) // quality.BLOCK)
        padded = data + bytes(blocks * quality.BLOCK + quality.WIDTH - len(data))
        seen = np.array([
            sum(network.filters[k, padded[p + k]].astype(float) for k in range(quality.WIDTH))
            for p in range(blocks * quality.BLOCK)])
        logits = []
        for first in range(max(1, blocks - 1)):
            pooled = seen[first * quality.BLOCK:(first + 2) * quality.BLOCK].max(axis=0)
            logits.append(float(np.maximum(pooled + network.bias, 0) @ network.dense + network.offset))
        x = [sum(logits) / len(logits), min(logits), max(logits), math.log(len(logits))]
        assert abs(found[doc_id] - probability_by_hand(x, probability)) < 1e-3
