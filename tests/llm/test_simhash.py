"""SimHash: fingerprints, links and components against brute force."""

import math
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from careflow.llm import simhash
from careflow.llm.components import components


def by_hand(text, width=4):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    width = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(fps):
    """{fp: set of fps in its component}"""
    group = {f: {f} for f in fps}
    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 4 and group[a] is not group[b]:
            group[a] |= group[b]
            for f in group[b]:
                group[f] = group[a]
    return group


TEXTS = ["", None, " \t\n", "One", "one", "one two three", "one two three four", "ONE two\x0bthree x four five ÄÖ",
         "a b c d a b c d a b c d", "w " * 70_000, "ß ß é", "one  two\nthree four"]


def test_fingerprints(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, fp string")
    found = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(frame).collect()}
    assert {i: v % 2 ** 64 for i, v in found.items()} == {i: by_hand(t) for i, t in enumerate(TEXTS)}


def test_components_of_documents(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    texts = list(TEXTS)
    for _ in range(12):
        base = [word() for _ in range(rng.choice([30, 300]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, 0) for i, t in zip(ids, texts, strict=True)] + [(None, texts[-1], 0), (None, "only here", 0), (ids[0], texts[0], 1)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id int")).collect()
    assert len(found) == len(rows)
    fps = {by_hand(r[1]) for r in rows}
    group = groups_by_hand(fps)
    for r in found:
        members = group[r["fp"] % 2 ** 64]
        ids_of = [x[0] for x in rows if x[0] is not None and by_hand(x[1]) in members]
        assert r["component_id"] == min(ids_of, default=None)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_cells_catch_every_close_pair(blocks):
    rng = np.random.default_rng(2)
    masks = np.array(simhash.grid_masks(4, blocks), np.int64).view(np.uint64)
    for _ in range(300):
        x = rng.integers(0, 2 ** 64, dtype=np.uint64)
        y = x
        for bit in rng.choice(64, 4, replace=False):
            y ^= np.uint64(1) << np.uint64(bit)
        u, v = simhash._np_unary(np.array([x, y]))
        assert np.bitwise_count(u ^ v) <= 4
        assert ((u & masks) == (v & masks)).any()


def dense(n, seed):
    """Distinct fingerprints around a few centers, and some far from all."""
    rng, found = random.Random(seed), set()
    centers = [rng.getrandbits(64) for _ in range(3)]
    while len(found) < n:
        x = rng.choice(centers) if rng.random() < 0.9 else rng.getrandbits(64)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
            x ^= 1 << rng.randrange(64)
        found.add(x)
    return sorted(found)


@pytest.mark.parametrize("cell, small", [(1 << 14, 256), (1 << 14, 4), (20, 4), (0, 256)])
def test_links_join_the_same_at_every_bound(spark, monkeypatch, cell, small):
    """Cells compared together, as forests, and over middles give the same components."""
    fps = dense(120, 9)
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    # Task side code is sent as modules; bounds are set by hand around it.
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "SMALL", small)
    rows = frame.select("fp", simhash.unary_counts(F.col("fp")).alias("counts")).collect()
    links = set()
    crowded = set()
    import pyarrow as pa
    cells = sorted((g, r["counts"] & m, r["fp"]) for r in rows for g, m in enumerate(simhash.grid_masks(4, 6)))
    grid, key, fp = zip(*cells, strict=True)
    parts = [pa.RecordBatch.from_arrays(
        [pa.array(grid[i:i + 37], pa.int32()), pa.array(key[i:i + 37], pa.int64()), pa.array(fp[i:i + 37], pa.int64())],
        ["grid", "cell", "fp"]) for i in range(0, len(cells), 37)]
    for batch in simhash._compare(4)(iter(parts)):
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            (crowded.add(a) if b is None else links.add((a, b)))
    assert all(((a ^ b) % 2 ** 64).bit_count() <= 4 for a, b in links)
    if crowded:
        more = simhash._over_middles(spark.createDataFrame([(c,) for c in crowded], "a long"), 4).collect()
        assert all(((r["a"] ^ r["b"]) % 2 ** 64).bit_count() <= 4 for r in more)
        links |= {(r["a"], r["b"]) for r in more}
    group = groups_by_hand(fps)
    mine = {simhash._signed(f): {simhash._signed(f)} for f in fps}
    for a, b in links:
        if mine[a] is not mine[b]:
            mine[a] |= mine[b]
            for f in mine[b]:
                mine[f] = mine[a]
    assert {f: min(m) for f, m in mine.items()} == {simhash._signed(f): min(map(simhash._signed, g)) for f, g in group.items()}
    if cell == 0:
        assert crowded and len(crowded) == len(fps)


def test_components(spark):
    rng = random.Random(4)
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 150)]
    some = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    links = [*path, *star, *some, (5, 5), (7, None), (3, 4), (4, 3)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots)
    assert len({roots[i] for i in range(201)}) == 1 and len({roots[1000 + i] for i in range(150)}) == 1
    for a, b in some:
        assert a == b or roots[a] == roots[b]
    parent = {n: n for n in range(2000, 2100)}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in some:
        parent[top(a)] = top(b)
    own = [n for n in roots if n >= 2000]
    assert all((roots[a] == roots[b]) == (top(a) == top(b)) for a, b in combinations(own, 2))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_copies_of_a_fingerprint_by_their_number():
    """The figures of the docstring; more fingerprints never make a coarser grid."""
    sizes = [256_000, 10 ** 6, 10 ** 7, 10 ** 8, 10 ** 9, 10 ** 10]
    assert [math.comb(simhash.n_blocks(4, n), 4) for n in sizes] == [15, 15, 35, 35, 70, 210]
    assert all(simhash.n_blocks(4, 2 ** k) <= simhash.n_blocks(4, 2 ** (k + 1)) <= 32 for k in range(60))
    assert simhash.n_blocks(4, 0) == simhash.n_blocks(4, 1) == 5


@pytest.mark.parametrize("blocks", [5, 6, 7, 9])
def test_links_are_the_same_in_any_grid(spark, monkeypatch, blocks):
    rng = random.Random(9)
    points = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(160):
        flipped = rng.choice(points)
        for bit in rng.sample(range(64), rng.randint(1, 6)):
            flipped ^= 1 << bit
        points.append(flipped)
    points = sorted({p - (1 << 64) if p >> 63 else p for p in points})
    monkeypatch.setattr(simhash, "n_blocks", lambda distance, size: blocks)
    links = {(r.a, r.b) for r in simhash.close_links(spark.createDataFrame([(p,) for p in points], "fp long")).collect()}
    root = {p: p for p in points}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
        root[top(a)] = top(b)
    close = [(a, b) for i, a in enumerate(points) for b in points[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    assert len(close) > 60 and all(top(a) == top(b) for a, b in close)
