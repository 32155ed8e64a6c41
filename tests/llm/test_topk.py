"""Top-k inner products against brute force."""

import math
import random

from pyspark.sql import functions as F

from careflow.llm import topk

SCHEMA = "vec_id long, embedding array<double>, v int, score string"


def by_hand(rows, k):
    usable = {}
    for vec_id, x, *_ in rows:
        if vec_id is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(1024 * c) for c in x]
        usable[vec_id] = min(usable.get(vec_id, v), v)
    found = []
    for q, a in usable.items():
        if q % 10:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable.items()
                        if i != q and len(a) == len(b))
        found += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def search(spark, rows, k=10):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 10 == 0, k).collect()))


def test_random_ties_and_copies(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, [round(rng.uniform(-1, 1), 2) for _ in range(8)], 0, "") for i in range(300)]
    rows += [(1000 + i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.25], 0, "") for i in range(60)]  # copies, some of them queries
    rows += [(2000 + i, [float(rng.randint(0, 1)) for _ in range(8)], 0, "") for i in range(60)]
    assert search(spark, rows) == by_hand(rows, 10)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    assert search(spark, rows) == by_hand(rows, 10)


def test_few_candidates_and_odd_vectors(spark):
    rows = [(10, [0.1, 0.2], 0, ""), (11, [0.1, None], 0, ""), (12, None, 0, ""), (20, [float("nan"), 1.0], 0, ""),
            (13, [float("inf"), 1.0], 0, ""), (14, [-0.3, 0.2], 0, ""), (15, [0.1, 0.2, 0.3], 0, ""), (None, [1.0, 1.0], 0, ""),
            (16, [1e6, -1e6], 0, ""), (30, [1e6, 1e6], 0, ""), (16, [1e6, -1e6], 0, ""), (17, [], 0, ""), (40, [], 0, ""),
            (18, [1e5, 3e5], 0, ""), (18, [2e5, 0.0], 0, "")]
    assert search(spark, rows) == by_hand(rows, 10)
    assert search(spark, rows, 1) == by_hand(rows, 1)


def test_no_queries_and_empty_table(spark):
    assert search(spark, [(1, [0.1], 0, "")]) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 10 == 0).columns == ["query_id", "rank", "vec_id", "score"]
    assert topk.top_k(empty, F.col("vec_id") % 10 == 0).count() == 0
