"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are cut into segments; the partial products of a query with one segment of all vectors are a
score list, and a total is the sum over lists.  Phase 1 takes the best of each list (some times k, for
a better cutoff); the k-th best total among them is a safe cutoff.  A total of at least the cutoff needs a part of at least the
cutoff over the number of lists, so phase 2 takes all entries of the lists from there on.  Phase 3
adds what is missing of those and keeps the k best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careflow.llm.common import cut, in_tasks

#: Queries that are broadcast at a time, and the segments (lists) of a vector.
QUERY_BLOCK = 2048
SEGMENTS = 2
#: Entries that phase 1 takes of each list, in multiples of k.
DEPTH = 3
#: Vectors that a task multiplies with the queries at a time.
VECTOR_BLOCK = 1024
SCALE = 1024


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: components as floor(1024 x); vectors with a null or non-finite one take no part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(F.coalesce(usable, F.lit(False)))
        .select("vec_id", F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"))
    )


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def _lists(queries: list[tuple[int, list[int]]], spark: SparkSession, k: int, cutoffs: dict[int, int] | None):
    """Task side of phases 1 and 2: entries (query, vector, list, part) of the score lists.

    Without cutoffs the ``DEPTH * k`` best of each list among the task's vectors, else all that reach
    the uniform threshold.  Products are summed in floats only while every sum is below 2**53, else in
    integers.
    """
    dims = sorted({len(v) for _, v in queries})
    by_dim = {d: [(q, v) for q, v in queries if len(v) == d] for d in dims}
    shared = spark.sparkContext.broadcast((by_dim, cutoffs))
    depth, nothing = DEPTH * k, np.int64(-(2 ** 62))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim, cutoffs = shared.value
        blocks = {
            d: (np.array([q for q, _ in rows], np.int64), np.array([v for _, v in rows], np.int64).reshape(len(rows), d))
            for d, rows in by_dim.items()}
        # The best so far: scores and vectors, a row for each query.
        best = {(d, j): (np.empty((len(ids), 0), np.int64), np.empty((len(ids), 0), np.int64))
                for d, (ids, _) in blocks.items() for j in range(SEGMENTS)}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for d, (query_ids, query_rows) in blocks.items():
                own = np.flatnonzero(sizes == d)
                for at in range(0, len(own), VECTOR_BLOCK):
                    part = own[at:at + VECTOR_BLOCK]
                    rows = flat[starts[part][:, None] + np.arange(d)].reshape(len(part), d)
                    for j, scores in enumerate(products(rows, query_rows)):
                        scores[query_ids[:, None] == ids[part]] = nothing
                        if cutoffs is None:
                            best[d, j] = kept(*best[d, j], scores, ids[part])
                        else:
                            least = np.array([cutoffs.get(int(q), int(nothing) + 1) for q in query_ids])
                            reached = (scores * SEGMENTS >= least[:, None]) & (scores > nothing)
                            query, vector = np.nonzero(reached)
                            yield entries(query_ids[query], ids[part][vector], j, scores[query, vector])
        if cutoffs is None:
            for (d, j), (scores, vectors) in best.items():
                query, place = np.nonzero(scores > nothing)
                yield entries(blocks[d][0][query], vectors[query, place], j, scores[query, place])

    def products(rows: np.ndarray, queries: np.ndarray) -> Iterator[np.ndarray]:
        for piece in np.array_split(np.arange(rows.shape[1]), SEGMENTS):
            a, b = rows[:, piece], queries[:, piece]
            top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, len(piece))
            kind = np.float64 if top < 2 ** 53 else np.int64
            yield (b.astype(kind) @ a.astype(kind).T).astype(np.int64)

    def kept(scores, vectors, new_scores, new_vectors):
        scores = np.concatenate([scores, new_scores], axis=1)
        vectors = np.concatenate([vectors, np.broadcast_to(new_vectors, new_scores.shape)], axis=1)
        if scores.shape[1] > depth:
            take = np.argpartition(-scores, depth - 1, axis=1)[:, :depth]
            scores, vectors = np.take_along_axis(scores, take, 1), np.take_along_axis(vectors, take, 1)
        return scores, vectors

    def entries(query, vector, j, part):
        return pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(vector), pa.array(np.full(len(query), j, np.int32)), pa.array(part)],
            ["query_id", "vec_id", "list", "part"])

    return run


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _totals(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    return (
        pairs.join(vectors.withColumnRenamed("v", "vector"), "vec_id")
        .join(queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("query")), "query_id")
        .select("query_id", "vec_id", _dot("vector", "query").alias("score"))
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest integer inner products.

    ``vectors`` has ``vec_id, embedding``; ``is_query`` picks the queries by ``vec_id``.  All other
    vectors of the same number of components are candidates, ties go to the smaller id, and fewer than
    k candidates are all returned.  Null ids and vectors that are null or hold a null or non-finite
    component take no part; of rows that repeat an id, the one with the smallest vector counts; other
    columns are ignored.  Products beyond a long are an error.

    Of equal vectors only the k + 1 smallest ids can be among the best of any query, so all copies
    of a frequent vector but those are left out beforehand, exactly.  Queries are taken in blocks of
    bounded size, each against all vectors, which stay where they are.
    """
    spark = vectors.sparkSession
    usable = cut(whole_vectors(vectors).groupBy("vec_id").agg(F.min("v").alias("v")))
    copies = Window.partitionBy("v").orderBy("vec_id")
    candidates = cut(
        usable.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("vec_id", "v"))
    queries = usable.where(is_query)
    results, last = [], None
    while True:
        block = queries if last is None else queries.where(F.col("vec_id") > last)
        taken = block.orderBy("vec_id").limit(QUERY_BLOCK).collect()
        if not taken:
            break
        last = taken[-1]["vec_id"]
        own = queries.where(F.col("vec_id").between(taken[0]["vec_id"], last))
        rows = [(r["vec_id"], list(r["v"])) for r in taken]
        schema = "query_id long, vec_id long, list int, part long"
        narrow = candidates.select("vec_id", "v")
        # Phase 1: the best of each list, and the k-th best total among them.
        first = in_tasks(narrow, _lists(rows, spark, k, None), schema)
        by_list = Window.partitionBy("query_id", "list").orderBy(F.col("part").desc(), F.col("vec_id"))
        seen = first.withColumn("place", F.row_number().over(by_list)).where(F.col("place") <= DEPTH * k)
        totals = _best(_totals(seen.select("query_id", "vec_id").distinct(), own, candidates), k)
        cutoffs = {
            r["query_id"]: r["cutoff"] for r in
            totals.groupBy("query_id").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= k).collect()}
        # Phase 2: all entries that reach the threshold.  Phase 3: what is missing of them, then the best.
        reached = in_tasks(narrow, _lists(rows, spark, k, cutoffs), schema)
        sums = reached.groupBy("query_id", "vec_id").agg(F.sum("part").alias("known"), F.count(F.lit(1)).alias("lists"))
        whole = sums.where(F.col("lists") == SEGMENTS).select("query_id", "vec_id", F.col("known").alias("score"))
        missing = _totals(sums.where(F.col("lists") < SEGMENTS).select("query_id", "vec_id"), own, candidates)
        results.append(cut(_best(whole.unionByName(missing), k).select("query_id", "rank", "vec_id", "score")))
    if not results:
        return usable.limit(0).select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found
