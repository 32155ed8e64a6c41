"""SimHash near-duplicates: segment bit counts as a grid, Manhattan distance as a lower bound.

A fingerprint is embedded as the bit counts of its 32 two-bit segments, written in unary (0: 00,
1: 01, 2: 11), so that the Manhattan distance of two embeddings is the number of bits in which they
differ.  It never exceeds the Hamming distance of the fingerprints.  If the embeddings are cut into
more blocks than the distance allowed, two that are close agree fully on all but that many blocks:
each choice of the blocks that must agree is a grid, and close fingerprints share a cell of one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.llm.common import cut, in_tasks
from careflow.llm.components import components

SEED = 42
#: Shingles hashed before their bits are summed.
STEP = 1 << 16
#: Fingerprints of a cell that one task compares.  Larger cells take the path over shared middles.
CELL = 1 << 14
#: Up to this size all links of a cell are looked at together.
SMALL = 256
#: Seconds that a copy of a fingerprint takes (written, sorted, read) and that a comparison takes, the
#: latter four times as many as measured, as cells are not even.
COPY, COMPARISON = 5e-6, 6e-8
SEGMENTS = 32
LOW_BITS = 0x5555555555555555


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes | None, width: int) -> int:
    """Bits set in over half the XXH64 of all shingles of ``width`` words, as a signed integer.

    A-Z are lower-cased and words end at ASCII white space.  Fewer words are one shingle; no word
    gives zero.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    digest, set_bits = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), STEP):
        hashes = b"".join([
            digest(joined[a:b], SEED) for a, b in zip(starts[at:at + STEP], ends[at:at + STEP], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(set_bits * 2 > len(starts))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id, text_hash, fp`` for every row of ``docs`` (``doc_id, text``); a null text has no words."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py(), width) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], schema.names)

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return in_tasks(texts, run, schema)


def unary_counts(fp: Column) -> Column:
    low = F.lit(LOW_BITS).cast("long")
    shifted = F.shiftrightunsigned(fp, 1)
    both, either = fp.bitwiseAND(shifted).bitwiseAND(low), fp.bitwiseOR(shifted).bitwiseAND(low)
    return F.shiftleft(both, 1).bitwiseOR(either)


def grid_masks(distance: int, blocks: int) -> list[int]:
    """For each choice of blocks that must agree, the bits of an embedding that name the cell."""
    edges = [round(i * SEGMENTS / blocks) for i in range(blocks + 1)]
    masks = [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(chosen)) for chosen in combinations(masks, blocks - distance)]


def n_blocks(distance: int, size: int) -> int:
    """The blocks that cost least for ``size`` fingerprints; any number is exact.

    More blocks make more copies of each fingerprint, fewer make larger cells: copies are weighed against
    the comparisons within cells, and cells stay, by chance, far below ``CELL``.  At 4 bits that
    makes 15 copies at 256,000 and 10^6 fingerprints, 35 at 10^7 and 10^8, 70 at 10^9 and 210 at 10^10.
    """
    agreeing = -math.log2(0.375)  # chance that two random segments have the same count, in bits

    def cost(blocks: int) -> float:
        shared = size / 2 ** (agreeing * SEGMENTS * (blocks - distance) / blocks)
        if shared > CELL / 8 and blocks < SEGMENTS:
            return math.inf
        return math.comb(blocks, distance) * (COPY + COMPARISON * shared / 2)

    return min(range(distance + 1, SEGMENTS + 1), key=cost)


def _np_unary(x: np.ndarray) -> np.ndarray:
    low, one = np.uint64(LOW_BITS), np.uint64(1)
    return ((x & (x >> one) & low) << one) | ((x | (x >> one)) & low)


def _close(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Whether pairs are within ``distance``: by the embeddings first, then exactly."""
    near = np.bitwise_count(_np_unary(x) ^ _np_unary(y)) <= distance
    near[near] = np.bitwise_count((x ^ y)[near]) <= distance
    return near


def _forest(x: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what all close pairs of ``x`` join, at most one for each member."""
    left, parents, children = np.arange(len(x)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = _close(x[left], x[at], distance)
            found = left[near]
            parents.append(np.full(len(found), at))
            children.append(found)
            queue.extend(found.tolist())
            left = left[~near]
    none = np.empty(0, np.int64)
    return x[np.concatenate([none, *parents])], x[np.concatenate([none, *children])]


def _links(cell: np.ndarray, x: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``cell``: close pairs, or a forest of them where they are many."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[starts, len(x)])
    run = np.repeat(np.arange(len(starts)), sizes)
    after = np.repeat(starts + sizes, sizes) - np.arange(len(x)) - 1  # members of the run that follow
    small = sizes <= SMALL
    a, b = [], []
    live = np.flatnonzero(small[run] & (after > 0))
    step = 1
    while len(live):
        hit = live[_close(x[live], x[live + step], distance)]
        a.append(hit)
        b.append(hit + step)
        step += 1
        live = live[after[live] >= step]
    a = np.concatenate([np.empty(0, np.int64), *a])
    b = np.concatenate([np.empty(0, np.int64), *b])
    dense = np.bincount(run[a], minlength=len(starts)) > 2 * sizes
    keep = ~dense[run[a]]
    ends = [(x[a[keep]], x[b[keep]])]
    for r in np.flatnonzero(dense | ~small):
        ends.append(_forest(x[starts[r]:starts[r] + sizes[r]], distance))
    return np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends])


def _compare(distance: int):
    """Task side: reads rows sorted by cell, a run at a time, with at most ``CELL`` rows of a run kept."""
    names = ["a", "b"]

    def rows(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        first = pa.array(a.view(np.int64))
        second = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([first, second], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((0, 2), np.uint64)  # of the run that may go on
        crowded = None  # the cell that has more than CELL rows
        for batch in batches:
            # The grid's number is mixed into the cell: a clash only compares more.
            grid = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            cell = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64) * np.uint64(2654435761) + grid
            new = np.column_stack([cell, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)])
            if crowded is not None:
                of_it = new[:, 0] == crowded
                if of_it.any():
                    yield rows(new[of_it, 1].copy(), None)
                    new = new[~of_it]
                if len(new):
                    crowded = None
            kept = np.concatenate([kept, new])
            if not len(kept):
                continue
            last = np.flatnonzero(np.r_[True, kept[1:, 0] != kept[:-1, 0]])[-1]
            done, kept = kept[:last], kept[last:]
            if len(done):
                yield from links(done)
            if len(kept) > CELL:
                crowded = kept[0, 0]
                yield rows(kept[:, 1].copy(), None)
                kept = kept[:0]
        if len(kept):
            yield from links(kept)

    def links(part: np.ndarray) -> Iterator[pa.RecordBatch]:
        cell, x = np.ascontiguousarray(part[:, 0]), np.ascontiguousarray(part[:, 1])
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sizes = np.diff(np.r_[starts, len(x)])
        for at, n in zip(starts[sizes > CELL], sizes[sizes > CELL], strict=True):
            yield rows(x[at:at + n], None)
        fits = np.repeat(sizes <= CELL, sizes)
        a, b = _links(cell[fits], x[fits], distance) if fits.any() else (x[:0], x[:0])
        if len(a):
            yield rows(np.ascontiguousarray(a), np.ascontiguousarray(b))

    return run


def _over_middles(points: DataFrame, distance: int) -> DataFrame:
    """Links ``a, b`` that join what all close pairs join, in proportion to the points.

    Two fingerprints are close exactly if some 64-bit string lies within half the distance of one and
    the rest of the other.  Each point names all such middles around it, and is linked to the smallest
    point of each.  Few points can share a middle, so no group is large.
    """
    radius = (distance + 1) // 2
    masks = [sum(1 << bit for bit in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    flips = F.array(*[F.lit(_signed(m)) for m in masks])
    around = points.select(F.col("a").alias("point"), F.explode(F.transform(
        flips, lambda m: F.col("a").bitwiseXOR(m))).alias("middle"))
    first = around.groupBy("middle").agg(F.min("point").alias("first"))
    pairs = around.join(first, "middle").where(F.col("point") != F.col("first"))
    exact = F.bit_count(F.col("point").bitwiseXOR(F.col("first"))) <= distance
    return pairs.where(exact).select(F.col("first").alias("a"), F.col("point").alias("b")).distinct()


def close_links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (``fp``) that join whatever close pairs join."""
    masks = grid_masks(distance, n_blocks(distance, fps.count()))
    embedded = fps.select("fp", unary_counts(F.col("fp")).alias("counts"))
    cells = embedded.select("fp", F.posexplode(F.transform(
        F.array(*[F.lit(m) for m in masks]), lambda m: F.col("counts").bitwiseAND(m))).alias("grid", "cell"))
    placed = cells.select("grid", "cell", "fp").repartition("grid", "cell").sortWithinPartitions("grid", "cell")
    found = cut(in_tasks(placed, _compare(distance), "a long, b long"))
    links = found.where(F.col("b").isNotNull())
    crowded = found.where(F.col("b").isNull()).select("a").distinct()
    if not crowded.isEmpty():
        if distance % 2:
            raise ValueError("middles are exact for even distances only")
        links = links.union(_over_middles(crowded, distance))
    return links.distinct()


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for every row of ``docs`` (``doc_id, text``).

    ``component_id`` is the smallest ``doc_id`` reachable over fingerprints that differ in at most
    ``distance`` bits, itself included; ``root`` is a fingerprint that names the component.  Equal
    texts, repeated rows and texts without words share a fingerprint and with it a component; so do
    rows with a null id, which name no component unless all of it are null.  Other columns are
    ignored; an empty table gives no row.

    Rows with one fingerprint are one point of the grid, whatever their number; within a cell only
    as many links are made as join its members.
    """
    marked = cut(fingerprints(docs, width))
    classes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(close_links(classes.select("fp"), distance))
    grouped = cut(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    # Settled first, so that both sides of the join are plain rows and a root with a large part of
    # all fingerprints can be split.
    smallest = cut(grouped.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = cut(grouped.select("fp", "root").join(smallest, "root"))
    return marked.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
