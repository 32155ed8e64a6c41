"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share seeds (runs of ``LEAST`` words) become pairs; a pair's item
is tiled with the longest matches that do not overlap, found by running Karp-Rabin.  Tiles may stand
in any order, so a reordered passage counts like one in order.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.llm.common import cut, in_tasks
from careflow.operators import hashed
from careflow.operators.hashed import mixed, passes, unpacked

#: Words of the shortest tile, and the share of an item's words that tiles must cover.
LEAST = 5
COVERAGE = 0.8
#: Pairs of equal windows that are looked at together.
PAIRS = 1 << 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_BASE = 0x9E3779B97F4A7C15
_IN_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


class WordHasher:
    """Hashes of all words of a text at once: differences of running polynomials over its bytes."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size >= len(self.powers):
            size = max(1 << 16, 2 * size)
            inverse = pow(_BASE, -1, 1 << 64)
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, np.uint64)])
            self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(size, inverse, np.uint64)])

    def __call__(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        self._grow(len(data))
        inside = np.r_[False, _IN_WORD[data], False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        running = np.cumsum(np.r_[np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * self.powers[:len(data)]])
        return mixed((running[ends] - running[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))


def rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``width`` words."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    words = words.astype(np.uint64, copy=False)
    running = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        running = running * np.uint64(_BASE) + words[i:len(words) - width + 1 + i]
    return mixed(running)


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _windows(hashes: np.ndarray, free: np.ndarray, width: int) -> np.ndarray:
    """Starts of windows without a marked word, for hashes of all windows."""
    marked = np.cumsum(np.r_[0, ~free])
    return np.flatnonzero(marked[width:] == marked[:-width])[:len(hashes)] if len(hashes) else np.empty(0, np.int64)


def _matches(item, doc, free_item, free_doc, width: int) -> Iterator[tuple[int, int, int]]:
    """All longest matches (length, item start, doc start) of at least ``width`` unmarked words."""
    item_hash, doc_hash = rolled(item, width), rolled(doc, width)
    of_item, of_doc = _windows(item_hash, free_item, width), _windows(doc_hash, free_doc, width)
    order = of_item[np.argsort(item_hash[of_item], kind="stable")]
    keys = item_hash[order]
    low = np.searchsorted(keys, doc_hash[of_doc], side="left")
    count = np.searchsorted(keys, doc_hash[of_doc], side="right") - low
    hit = count > 0
    of_doc, low, count = of_doc[hit], low[hit], count[hit]
    total = np.cumsum(count)
    at = 0
    while at < len(of_doc):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        n = count[at:upto]
        j = np.repeat(of_doc[at:upto], n)
        i = order[np.repeat(low[at:upto], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        at = upto
        # A match that could start earlier is found there.
        back = (i > 0) & (j > 0)
        back[back] = (item[i[back] - 1] == doc[j[back] - 1]) & free_item[i[back] - 1] & free_doc[j[back] - 1]
        i, j = i[~back], j[~back]
        size = np.zeros(len(i), np.int64)
        going = np.arange(len(i))
        while len(going):
            x, y = i[going] + size[going], j[going] + size[going]
            inside = (x < len(item)) & (y < len(doc))
            going, x, y = going[inside], x[inside], y[inside]
            same = (item[x] == doc[y]) & free_item[x] & free_doc[y]
            going = going[same]
            size[going] += 1
        for a, b, c in zip(size.tolist(), i.tolist(), j.tolist(), strict=True):
            if a >= width:
                yield a, b, c


def tiles(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy tiling: (item start, doc start, length), longest first, none overlapping another.

    Equal lengths are settled by place in the item, then in the document.  The search length starts
    above and shrinks to ``least``; it grows again at once if much longer matches turn up.
    """
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    made = []
    width = max(least, min(len(item), len(doc), 4 * least))
    while len(item) >= least and len(doc) >= least:
        found = [(-n, i, j) for n, i, j in _matches(item, doc, free_item, free_doc, width)]
        longest = -min(found, default=(0,))[0]
        if longest > 2 * width:
            width = longest
            continue
        heapq.heapify(found)
        while found:
            n, i, j = heapq.heappop(found)
            n = -n
            free = free_item[i:i + n] & free_doc[j:j + n]
            if free.all():
                made.append((i, j, n))
                free_item[i:i + n] = free_doc[j:j + n] = False
                continue
            # What earlier tiles left of this match waits for its turn.
            edges = np.flatnonzero(np.diff(np.r_[False, free, False].astype(np.int8)))
            for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if end - start >= width:
                    heapq.heappush(found, (start - end, i + start, j + start))
        if width == least:
            break
        width = max(least, width // 2)
    return made


def _item_seeds(items: DataFrame, coverage: float, least: int) -> DataFrame:
    """``item_id, item_key, width, seed, n, fewest, distinct``: hashed runs of words and how often each occurs.

    A run has ``least`` words; a shorter item is one run as a whole.  Tiles that cover the share hold
    at least ``fewest`` of the item's runs, which are at least ``distinct`` different ones.
    """
    schema = T.StructType([
        items.schema["item_id"], T.StructField("item_key", T.LongType()), T.StructField("width", T.IntegerType()),
        T.StructField("seed", T.LongType()), T.StructField("n", T.IntegerType()),
        T.StructField("fewest", T.IntegerType()), T.StructField("distinct", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            owner, numbers = [], []
            for at, text in enumerate(batch.column(2)):
                words = hasher(lowered(text.as_py()))
                width = max(1, min(least, len(words)))
                seeds, n = np.unique(rolled(words, width), return_counts=True)
                fewest = -(-math.ceil(len(words) * coverage - 1e-9) // width)
                distinct = 1 + int(np.searchsorted(np.cumsum(np.sort(n)[::-1]), fewest))
                owner += [at] * len(seeds)
                numbers.append(np.column_stack([
                    seeds.view(np.int64), n, *(np.full(len(seeds), k) for k in (width, fewest, distinct))]))
            if not owner:
                continue
            seed, n, width, fewest, distinct = np.concatenate(numbers).astype(np.int64).T
            taken = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(taken), batch.column(1).take(taken), pa.array(width.astype(np.int32)),
                pa.array(np.ascontiguousarray(seed)),
                *(pa.array(k.astype(np.int32)) for k in (n, fewest, distinct))], schema.names)

    return in_tasks(items, run, schema)


def _suspects(docs: DataFrame, widths: list[int], fewest: int, keep: bytes) -> DataFrame:
    """``doc_id, doc_key, text, seeds`` of documents with at least ``fewest`` seeds that pass the filter."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("doc_key", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("seeds", T.ArrayType(T.LongType()))])
    bits = docs.sparkSession.sparkContext.broadcast(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        known = unpacked(bits.value)
        for batch in batches:
            owner, seeds = [], []
            for at, text in enumerate(batch.column(2)):
                words = hasher(lowered(text.as_py()))
                own = np.concatenate([rolled(words, w) for w in widths])
                own = np.unique(own[passes(own, known)])
                if len(own) >= fewest:
                    owner.append(at)
                    seeds.append(own.view(np.int64))
            if owner:
                ends = np.cumsum([0, *map(len, seeds)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(seeds)))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(owner)) for c in batch.columns), lists], schema.names)

    return in_tasks(docs, run, schema)


def _tiled(pairs: DataFrame, least: int) -> DataFrame:
    """``doc_id, doc_key, item_id, n_words, n_covered, n_tiles`` of pairs with both texts."""
    schema = T.StructType([
        pairs.schema["doc_id"], pairs.schema["doc_key"], pairs.schema["item_id"], T.StructField("n_words", T.IntegerType()),
        T.StructField("n_covered", T.IntegerType()), T.StructField("n_tiles", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, item_text in zip(batch.column(3), batch.column(4), strict=True):
                item_words = WORD.findall(lowered(item_text.as_py()))
                ids: dict[bytes, int] = {}
                item = np.array([ids.setdefault(w, len(ids)) for w in item_words], np.int64)
                doc = np.array([ids.get(w, -1) for w in WORD.findall(lowered(text.as_py()))], np.int64)
                made = tiles(item, doc, max(1, min(least, len(item))))
                found.append((len(item), sum(n for _, _, n in made), len(made)))
            numbers = [pa.array(c, pa.int32()) for c in zip(*found, strict=True)] or [pa.array([], pa.int32())] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *numbers], schema.names)

    return in_tasks(pairs.select("doc_id", "doc_key", "item_id", "text", "item_text"), run, schema)


def contaminated(
    docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, least: int = LEAST
) -> DataFrame:
    """``doc_id, item_id, n_words, n_covered, n_tiles`` for pairs whose tiles cover at least
    ``coverage`` of the item's words.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``.  Words are runs of letters, digits and
    non-ASCII characters of the lower-cased text.  An item of fewer than ``least`` words must occur as a
    whole.  Null and empty texts match nothing; rows with a null id are left out, having no name to be
    reported by; if rows repeat an id, the best covered pair of their texts counts; other columns are
    ignored; an empty table gives no row.

    Documents are hashed where they are, in one pass; only those with enough seeds that pass a filter of
    the benchmark's seeds, sized by their number, go on.  If there are more seeds than the largest filter is
    for, items are taken in rounds, each with a filter and a pass of its own.  Tiles of ``least`` words or more that cover the share
    hold at least that share over ``least`` of the item's runs as seeds, so other pairs need no tiling.
    Runs that an item repeats are one seed, so documents are held to the fewest different ones of any item.
    """
    best = F.max(F.struct(
        (F.col("n_covered") / F.col("n_words")).alias("share"), "n_words", "n_covered",
        (-F.col("n_tiles")).alias("fewer")))
    return (
        _covered(docs.where(F.col("doc_id").isNotNull()), items, coverage, least)
        .groupBy("doc_id", "item_id").agg(best.alias("best"))
        .select("doc_id", "item_id", "best.n_words", "best.n_covered", (-F.col("best.fewer")).alias("n_tiles"))
    )


def contaminated_texts(
    docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, least: int = LEAST
) -> DataFrame:
    """``doc_id, doc_key`` (xxhash64 of the text), once each, of all rows that are part of such a pair,
    null ids included."""
    return _covered(docs, items, coverage, least).select("doc_id", "doc_key").distinct()


def _covered(docs: DataFrame, items: DataFrame, coverage: float, least: int) -> DataFrame:
    """``doc_id, doc_key, item_id, n_words, n_covered, n_tiles`` of pairs of texts, any id."""
    key = F.xxhash64("text")
    docs = docs.where(F.length("text") > 0).select("doc_id", key.alias("doc_key"), "text")
    items = (
        items.where(F.col("item_id").isNotNull() & (F.length("text") > 0))
        .select("item_id", key.alias("item_key"), "text").distinct()
    )
    seeds = cut(_item_seeds(items, float(coverage), least))
    shape = seeds.agg(
        F.collect_set("width").alias("widths"), F.min("distinct").alias("distinct"), F.count("*").alias("n")).first()
    rounds = max(1, -(-shape["n"] // hashed.MOST_HASHES))
    widths, distinct = sorted(shape["widths"]) or [least], max(1, shape["distinct"] or 1)
    bits = hashed.filter_bits(-(-shape["n"] // rounds))
    turn = F.pmod(F.xxhash64("item_id", "item_key"), F.lit(rounds))
    found = []
    for i in range(rounds):
        now = seeds if rounds == 1 else seeds.where(turn == i)
        keep = hashed.bit_filter(now, "seed", bits)
        found.append(_tiled(_pairs(cut(_suspects(docs, widths, distinct, keep).distinct()), now, items), least))
    return reduce(DataFrame.unionAll, found).where(
        F.col("n_covered") >= F.ceil(F.col("n_words") * F.lit(float(coverage)) - 1e-9))


def _pairs(suspects: DataFrame, seeds: DataFrame, items: DataFrame) -> DataFrame:
    """Documents and items, with both texts, that share as many seeds as coverage takes."""
    texts = suspects.select(F.col("doc_id").alias("text_id"), F.col("doc_key").alias("text_key"), "text")
    return (
        suspects.select("doc_id", "doc_key", F.explode("seeds").alias("seed"))
        .join(seeds, "seed").groupBy("doc_id", "doc_key", "item_id", "item_key")
        .agg(F.sum("n").alias("hits"), F.first("fewest").alias("fewest"))
        .where(F.col("hits") >= F.col("fewest"))
        .join(texts, F.col("doc_id").eqNullSafe(F.col("text_id")) & (F.col("doc_key") == F.col("text_key")))
        .join(items.withColumnRenamed("text", "item_text"), ["item_id", "item_key"])
    )
