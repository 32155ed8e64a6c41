"""Source divergence audit: how the words of each source differ from those of others and of its language.

Frequencies come from single-pass in-memory indexing: a task counts postings of its texts until memory is
full and spills them as a run sorted by term, in pages by hash shard; each shard merges its runs with a
heap.  Pairs of sources start from what they would differ by if neither had any term, and the terms
that occur stream by as corrections.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.llm.common import broadcast_if_small, cut, in_tasks

#: Shares are counted in parts of this.
UNIT = 1_000_000_000
#: Entries (document and term; a new term or text counts as ``TERM`` more) in memory before a block is spilled.
BLOCK, TERM = 6_000_000, 10
#: Terms of a page of a run, merged terms before they are handed on, and bytes of a text that are split at once.
PAGE, FLUSH, PIECE = 512, 1 << 15, 1 << 20
#: Postings that one task corrects pairs by, cells of a table of pairs, and cells in work at once.
POSTINGS, CELLS, CHUNK = 200_000, 1 << 21, 1 << 18

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_STRING, _BINARY, _LONG = T.StringType(), T.BinaryType(), T.LongType()


def _schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


PAGES = _schema(
    shard=_LONG, lang=_STRING, first=_BINARY, terms=T.ArrayType(_BINARY), docs=T.ArrayType(_LONG),
    sizes=T.ArrayType(_LONG), sources=T.ArrayType(_STRING), counts=T.ArrayType(_LONG))
KEPT = _schema(lang=_STRING, term=_BINARY, sources=T.ArrayType(_STRING), counts=T.ArrayType(_LONG))
PAIRS = _schema(lang=_STRING, source=_STRING, item=_STRING, value=_LONG)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists; a long text is split where a term ends."""
    start = 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[start:end].translate(_FOLD).split()
        start = end


class Block:
    """Postings of one language in memory: which term of which document occurred how often."""

    def __init__(self) -> None:
        # A term's number is the number of terms before it.
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.sources: dict[str, int] = {}
        self.entries, self.held = 0, 0
        self.parts: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, source: str, text: bytes) -> None:
        counts: Counter[bytes] = Counter()
        for terms in terms_of(text):
            counts.update(terms)
        place, size = self.sources.setdefault(source, len(self.sources)), len(counts)
        self.parts.append((
            place, np.fromiter(map(self.numbers.__getitem__, counts), np.int64, size),
            np.fromiter(counts.values(), np.int64, size)))
        self.entries += size
        self.held = self.entries + TERM * (len(self.numbers) + len(self.parts))

    def pages(self, lang: str, shards: int, size: int = PAGE) -> Iterator[pa.RecordBatch]:
        """The run of this block: pages by hash shard, in each the terms in order."""
        terms = list(self.numbers)
        if not terms:
            return
        sizes = [len(ids) for _, ids, _ in self.parts]
        number = np.concatenate([ids for _, ids, _ in self.parts])
        source = np.repeat(np.array([place for place, _, _ in self.parts], np.int64), sizes)
        count = np.concatenate([counts for _, _, counts in self.parts])
        docs = np.bincount(number, minlength=len(terms))
        # Occurrences of one term in one source become one posting.
        key, count = summed(number * len(self.sources) + source, count)
        number, source = np.divmod(key, len(self.sources))
        width = np.bincount(number, minlength=len(terms))
        salt = zlib.crc32(lang.encode("utf-8", "surrogatepass"))
        shard = np.array([zlib.crc32(t, salt) for t in terms], np.int64) % shards
        rank = np.empty(len(terms), np.int64)
        rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
        run = np.lexsort((rank, shard))
        # Where the postings of each term of the run lie, and the pages it is cut into.
        first = np.cumsum(width) - width
        width = width[run]
        ends = np.cumsum(width)
        postings = np.arange(ends[-1]) - np.repeat(ends - width, width) + np.repeat(first[run], width)
        breaks = [*np.flatnonzero(np.diff(shard[run], prepend=-1)).tolist(), len(run)]
        cuts = np.array([at for lo, hi in zip(breaks, breaks[1:]) for at in range(lo, hi, size)] + [len(run)])
        by_term, by_posting = pa.array(cuts, pa.int32()), pa.array(np.append(0, ends)[cuts], pa.int32())
        texts = pa.array(terms, pa.binary()).take(pa.array(run))
        names = pa.array(list(self.sources), pa.string())
        yield pa.RecordBatch.from_arrays([
            pa.array(shard[run][cuts[:-1]]), pa.array([lang] * (len(cuts) - 1), pa.string()),
            texts.take(pa.array(cuts[:-1])), pa.ListArray.from_arrays(by_term, texts),
            pa.ListArray.from_arrays(by_term, pa.array(docs[run])), pa.ListArray.from_arrays(by_term, pa.array(width)),
            pa.ListArray.from_arrays(by_posting, names.take(pa.array(source[postings]))),
            pa.ListArray.from_arrays(by_posting, pa.array(count[postings]))], PAGES.names)


def summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    order = np.argsort(key, kind="stable")
    key, starts = np.unique(key[order], return_index=True)
    return key, np.add.reduceat(count[order], starts) if len(key) else count[:0]


def spill_runs(batches: Iterator[pa.RecordBatch], shards: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of one task, from its texts (lang, source, text): the fullest block is spilled when all
    together hold ``limit`` entries, which one text may pass."""
    blocks: dict[str, Block] = {}
    held = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = batch.column(2)
        for i, (lang, source) in enumerate(zip(langs, sources, strict=True)):
            block = blocks.setdefault(lang, Block())
            held -= block.held
            block.add(source, texts[i].as_py())
            held += block.held
            while held >= limit:
                fullest = max(blocks, key=lambda name: blocks[name].held)
                held -= blocks[fullest].held
                yield from blocks.pop(fullest).pages(fullest, shards)
    for lang, block in blocks.items():
        yield from block.pages(lang, shards)


class Page:
    """A page that is being merged: its terms are taken in order and told their number."""

    def __init__(self, terms: list[bytes], docs: np.ndarray, sizes: np.ndarray, sources: np.ndarray, counts: np.ndarray) -> None:
        self.terms, self.docs, self.sizes, self.sources, self.counts = terms, docs, sizes, sources, counts
        self.given: list[int] = []
        self.done, self.offset = 0, 0

    def taken(self) -> tuple[np.ndarray, ...]:
        """Numbers and documents of the terms taken since the last time, and their postings."""
        end = self.done + len(self.given)
        number, docs, sizes = np.array(self.given, np.int64), self.docs[self.done:end], self.sizes[self.done:end]
        last = self.offset + int(sizes.sum())
        part = slice(self.offset, last)
        self.done, self.offset, self.given = end, last, []
        return number, docs, np.repeat(number, sizes), self.sources[part], self.counts[part]


class Merge:
    """Merges the runs of one language with a heap, page by page.

    A page is opened when the merge gets to its first term and let go after its last: memory holds one
    page or two of each run, and ``FLUSH`` merged terms.
    """

    def __init__(self, lang: str, least: int) -> None:
        self.lang, self.least = lang, least
        self.heap: list[tuple[bytes, int]] = []
        self.pages: dict[int, Page] = {}
        self.names: dict[str, int] = {}
        self.terms: list[bytes] = []
        self.serial = 0

    def open(self, row: dict[str, pa.Scalar]) -> Iterator[pa.RecordBatch]:
        """Takes a page, after all terms before its first one; pages come in order of that."""
        found = row["sources"].values.dictionary_encode()
        codes = np.array([self.names.setdefault(n, len(self.names)) for n in found.dictionary.to_pylist()], np.int64)
        page = Page(
            row["terms"].values.to_pylist(), row["docs"].values.to_numpy(), row["sizes"].values.to_numpy(),
            codes[found.indices.to_numpy()], row["counts"].values.to_numpy())
        yield from self.below(page.terms[0])
        self.pages[self.serial] = page
        heapq.heappush(self.heap, (page.terms[0], self.serial))
        self.serial += 1

    def below(self, limit: bytes | None) -> Iterator[pa.RecordBatch]:
        heap = self.heap
        while heap and (limit is None or heap[0][0] < limit):
            term, serial = heap[0]
            if not self.terms or term != self.terms[-1]:
                if len(self.terms) >= FLUSH:
                    yield self.flush()
                self.terms.append(term)
            page = self.pages[serial]
            page.given.append(len(self.terms) - 1)
            at = page.done + len(page.given)
            if at < len(page.terms):
                heapq.heapreplace(heap, (page.terms[at], serial))
            else:
                heapq.heappop(heap)

    def flush(self) -> pa.RecordBatch:
        """The merged terms that enough documents hold, with their occurrences by source."""
        parts = [page.taken() for page in self.pages.values()]
        self.pages = {serial: page for serial, page in self.pages.items() if page.done < len(page.terms)}
        number, docs, owner, source, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        total = np.zeros(len(self.terms), np.int64)
        np.add.at(total, number, docs)
        enough = total >= self.least
        live = enough[owner]
        key, count = summed(owner[live] * len(self.names) + source[live], count[live])
        owner, source = np.divmod(key, len(self.names))
        kept = np.flatnonzero(enough)
        ends = pa.array(np.searchsorted(owner, np.append(kept, len(self.terms))), pa.int32())
        names = pa.array(list(self.names), pa.string())
        result = pa.RecordBatch.from_arrays([
            pa.array([self.lang] * len(kept), pa.string()), pa.array([self.terms[i] for i in kept.tolist()], pa.binary()),
            pa.ListArray.from_arrays(ends, names.take(pa.array(source))),
            pa.ListArray.from_arrays(ends, pa.array(count))], KEPT.names)
        self.terms = []
        return result

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.below(None)
        if self.terms:
            yield self.flush()


def merge_runs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Merged terms of all languages, from pages in order of language and first term."""
    merge: Merge | None = None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
            lang = row["lang"].as_py()
            if merge is None or merge.lang != lang:
                if merge is not None:
                    yield from merge.end()
                merge = Merge(lang, least)
            yield from merge.open(row)
    if merge is not None:
        yield from merge.end()


def term_frequencies(docs: DataFrame, least: int, block: int = BLOCK) -> DataFrame:
    """``lang, term, sources, counts``: the terms that at least ``least`` documents of a language hold."""
    spark = docs.sparkSession
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))

    runs = in_tasks(texts, lambda batches: spill_runs(batches, shards, block), PAGES)
    runs = runs.repartition(shards, "shard").sortWithinPartitions("lang", "first")
    return in_tasks(runs, lambda batches: merge_runs(batches, least), KEPT)


def share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / total), exactly."""
    large = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.when(
        count < (1 << 63) // UNIT - 1, F.call_function("div", F.lit(UNIT).cast("long") * (count + 1), total)
    ).otherwise(F.call_function("div", large, total.cast("decimal(20,0)"))) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """As ``share``, by long division in steps of 1000, so that nothing leaves 64 bits."""
    whole, rest = np.divmod(counts + 1, totals)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + digit
    return whole + 1


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Postings(NamedTuple):
    """Occurrences: the source's number, the count, and where the occurrences of the same term start and end."""

    source: np.ndarray
    count: np.ndarray
    start: np.ndarray
    end: np.ndarray


def pair_sums(totals: np.ndarray, low: int, high: int, found: Postings, base: int) -> np.ndarray:
    """For sources ``low`` to ``high`` against all: the sum of divergences over ``base`` terms that none
    has, corrected by the terms of ``found`` as far as they differ from that.
    """
    none = shares(np.zeros(len(totals), np.int64), totals)
    mine = none[low:high]
    table = base * divergences(mine[:, None], none[None, :])
    # Terms that one of the two has, as if the other had none: by distinct counts.
    kinds, times = np.unique(np.column_stack([found.source, found.count]), axis=0, return_counts=True)
    step = max(1, CHUNK // len(totals))
    for at in range(0, len(kinds), step):
        source, n = kinds[at:at + step, 0], times[at:at + step]
        p = shares(kinds[at:at + step, 1], totals[source])
        own = (source >= low) & (source < high)
        change = divergences(p[own, None], none[None, :]) - divergences(none[source[own], None], none[None, :])
        np.add.at(table, source[own] - low, change * n[own, None])
        change = divergences(mine[:, None], p[None, :]) - divergences(mine[:, None], none[None, source])
        np.add.at(table.T, source, (change * n[None, :]).T)
    # Terms that both have: what the two corrections got wrong.
    p = shares(found.count, totals[found.source])
    rows = np.flatnonzero((found.source >= low) & (found.source < high) & (found.end - found.start > 1))
    ends = np.cumsum(found.end[rows] - found.start[rows])
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
        chunk = rows[at:to]
        sizes = found.end[chunk] - found.start[chunk]
        one = np.repeat(chunk, sizes)
        other = np.arange(len(one)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(found.start[chunk], sizes)
        a, b = found.source[one], found.source[other]
        change = (
            divergences(p[one], p[other]) - divergences(p[one], none[b])
            - divergences(none[a], p[other]) + divergences(none[a], none[b]))
        np.add.at(table, (a - low, b), change)
        at = to
    return table


def _pair_rows(key: tuple, groups: pa.Table, kept: pa.Table) -> pa.Table:
    """The sums of one piece of a language's terms for one band of its sources."""
    lang, piece, band = key[0].as_py(), key[1].as_py(), key[2].as_py()
    order = sorted(zip(groups["source"].to_pylist(), groups["n"].to_pylist(), strict=True))
    names, terms = [s for s, _ in order], groups["n_terms"][0].as_py()
    height = max(1, CELLS // len(names))
    low, high = band * height, min(len(names), (band + 1) * height)
    totals = np.array([n for _, n in order], np.int64) + terms
    sizes = pc.list_value_length(kept["sources"]).to_numpy().astype(np.int64)
    source = pc.index_in(pc.list_flatten(kept["sources"]), value_set=pa.array(names, pa.string())).to_numpy().astype(np.int64)
    count = pc.list_flatten(kept["counts"]).to_numpy()
    end = np.repeat(np.cumsum(sizes), sizes)
    found = Postings(source, count, end - np.repeat(sizes, sizes), end)
    if terms:
        table = pair_sums(totals, low, high, found, terms if piece == 0 else 0)
    else:
        table = np.zeros((high - low, len(names)), np.int64)
    wanted = np.ones(table.shape, bool) if piece == 0 else table != 0
    wanted[np.arange(high - low), np.arange(low, high)] = False
    a, b = np.nonzero(wanted)
    texts = pa.array(names, pa.string())
    return pa.table({
        "lang": pa.array([lang] * len(a), pa.string()), "source": texts.take(pa.array(a + low)),
        "item": texts.take(pa.array(b)), "value": pa.array(table[a, b], pa.int64())})


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value",
        F.row_number().over(order).cast("int").alias("rank"))


def audit_sources(docs: DataFrame, least: int = 3, top: int = 200, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergences between the sources of each language of ``docs``
    (``text, lang, source``), and the terms that set a source apart from its language.

    A term counts if at least ``least`` documents (rows) of the language hold it.  Part ``pair`` has every
    other source of the language, summed over all terms; part ``term`` the ``top`` terms that the source
    uses more than its language.  Ranks go by value, largest first, then by item in UTF-8 order.  Null
    text, lang or source counts as empty; a group without terms is compared as well; repeated rows count
    each; texts of any length are split in pieces; other columns are ignored; an empty table gives no row.
    Exact while a language has fewer than 2 * 10^9 terms and 9 * 10^15 occurrences.

    A pair's row is needed for each two sources, so time and result grow with their square; memory does not,
    as tables of pairs come in bands.
    """
    empty = F.lit("")
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    kept = cut(term_frequencies(named, least, block).withColumn("term", F.col("term").cast("string")))
    sizes = kept.select(
        "lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"), F.size("counts").alias("postings"))
    langs = sizes.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("n_lang"), F.sum("postings").alias("postings"))
    postings = kept.select(
        "lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("in_lang"),
        F.explode(F.arrays_zip("sources", "counts")).alias("posting")
    ).select("lang", "term", "in_lang", F.col("posting.sources").alias("source"), F.col("posting.counts").alias("count"))
    totals = postings.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = cut(
        named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .fillna(0, ["n", "n_terms", "n_lang", "postings"]))
    known = broadcast_if_small(groups)
    p = share(F.col("count"), F.col("n") + F.col("n_terms"))
    q = share(F.col("in_lang"), F.col("n_lang") + F.col("n_terms"))
    apart = (
        postings.join(known, ["lang", "source"]).withColumns({"p": p, "q": q}).where(F.col("p") > F.col("q"))
        .select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    )
    ranked = _ranked(apart, "term").where(F.col("rank") <= top)
    # Each language in pieces of its postings and bands of its sources.
    shape = groups.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_sources"), (F.floor(F.max("postings") / POSTINGS) + 1).cast("int").alias("pieces"))
    shape = shape.where(F.col("n_sources") > 1).withColumn(
        "bands", F.ceil(F.col("n_sources") / F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("n_sources")))).cast("int"))
    shape = broadcast_if_small(cut(shape))

    def every(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    left = (
        groups.join(shape, "lang").withColumn("band", every("bands")).withColumn("piece", every("pieces"))
        .select("lang", "piece", "band", "source", "n", "n_terms"))
    right = (
        kept.join(shape, "lang").withColumn("piece", F.pmod(F.xxhash64("term"), F.col("pieces")).cast("int"))
        .withColumn("band", every("bands")).select("lang", "piece", "band", "sources", "counts"))
    keys = ["lang", "piece", "band"]
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_pair_rows, PAIRS)
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(pairs, "pair").unionByName(ranked)


