"""Rows whose text holds any term of a vocabulary table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.functions.naming import quoted
from careflow.operators.filters import keyed_rows
from careflow.operators.hashed import MOST_HASHES, bit_filter, filter_bits, passes, unpacked, window_hashes
from careflow.shipping import ship

# Testing every term against every text is for short lists only.
MAX_NESTED_TERMS = 64
MAX_NESTED_BYTES = 1 << 20

# A longer vocabulary is looked up by one window of each term: of as many bytes as the largest of
# these that a term has.
ANCHOR_BYTES = (1, 2, 4, 8, 16, 32)
# Bytes of a text that are hashed at a time.
BLOCK = 1 << 20
# Counters of the sketch that tells rare windows, and texts that are looked at for it besides all
# terms.  Which window stands for a term has no influence on the result.
SKETCH_BITS = 18
SKETCH_TEXTS = 1000


def keyword_semijoin(
    df: DataFrame,
    text: str,
    vocabulary: DataFrame,
    term: str,
    row_key: Sequence[str],
    max_nested_terms: int = MAX_NESTED_TERMS,
) -> DataFrame:
    """Left-semi join on ``contains(text, term)``; ``row_key`` identifies a row of ``df``, null
    being a value like any other.

    The vocabulary is measured.  A short one is tested term by term inside the scan's stage.  Any
    other is joined by hashed anchors.  Both give the same rows; the measure picks a plan.
    """
    terms = keyed_rows(vocabulary.select(F.col(quoted(term)).alias("_term")), "_term").distinct()
    size = terms.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.octet_length("_term")), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.octet_length("_term")), F.lit(0)).alias("longest"),
        F.count_if(F.col("_term") == "").alias("blank"),
        F.collect_set(_anchor_bytes()).alias("used"),  # at most six
    ).first()
    if size.blank:
        return df.filter(F.col(quoted(text)).isNotNull())
    if size.n == 0 or (size.n <= min(max_nested_terms, MAX_NESTED_TERMS) and size.bytes <= MAX_NESTED_BYTES):
        return df.join(
            F.broadcast(terms), F.contains(F.col(quoted(text)), F.col("_term")), "left_semi"
        )
    return _anchored_semijoin(df, text, terms, row_key, tuple(sorted(size.used)), size.n)


def _anchor_bytes() -> Column:
    size = F.octet_length("_term")
    return F.array_max(F.array(*[F.when(size >= n, F.lit(n)) for n in ANCHOR_BYTES]))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """All values of the first column, joined and cut into blocks."""
    held, size = [], 0
    for batch in batches:
        for value in batch.column(0):
            held.append(value.as_py())
            size += len(held[-1]) + 1
            if size >= BLOCK:
                whole = b"\0".join(held)
                yield from (whole[i:i + BLOCK] for i in range(0, len(whole), BLOCK))
                held, size = [], 0
    yield b"\0".join(held)


def _sketch(values: DataFrame, used: tuple[int, ...]) -> np.ndarray:
    """How often windows occur, by the low bits of their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for chunk in _chunks(batches):
            for hashes in window_hashes(chunk, used).values():
                counts += np.bincount(_counter(hashes), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at])], ["at", "n"])

    met = values.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    counts[met["at"].to_numpy()] = met["n"].to_numpy()
    return counts


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _rarest(term: bytes, n: int, counts: np.ndarray) -> tuple[int, int]:
    """Place and hash of the window of ``n`` bytes that is met least; of several the first."""
    hashes = window_hashes(term, (n,))[n]
    at = int(np.argmin(counts[_counter(hashes)]))
    return at, int(hashes[at:at + 1].view(np.int64)[0])


def _anchored_terms(terms: DataFrame, counts: Broadcast) -> DataFrame:
    """Each term with the hash of its rarest window, the window's size and where in the term it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [_rarest(w, n, counts.value) for w, n in zip(words, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for _, h in found], pa.int64()), batch.column(1),
                 pa.array([at for at, _ in found], pa.int32()), batch.column(0)],
                ["_anchor", "_bytes", "_offset", "_term"])

    binary = terms.select(F.col("_term").cast("binary").alias("_term"), _anchor_bytes().alias("_bytes"))
    return binary.mapInArrow(run, "_anchor long, _bytes int, _offset int, _term binary")


def _pieces(text: bytes, spans: dict[int, tuple[int, int]], known: np.ndarray) -> set[tuple[int, int, bytes]]:
    """Where a term could be: (anchor, its place in the piece, piece), each once.

    ``spans`` has, by size of window, how many bytes of a term lie before a window and from it on.
    """
    found: set[tuple[int, int, bytes]] = set()
    most = max(before for before, _ in spans.values())
    reach = max(after for _, after in spans.values())
    for start in range(0, len(text), BLOCK):
        lead = min(start, most)
        part = text[start - lead:start + BLOCK + reach]
        for n, hashes in window_hashes(part[lead:], tuple(spans)).items():
            before, after = spans[n]
            at = passes(hashes[:BLOCK], known)
            if before + after <= 8 and len(at):
                # Short pieces as numbers; those that the text's beginning cuts off are kept apart.
                padded = np.frombuffer(part + bytes(after), np.uint8)
                windows = np.lib.stride_tricks.sliding_window_view(padded, before + after)
                whole = at[at + lead >= before]
                numbers = windows[whole + lead - before].dot(256 ** np.arange(before + after, dtype=np.uint64))
                at = np.r_[at[at + lead < before], whole[np.unique(numbers, return_index=True)[1]]]
            places = (at + lead).tolist()
            found.update(
                (h, min(i, before), part[max(i - before, 0):i + after])
                for h, i in zip(hashes[at].view(np.int64).tolist(), places, strict=True))
    return found


def _anchored_semijoin(
    df: DataFrame, text: str, terms: DataFrame, row_key: Sequence[str], used: tuple[int, ...], n: int
) -> DataFrame:
    """Find where a term could be, then compare the text around.

    A term is looked up by its rarest window, so terms with a common beginning don't meet all its
    places.  Texts stay where they are: windows of the (at most six) sizes are hashed and tested against
    a Bloom filter of the terms' anchors, sized by their number; a vocabulary too large for one filter
    is looked up in rounds.  Only pieces that pass, each once per text, are joined with the terms, by
    anchor.  AQE splits an anchor that is common to many texts.
    """
    spark = df.sparkSession
    ship(spark)
    keys = [f"_k{i}" for i in range(len(row_key))]
    rows = df.select(
        *[F.col(quoted(k)).alias(n) for k, n in zip(row_key, keys, strict=True)],
        F.col(quoted(text)).cast("binary").alias("_text"),
    ).filter(F.length("_text") > 0)
    looked_at = rows.select("_text").limit(SKETCH_TEXTS)
    counts = _sketch(looked_at.unionAll(terms.select(F.col("_term").cast("binary"))), used)
    anchored = _anchored_terms(terms, spark.sparkContext.broadcast(counts))
    rounds = -(-n // MOST_HASHES)
    bits = filter_bits(-(-n // rounds))
    found = []
    for i in range(rounds):
        part = anchored if rounds == 1 else anchored.filter(F.pmod(F.xxhash64("_anchor"), F.lit(rounds)) == i)
        found.append(_found(rows, part, bits, keys))
    matched = reduce(DataFrame.unionAll, found).distinct()
    return df.join(matched, reduce(and_, _same(row_key, keys)), "left_semi")


def _found(rows: DataFrame, anchored: DataFrame, bits: int, keys: Sequence[str]) -> DataFrame:
    """Keys of the rows that hold any of the terms; a row may come several times."""
    spans = {r[0]: (r[1], r[2]) for r in anchored.groupBy("_bytes").agg(
        F.max("_offset"), F.max(F.length("_term") - F.col("_offset"))).collect()}  # at most six
    if not spans:
        return rows.select(*keys).limit(0)
    known = rows.sparkSession.sparkContext.broadcast(bit_filter(anchored, "_anchor", bits))
    schema = T.StructType([
        *rows.schema.fields[:-1], T.StructField("_anchor", T.LongType()), T.StructField("_at", T.IntegerType()),
        T.StructField("_piece", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = unpacked(known.value)
        for batch in batches:
            owner, anchors, places, pieces = [], [], [], []
            for i, value in enumerate(batch.column(batch.num_columns - 1)):
                own = _pieces(value.as_py(), spans, bloom)
                owner += [i] * len(own)
                anchors += [a for a, _, _ in own]
                places += [at for _, at, _ in own]
                pieces += [p for _, _, p in own]
            if owner:
                taken = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(taken) for c in batch.columns[:-1]), pa.array(anchors, pa.int64()),
                     pa.array(places, pa.int32()), pa.array(pieces, pa.binary())], schema.names)

    start = F.col("_at") - F.col("_offset")
    return (
        rows.mapInArrow(run, schema).join(anchored.drop("_bytes"), "_anchor")
        .filter((start >= 0) & (F.substring("_piece", start + 1, F.length("_term")) == F.col("_term")))
        .select(*keys)
    )


def _same(row_key: Sequence[str], keys: Sequence[str]) -> list[Column]:
    return [F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in zip(row_key, keys, strict=True)]
