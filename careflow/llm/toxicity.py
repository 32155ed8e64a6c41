"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text, one of toxic and one of ordinary documents.
Both hold the same frequent words; each ends with the word beginnings that set its class apart.  Every
window of a text is compressed with both, and how much shorter the toxic dictionary makes it is
its distance.  Thresholds on the distances are calibrated into one probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.llm.common import (
    Calibration, calibrate, cut, fold, in_tasks, label_of, sample_by_class, text_rows, texts_of,
)

#: Bound of the labelled sample, documents of each label.
SAMPLE_DOCS = 2500
#: Bytes of a window; it ends with a word.
WINDOW = 40
#: Frequent words in both dictionaries; word beginnings of one class; their bytes, blank included.
COMMON_WORDS = 3000
CLASS_SEGMENTS = 96
SEGMENT_BYTES = (5, 11)
#: A beginning must differ by so many standard errors between the classes; so many are looked at at a time.
LEAST_CONTRAST = 6.0
SEGMENTS = "segment binary, n0 long, n1 long"
CANDIDATES = 3000
#: A toxic document speaks for so many beginnings: copies of one text can't fill the dictionary.
VOICES = 3
THRESHOLD = 0.3
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    probability: Calibration


def plain(text: str) -> bytes:
    """Lower-cased words, one blank before and after each."""
    return b" " + b" ".join(WORD.findall(text.lower().encode("utf-8", "replace"))) + b" "


def windows(words: bytes) -> list[bytes]:
    """The whole text in windows; each starts with the blank that ends the one before."""
    found, at, end = [], 0, len(words) - 1
    while at < end:
        to = words.find(b" ", at + WINDOW, at + 4 * WINDOW)
        if to < 0:
            to = min(end, at + 4 * WINDOW)
        found.append(words[at:to + 1])
        at = to
    return found


def compressor(dictionary: bytes):
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=15, chain_log=15, search_log=5, min_match=5, target_length=24,
        strategy=zstandard.STRATEGY_LAZY2, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=data).compress


def features(text: str, ordinary, toxic) -> list[float]:
    """What the calibration sees of a text: its windows' distances."""
    parts = windows(plain(text))
    d = np.array([len(ordinary(w)) - len(toxic(w)) for w in parts] or [0])
    return [
        min(float(d.max()), 12.0), float(np.sort(d)[-3:].mean()), float(d.mean()), float(np.log1p(len(d))),
        *(float(np.log1p((d >= k).sum())) for k in (2, 3, 4, 5)),
        *(float((d >= k).mean()) for k in (1, 2, 3, 5)),
    ]


def beginnings(text: str) -> set[bytes]:
    least, most = SEGMENT_BYTES
    words = [b" " + word + b" " for word in set(plain(text).split())]
    return {word[:n] for word in words for n in range(least, min(len(word), most) + 1)}


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that have a word or a word's beginning."""
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label].update(beginnings(text))
        every = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([
            pa.array(every, pa.binary()), pa.array([counts[0][s] for s in every], pa.int64()),
            pa.array([counts[1][s] for s in every], pa.int64())], ["segment", "n0", "n1"])


def contrast(n0, n1, size: dict[int, int], root=np.sqrt):
    """By how many standard errors the shares of two classes differ; for columns or numbers."""
    p0, p1 = n0 / max(1, size[0]), n1 / max(1, size[1])
    mean = (n0 + n1) / max(1, size[0] + size[1])
    return (p1 - p0) / root(mean * (1 - mean) * (1 / max(1, size[0]) + 1 / max(1, size[1])) + 1e-12)


def nested(segment: bytes, chosen: list[bytes]) -> bool:
    return any(segment.startswith(c) or c.startswith(segment) for c in chosen)


def choose(ranked: Iterable[bytes], most: int) -> list[bytes]:
    """The first segments of which none begins another."""
    chosen: list[bytes] = []
    for segment in ranked:
        if len(chosen) == most:
            break
        if not nested(segment, chosen):
            chosen.append(segment)
    return chosen


def choose_by_voices(
    ranked: list[tuple[bytes, int]], holders: dict[int, list], size: dict[int, int],
    chosen: list[bytes] | None = None, spoken: Counter | None = None,
) -> list[bytes]:
    """The first segments, each with contrast enough among documents that spoke for few so far.

    ``ranked`` has (segment, ordinary documents with it); ``holders`` the toxic ones by its place.
    ``chosen`` and ``spoken`` go on from segments that rank before.
    """
    spoken = Counter() if spoken is None else spoken
    chosen = [] if chosen is None else chosen
    for place, (segment, n0) in enumerate(ranked):
        if len(chosen) == CLASS_SEGMENTS:
            break
        voices = sum(spoken[doc] < VOICES for doc in holders.get(place, ()))
        if contrast(n0, voices, size) < LEAST_CONTRAST or nested(segment, chosen):
            continue
        chosen.append(segment)
        spoken.update(holders[place])
    return chosen


def _holders(toxic: DataFrame, segments: list[bytes]) -> dict[int, list]:
    """For each segment, by place, the ids of the toxic documents of the sample that have it."""
    places = {segment: i for i, segment in enumerate(segments)}
    schema = T.StructType([toxic.schema["doc_id"], T.StructField("places", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(places[s] for s in beginnings(t) & places.keys()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], schema.names)

    holders: dict[int, list] = {}
    # At most as many rows as the sample has toxic documents.
    for row in in_tasks(toxic.select("doc_id", "text"), run, schema).collect():
        for place in row["places"]:
            holders.setdefault(place, []).append(row["doc_id"])
    return holders


def _ranked(rows: DataFrame, by: Column, most: int, last: Row | None = None) -> list[Row]:
    """The first segments (``segment, n0, by``), or the first after ``last``."""
    size = F.length("segment")
    if last is not None:
        ties = (size < len(last["segment"])) | (
            (size == len(last["segment"])) & (F.col("segment") > F.lit(bytes(last["segment"]))))
        rows = rows.where((by < last["by"]) | ((by == last["by"]) & ties))
    # Of equal ones the longer: it leaves less to chance matches within words.
    return rows.orderBy(by.desc(), size.desc(), "segment").select("segment", "n0", by.alias("by")).limit(most).collect()


def _in_blocks(rows: DataFrame, by: Column) -> Iterator[bytes]:
    """All segments in order, ``CANDIDATES`` at a time."""
    block = _ranked(rows, by, CANDIDATES)
    while block:
        yield from (bytes(r["segment"]) for r in block)
        block = _ranked(rows, by, CANDIDATES, block[-1]) if len(block) == CANDIDATES else []


def _toxic_segments(counts: DataFrame, toxic: DataFrame, size: dict[int, int]) -> list[bytes]:
    """Segments of the toxic dictionary, chosen from all that have contrast enough.

    ``CANDIDATES`` are looked at at a time.  Before the next, those are left out that would be refused:
    without contrast among the documents that may still speak, or nested with one that is chosen.
    So each further block adds a segment, and many copies of a text fill one block at most.
    """
    differs = F.col("contrast")
    rows = counts.where(differs >= LEAST_CONTRAST)
    chosen: list[bytes] = []
    spoken: Counter = Counter()
    block = _ranked(rows, differs, CANDIDATES)
    while block:
        ranked = [(bytes(r["segment"]), r["n0"]) for r in block]
        choose_by_voices(ranked, _holders(toxic, [s for s, _ in ranked]), size, chosen, spoken)
        if len(block) < CANDIDATES or len(chosen) == CLASS_SEGMENTS:
            break
        silent = [doc for doc, n in spoken.items() if n >= VOICES]
        voices = (
            in_tasks(toxic.where(~F.col("doc_id").isin(silent)).select("label", "text"), _beginnings, SEGMENTS)
            .groupBy("segment").agg(F.sum("n1").alias("voices")))
        begun = reduce(or_, [
            F.startswith("segment", F.lit(c)) | F.startswith(F.lit(c), "segment") for c in chosen], F.lit(False))
        left = rows.join(voices, "segment").where(
            # What rounding leaves in doubt is settled when it is looked at.
            (contrast(F.col("n0"), F.col("voices"), size, F.sqrt) >= LEAST_CONTRAST - 1e-6) & ~begun)
        block = _ranked(left, differs, CANDIDATES, block[-1])
    return chosen


def _dictionaries(sample: DataFrame) -> tuple[bytes, bytes]:
    size = {y: sample.where(F.col("label") == y).count() for y in (0, 1)}
    counts = cut(
        in_tasks(sample.select("label", "text"), _beginnings, SEGMENTS)
        .groupBy("segment").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .withColumn("contrast", F.round(contrast(F.col("n0"), F.col("n1"), size, F.sqrt), 6))
    )
    differs = F.col("contrast")
    toxic = _toxic_segments(counts, sample.where(F.col("label") == 1), size)
    ordinary = choose(_in_blocks(counts.where(differs < 0), -differs), len(toxic))
    whole = F.substring("segment", -1, 1) == F.lit(b" ")
    words = [
        w for w in (bytes(r["segment"]) for r in _ranked(counts.where(whole), F.col("n0"), 2 * COMMON_WORDS))
        if not any(w.startswith(t) for t in toxic)][:COMMON_WORDS]
    # What stands last is nearest and cheapest to point at.
    shared = b"".join(w[:-1] for w in reversed(words)) + b" "
    return shared + b"".join(reversed(ordinary)), shared + b"".join(reversed(toxic))


def _featured(rows: DataFrame, ordinary: bytes, toxic: bytes) -> DataFrame:
    """``label, x`` for each row (``label, text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = compressor(ordinary), compressor(toxic)
        for batch in batches:
            x = [features(t or "", a, b) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    return in_tasks(rows.select("label", "text"), run, "label int, x array<double>")


def learn(docs: DataFrame, labels: DataFrame, held_out: int = 2, parts: int = 4) -> Model | float:
    """The model, or the share of toxic labels (0 without labels) if one of the classes is missing.

    Bounded: at most ``SAMPLE_DOCS`` labelled documents of each class from the other folds, those of the
    smallest id hashes; calibration weighs them by the size of their class.
    """
    labelled = label_of(labels, "toxic").where(fold(F.col("doc_id"), parts) != held_out)
    chosen, sizes = sample_by_class(labelled, SAMPLE_DOCS)
    sample = cut(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.coalesce(F.min("text"), F.lit("")).alias("text")))
    if sample.select("label").distinct().count() < 2:
        return sizes[1] / max(1, sum(sizes.values()))
    ordinary, toxic = _dictionaries(sample)
    rows = _featured(sample, ordinary, toxic).collect()
    y = np.array([r["label"] for r in rows], float)
    x = np.array([r["x"] for r in rows])
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    return Model(ordinary, toxic, calibrate(x, y, sizes))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, held_out: int = 2, parts: int = 4, carry: bool = False
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (``doc_id, text``), and with
    ``carry`` the whole input row as ``row``.

    ``labels`` has ``doc_id, toxic``; learning uses labels of 0 or 1 whose fold (crc32 of the id modulo
    ``parts``) is not ``held_out``, the larger one where they differ.  Every window of the whole text
    counts.  Null text is scored like empty text; rows with a null id are not held out; repeated rows
    stay; without labels of both classes every score is the share of toxic ones; other columns are
    ignored; an empty table gives no row.
    """
    model = learn(docs, labels, held_out, parts)
    out = F.coalesce(fold(F.col("doc_id"), parts) == held_out, F.lit(False))
    rows = text_rows(docs, out, carry)
    source = rows.schema
    flagged = (F.col("score") >= THRESHOLD).cast("int")
    if not isinstance(model, Model):
        return rows.drop("text").withColumn("score", F.lit(float(model))).withColumn("predicted", flagged)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()),
        *(rows.schema.fields[2:] if carry else ())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        a, b = compressor(model.ordinary), compressor(model.toxic)
        for batch in batches:
            scores = model.probability(np.array([features(t.as_py() or "", a, b) for t in texts_of(batch, source)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), *(batch.columns[2:] if carry else ())], schema.names)

    return in_tasks(rows, run, schema).withColumn("predicted", flagged)
