"""Quality by a convolutional network over bytes, in numpy.

Filters look at runs of bytes; a chunk is two neighbouring blocks, so chunks overlap by half and
cover the whole text.  A chunk's features are the filters' maxima over its places; they give the
chunk a logit, and the logits of all chunks give the text one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.llm.common import Calibration, calibrate, cut, fold, in_tasks, label_of, sample_by_class

#: Bounds of the labelled sample: documents of each label, and chunks of each that train filters.
SAMPLE_DOCS = 1500
SAMPLE_CHUNKS = 4
#: Bytes of a block, blocks computed at a time, bytes a filter sees, filters.
BLOCK = 256
STRIP = 64
WIDTH = 6
FILTERS = 16
EPOCHS, BATCH, RATE = 4, 64, 0.01
THRESHOLD = 0.3


class Network(NamedTuple):
    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    offset: float


class Model(NamedTuple):
    network: Network
    probability: Calibration


def padded(text: bytes) -> bytes:
    """Whole blocks; zeros follow, enough that no filter sees past the last block."""
    size = -(-(len(text) + WIDTH - 1) // BLOCK) * BLOCK
    return text.ljust(size, b"\0")


def _tables(filters: np.ndarray) -> list[np.ndarray]:
    """Filter sums for each pair of neighbouring bytes: half the look-ups."""
    return [
        (filters[k][:, None, :] + filters[k + 1][None, :, :]).reshape(1 << 16, -1).astype(np.float32)
        for k in range(0, WIDTH, 2)]


def block_maxima(data: bytes, tables: list[np.ndarray]) -> np.ndarray:
    """The filters' maxima over the places of each block of ``data`` (whole blocks)."""
    raw = np.frombuffer(data + b"\0" * WIDTH, np.uint8).astype(np.int32)
    pairs = raw[:-1] * 256 + raw[1:]
    places = len(data)
    out = np.empty((places // BLOCK, tables[0].shape[1]), np.float32)
    step = STRIP * BLOCK
    for at in range(0, places, step):
        n = min(step, places - at)
        total = tables[0].take(pairs[at:at + n], axis=0)
        for k, sums in enumerate(tables[1:], 1):
            total += sums.take(pairs[at + 2 * k:at + 2 * k + n], axis=0)
        out[at // BLOCK:(at + n) // BLOCK] = total.reshape(-1, BLOCK, total.shape[1]).max(axis=1)
    return out


def chunk_logits(maxima: np.ndarray, network: Network) -> np.ndarray:
    pooled = np.maximum(maxima[:-1], maxima[1:]) if len(maxima) > 1 else maxima
    return np.maximum(pooled + network.bias, 0) @ network.dense + network.offset


def features(text: str | None, network: Network, tables: list[np.ndarray]) -> list[float]:
    logits = chunk_logits(block_maxima(padded((text or "").encode("utf-8", "replace")), tables), network)
    return [float(logits.mean()), float(logits.min()), float(logits.max()), float(np.log(len(logits)))]


def train(chunks: np.ndarray, labels: np.ndarray, seed: int = 7) -> Network:
    """Filters and dense layer by Adam on the classes in equal shares.

    ``chunks`` are rows of two blocks and ``WIDTH`` bytes after them.  A maximum passes its gradient on to
    the place it came from only.
    """
    rng = np.random.default_rng(seed)
    parameters = [
        rng.normal(0, 0.1, (WIDTH, 256, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.1, FILTERS), np.zeros(1)]
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    by_class = [np.flatnonzero(labels == y) for y in (0, 1)]
    steps = EPOCHS * max(1, len(labels) // BATCH)
    places = chunks.shape[1] - WIDTH
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(c, BATCH // 2) for c in by_class])
        x, y = chunks[rows], labels[rows]
        filters, bias, dense, offset = parameters
        total = filters[0].take(x[:, :places], axis=0)
        for k in range(1, WIDTH):
            total += filters[k].take(x[:, k:places + k], axis=0)
        place = total.argmax(axis=1)
        top = np.take_along_axis(total, place[:, None, :], axis=1)[:, 0, :] + bias
        active = np.maximum(top, 0)
        logit = active @ dense + offset[0]
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        back = error[:, None] * dense * (top > 0)
        of_filters = np.zeros_like(filters)
        which = np.broadcast_to(np.arange(FILTERS), back.shape)
        for k in range(WIDTH):
            seen = np.take_along_axis(x, place + k, axis=1)
            np.add.at(of_filters[k], (seen, which), back)
        gradients = [of_filters + 1e-5 * filters, back.sum(axis=0), active.T @ error, np.array([error.sum()])]
        for p, g, m, v in zip(parameters, gradients, first, second, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    filters, bias, dense, offset = parameters
    return Network(filters.astype(np.float32), bias.astype(np.float32), dense.astype(np.float32), float(offset[0]))


def _some_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to ``SAMPLE_CHUNKS`` chunks of each text, evenly spread from its first to its last."""
    for batch in batches:
        ids, labels, chunks = [], [], []
        for doc_id, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = padded((text or "").encode("utf-8", "replace"))
            last = max(0, len(data) // BLOCK - 2)
            for k in sorted(set(np.linspace(0, last, SAMPLE_CHUNKS).astype(int).tolist())):
                ids.append(doc_id)
                labels.append(label)
                chunks.append(data[k * BLOCK:(k + 2) * BLOCK + WIDTH].ljust(2 * BLOCK + WIDTH, b"\0"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.column(0).type), pa.array(labels, pa.int32()), pa.array(chunks, pa.binary())],
            ["doc_id", "label", "chunk"])


def _featured(rows: DataFrame, network: Network) -> DataFrame:
    """``doc_id, label, x`` for each row (``doc_id, label, text``)."""
    schema = T.StructType([
        rows.schema["doc_id"], rows.schema["label"], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(network.filters)
        for batch in batches:
            x = [features(t.as_py(), network, tables) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], schema.names)

    return in_tasks(rows.select("doc_id", "label", "text"), run, schema)


def learn(docs: DataFrame, labels: DataFrame, held_out: int = 0, parts: int = 5) -> Model | float:
    """The model, or the share of good labels (0 without labels) if one of the classes is missing.

    Bounded: at most ``SAMPLE_DOCS`` labelled documents of each class from the other folds, those of the
    smallest id hashes, and of each ``SAMPLE_CHUNKS`` chunks for the filters; the probability is
    calibrated on their whole texts, classes weighed by size.
    """
    labelled = label_of(labels, "quality").where(fold(F.col("doc_id"), parts) != held_out)
    chosen, sizes = sample_by_class(labelled, SAMPLE_DOCS)
    sample = cut(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.coalesce(F.min("text"), F.lit("")).alias("text")))
    if sample.select("label").distinct().count() < 2:
        return sizes[1] / max(1, sum(sizes.values()))
    schema = T.StructType([
        sample.schema["doc_id"], sample.schema["label"], T.StructField("chunk", T.BinaryType())])
    parts_of = sorted(
        in_tasks(sample.select("doc_id", "label", "text"), _some_chunks, schema).collect(),
        key=lambda r: (r["doc_id"], bytes(r["chunk"])))
    chunks = np.frombuffer(b"".join(bytes(r["chunk"]) for r in parts_of), np.uint8).reshape(len(parts_of), -1)
    network = train(chunks, np.array([r["label"] for r in parts_of]))
    rows = sorted(_featured(sample, network).collect(), key=lambda r: r["doc_id"])
    y, x = np.array([r["label"] for r in rows], float), np.array([r["x"] for r in rows])
    return Model(network, calibrate(x, y, sizes))


def score_quality(docs: DataFrame, labels: DataFrame, held_out: int = 0, parts: int = 5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (``doc_id, text``).

    ``labels`` has ``doc_id, quality``; learning uses labels of 0 or 1 whose fold (crc32 of the id modulo
    ``parts``) is not ``held_out``, the larger one where they differ.  All chunks of the whole text
    count.  Null text is scored like empty text; rows with a null id are not held out; repeated rows
    stay; without labels of both classes every score is the share of good ones; other columns are
    ignored; an empty table gives no row.
    """
    model = learn(docs, labels, held_out, parts)
    out = F.coalesce(fold(F.col("doc_id"), parts) == held_out, F.lit(False)).alias("held_out")
    if not isinstance(model, Model):
        constant = F.lit(float(model))
        return docs.select("doc_id", out, constant.alias("score"), (constant >= THRESHOLD).cast("int").alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables = _tables(model.network.filters)
        for batch in batches:
            scores = model.probability(np.array([features(t.as_py(), model.network, tables) for t in batch.column(2)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], schema.names)

    scored = in_tasks(docs.select("doc_id", out, "text"), run, schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
