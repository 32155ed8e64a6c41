"""What the operators share: tables, checkpoints, and text as bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.shipping import ship
from careflow.sources.scratch import checkpointed

#: A table that is broadcast is shown to be at most so large.
BROADCAST_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to the checkpoint folder that all machines share."""
    return checkpointed(df)


def in_tasks(
    rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """``mapInArrow``, with the library sent to the workers first."""
    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Marked for broadcast if a sum over its rows (text bytes and 64 a row) shows that it is small."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    size = F.lit(64).cast("long")
    for text in texts:
        size = size + text
    measured = df.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if measured <= limit else df


def text_rows(docs: DataFrame, held_out: Column, carry: bool) -> DataFrame:
    """``doc_id, held_out, text`` for a task, or ``row`` (all columns of the input row) for the text."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select("doc_id", held_out.alias("held_out"), whole if carry else "text")


def texts_of(batch: pa.RecordBatch, rows: T.StructType) -> pa.Array:
    """The texts of a batch of ``text_rows``; those of whole rows are read where they are."""
    last, kind = batch.column(2), rows.fields[2].dataType
    return last.field(kind.names.index("text")) if isinstance(kind, T.StructType) else last


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: the fold a labelled row belongs to."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def label_of(labels: DataFrame, name: str) -> DataFrame:
    """One row per labelled document; of differing labels the largest counts."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1))
        .groupBy("doc_id").agg(F.max(F.col(name).cast("int")).alias("label"))
    )


def sample_by_class(labelled: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` rows of each label, those of the smallest id hashes, and each label's size."""
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    taken = [labelled.where(F.col("label") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    return taken[0].unionByName(taken[1]), {y: sizes.get(y, 0) for y in (0, 1)}


class Calibration(NamedTuple):
    """Logistic regression on features that are kept within the range it was fitted on."""

    beta: np.ndarray
    low: np.ndarray
    high: np.ndarray
    center: np.ndarray
    spread: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = (np.clip(x.reshape(-1, len(self.low)), self.low, self.high) - self.center) / self.spread
        return 1 / (1 + np.exp(-np.clip(self.beta[0] + x @ self.beta[1:], -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, sizes: dict[int, int]) -> Calibration:
    """Fitted to rows sampled by class, weighed by the classes' sizes."""
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    weight = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (1 - y).sum())
    weight *= len(y) / weight.sum()
    beta = fit_logistic((x - center) / spread, y, weight)
    return Calibration(beta, x.min(axis=0), x.max(axis=0), center, spread)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients of a weighted logistic regression, intercept first, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta
