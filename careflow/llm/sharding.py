"""Sharding: a Feistel permutation of global row numbers gives every row its shard and its slot."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.llm.common import cut, in_tasks
from careflow.operators.running import with_total_before

SEED = 20_240_201
ROUNDS = 6
#: Prime modulus of the round function: products of two residues fit 64 bits.
PRIME = (1 << 31) - 1
#: Repeated rows are dealt out in chunks of so many, over at most so many partitions.
CHUNK, SPREAD = 4096, 10_000


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """For each round a factor, an addend and a second factor, all residues of ``PRIME``."""
    def residue(r: int, part: str) -> int:
        return int.from_bytes(hashlib.sha256(f"{seed}:{r}:{part}".encode()).digest()[:8], "big") % (PRIME - 1) + 1

    return [(residue(r, "a"), residue(r, "b"), residue(r, "c")) for r in range(rounds)]


def sides(n: int) -> tuple[int, int]:
    """The two halves' moduli: the smallest near-square rectangle that has ``n`` cells."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _mixed(x: np.ndarray, key: tuple[int, int, int]) -> np.ndarray:
    factor, addend, second = key
    t = (x * factor + addend) % PRIME
    t = (t * t + addend) % PRIME
    return (t * second + x) % PRIME


def _once(x: np.ndarray, a: int, b: int, keys: list[tuple[int, int, int]], inverse: bool) -> np.ndarray:
    left, right = x // b, x % b
    turns = list(enumerate(keys))
    for i, key in reversed(turns) if inverse else turns:
        sign = -1 if inverse else 1
        if i % 2 == 0:
            left = (left + sign * _mixed(right, key)) % a
        else:
            right = (right + sign * _mixed(left, key)) % b
    return left * b + right


def permute(numbers: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 at ``numbers``, or its inverse.

    A Feistel network with modular halves permutes a rectangle of fewer than ``n + sqrt(n)`` cells; what
    lands outside 0..n-1 walks on along its cycle until it is inside.  ``n`` is below 2^61.
    """
    a, b = sides(n)
    keys = round_keys(seed)
    x = _once(np.asarray(numbers, np.int64), a, b, keys, inverse)
    while (outside := np.flatnonzero(x >= n)).size:
        x[outside] = _once(x[outside], a, b, keys, inverse)
    return x


def row_number_at(shard: int, slot: int, n: int, shards: int, seed: int = SEED) -> int:
    """The global row number that lies in ``slot`` of ``shard``: what a reader needs to resume anywhere."""
    place = slot * shards + shard
    if not (0 <= shard < shards and 0 <= place < n):
        raise IndexError(f"no slot {slot} in shard {shard}")
    return int(permute(np.array([place]), n, seed, inverse=True)[0])


def _row_hash(docs: DataFrame):
    """Hash of all columns; maps, which Spark does not hash, by their text."""
    plain = [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()
        else F.col(f"`{f.name}`") for f in docs.schema]
    return F.xxhash64(*plain)


def number_rows(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, size, text_crc32, row_hash, number`` for every row, and the number of rows.

    Numbers go by content (id, null first, then size, checksum and hash of the whole row), so that files,
    partitions and lost executors change nothing.  Only these narrow columns are sorted, by ranges.  Fully
    equal rows are one row with a count until each gets its number, in chunks that are spread out.
    """
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    narrow = docs.select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), _row_hash(docs).alias("row_hash"))
    order = ["doc_id", "size", "text_crc32", "row_hash"]
    counted = narrow.groupBy(*order).agg(F.count(F.lit(1)).alias("copies"))
    placed = cut(with_total_before(counted, order, F.col("copies")))
    shape = placed.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.max("copies").alias("most"), F.count(F.lit(1)).alias("distinct")).first()
    if (shape["most"] or 1) == 1:
        return placed.select(*order, F.col("_before").cast("long").alias("number")), shape["n"]
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK).cast("long"))
    many = placed.where(F.col("copies") > 1).withColumn("chunk", F.explode(chunks))
    # A number of its own, as Spark would merge such small partitions again.
    many = many.repartition(min(SPREAD, (shape["n"] - shape["distinct"]) // (16 * CHUNK) + 1), "row_hash", "chunk")
    within = F.sequence(
        F.col("chunk") * CHUNK, F.least(F.col("copies"), (F.col("chunk") + 1) * CHUNK) - F.lit(1).cast("long"))
    many = many.withColumn("copy", F.explode(within))
    numbered = placed.where(F.col("copies") == 1).select(*order, F.col("_before").cast("long").alias("number"))
    return numbered.unionByName(many.select(*order, (F.col("_before") + F.col("copy")).cast("long").alias("number"))), shape["n"]


def shard_documents(docs: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, size, text_crc32, row_hash, number, shard, slot``.

    The permuted row number modulo ``shards`` is the shard, divided by ``shards`` the slot: shards differ by
    one row at most, slots have no gap, and both follow from number, count and seed alone.  ``size`` is
    the UTF-8 bytes of the text plus 1.  Null text counts as no bytes (checksum 0); null ids come first in
    the numbering; repeated rows get numbers of their own, any way round; texts of any length are only
    hashed; other columns, whatever their names, only take part in the hash of the row; an empty table
    gives no row.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows, n = number_rows(docs)
    schema = T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = permute(batch.column(4).to_numpy(zero_copy_only=False), n, seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array((place % shards).astype(np.int32)), pa.array(place // shards)], schema.names)

    return in_tasks(rows, run, schema)


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = SEED) -> None:
    """All rows of ``docs`` with all their columns as Parquet, one folder per shard, in slot order.

    Column ``_slot`` has the slot.  Equal rows move once and meet their places, so no pairs are made of them;
    a shard is as many files as its size asks for.
    """
    places = shard_documents(docs, shards, seed).select(
        F.col("doc_id").alias("_doc"), F.col("row_hash").alias("_hash"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    once = docs.withColumns({"_row_hash": _row_hash(docs), "_own": F.col("doc_id")}).dropDuplicates(["_own", "_row_hash"])
    met = once.join(places, F.col("_own").eqNullSafe(F.col("_doc")) & (F.col("_row_hash") == F.col("_hash")))
    (
        met.select(*[f"`{c}`" for c in docs.columns], "_shard", "_slot")
        .repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
        .write.mode("overwrite").partitionBy("_shard").parquet(path)
    )
