"""Shards: the permutation, its inverse, numbering, laws and files."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from careflow.llm import sharding

COLUMNS = "doc_id long, text string, lang string, slot string, shard string, number string, _range string, row_hash string"


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "a", "b", "c", "d", "e") for i, t in pairs], COLUMNS)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5000), st.integers(0, 1 << 40))
def test_permutation_and_its_inverse(n, seed):
    numbers = np.arange(n)
    placed = sharding.permute(numbers, n, seed)
    assert sorted(placed.tolist()) == numbers.tolist()
    assert (sharding.permute(placed, n, seed, inverse=True) == numbers).all()


def test_large_numbers_stay_inside():
    n = (1 << 60) + 12_345
    numbers = np.array([0, 1, n // 2, n - 2, n - 1])
    placed = sharding.permute(numbers, n, 3)
    assert ((placed >= 0) & (placed < n)).all()
    assert (sharding.permute(placed, n, 3, inverse=True) == numbers).all()


def test_shuffle_mixes():
    """Neighbours part, and another seed gives another order."""
    n = 10_000
    one, other = (sharding.permute(np.arange(n), n, seed) for seed in (1, 2))
    assert (one == other).mean() < 0.01
    assert abs(np.corrcoef(np.arange(n), one)[0, 1]) < 0.05
    assert np.abs(np.diff(one)).mean() > n / 4
    first = Counter((one[:1000] % 8).tolist())
    assert all(90 <= first[s] <= 160 for s in range(8))


PAIRS = [
    (1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, None), (None, None), (2, None), (3, ""), (4, "é" * 300_000),
    *[(7, "copy")] * 9000, *[(100 + i, "same") for i in range(50)]]


def test_shards_of_odd_rows(spark):
    docs = docs_of(spark, PAIRS)
    rows = sharding.shard_documents(docs, 8).collect()
    n = len(PAIRS)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in PAIRS)
    assert sorted(r.number for r in rows) == list(range(n))
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert all(found == list(range(len(found))) for found in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for r in rows[::500]:
        assert sharding.row_number_at(r.shard, r.slot, n, 8) == r.number


def test_files_and_partitions_change_nothing(spark):
    def placed(df):
        return Counter(tuple(r) for r in sharding.shard_documents(df, 5).select("doc_id", "text_crc32", "shard", "slot").collect())

    docs = docs_of(spark, PAIRS)
    assert placed(docs.repartition(7)) == placed(docs.orderBy(F.rand(5)).coalesce(1))


def test_empty_table_and_more_shards_than_rows(spark):
    empty = docs_of(spark, PAIRS).limit(0)
    assert sharding.shard_documents(empty, 8).collect() == []
    rows = sharding.shard_documents(docs_of(spark, PAIRS[:3]), 8).collect()
    assert sorted(r.slot for r in rows) == [0, 0, 0] and len({r.shard for r in rows}) == 3
    with pytest.raises(ValueError):
        sharding.shard_documents(empty, 0)
    with pytest.raises(IndexError):
        sharding.row_number_at(0, 3, 8, 8)


def test_written_shards_hold_every_row_in_order(spark, tmp_path):
    docs = docs_of(spark, PAIRS).withColumn("more", F.create_map(F.lit("k"), F.col("text")))
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text, r.lang, r.slot, r.more["k"]) for r in back.collect()) == Counter(
        (i, t, "en", "a", t) for i, t in PAIRS)
    for shard in range(3):
        slots = [r._slot for r in back.where(F.col("_shard") == shard).orderBy("_slot").collect()]
        assert slots == list(range(len(slots)))


def test_equal_rows_are_spread(spark):
    """Copies of one row are not left in one task."""
    copies = spark.range(200_000).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    rows, n = sharding.number_rows(copies)
    assert n == 200_000
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < n * 0.6
