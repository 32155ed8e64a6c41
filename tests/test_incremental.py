"""Merging only what changed gives what merging everything gives."""

import random

import pytest
from pyspark.sql import functions as F

from careflow.plans import incremental, merge
from careflow.schemas import LIS01, LIS04, LISA1
from careflow.sources import commits, sinks

ROWS = {
    LIS04: "_source_file string, _row_idx bigint, `患者ID` string, `药物名称` string, `用药日期` string",
    LIS01: "_source_file string, _row_idx bigint, `患者唯一编码` string, `就诊日期` string, v string",
    LISA1: "_source_file string, _row_idx bigint, `患者ID` string, `首次就诊日期` string, `最近就诊日期` string, `就诊次数` bigint",
}


def some_rows(draw, table, file, n):
    day = lambda: draw.choice(["2023-01-01", "2023/1/2", "20230103", "1月4日", None, ""])
    who = lambda: draw.choice([f"P{draw.randrange(12)}", None, " "])
    last = {LIS04: lambda: draw.choice("ab"), LIS01: lambda: draw.choice("xyz"), LISA1: lambda: draw.randrange(5)}[table]
    make = {
        LIS04: lambda i: (file, i, who(), last(), day()), LIS01: lambda i: (file, i, who(), day(), last()),
        LISA1: lambda i: (file, i, who(), day(), day(), last())}[table]
    return [make(i) for i in range(n)]


def test_rounds_of_changes_equal_a_full_merge(spark, tmp_path):
    draw = random.Random(4)
    processed, out = str(tmp_path / "processed"), str(tmp_path / "out")
    schemas = {t: spark.createDataFrame([], s).schema for t, s in ROWS.items()}
    for turn, files in enumerate((["a", "b", "c"], ["b"], [], ["d", "a"], ["c"])):
        if files:
            for table, schema in schemas.items():
                rows = [r for f in files for r in some_rows(draw, table, f, 0 if (turn, f) == (4, "c") else 25)]
                listed = spark.createDataFrame([(f,) for f in files], "_source_file string")
                sinks.upsert_files(spark.createDataFrame(rows, schema), listed, f"{processed}/{table}", f"r{turn}")
        changes = incremental.merge_incremental(spark, processed, schemas, out, "t", buckets=8)
        for table, schema in schemas.items():
            whole = merge.merged_rows(table, sinks.read_store(spark, f"{processed}/{table}", schema), "t")
            found = incremental.read_incremental(spark, out, table)
            assert sorted(found.columns) == sorted(whole.columns)
            order = sorted(whole.columns)
            assert sorted(map(repr, found.select(*map(lambda c: f"`{c}`", order)).collect())) == sorted(
                map(repr, whole.select(*map(lambda c: f"`{c}`", order)).collect()))
            assert (changes[table].files, changes[table].rows) == (len(files), whole.count())
    assert commits.last_position(spark, f"{out}/{incremental.VERSIONS}") == 5


def test_only_changed_files_and_their_buckets_are_read(spark, tmp_path, monkeypatch):
    processed, out = str(tmp_path / "processed"), str(tmp_path / "out")
    schema = spark.createDataFrame([], ROWS[LIS04]).schema
    store, read = f"{processed}/{LIS04}", []
    rows = [("big", i, f"P{i}", "a", "2023-01-01") for i in range(3000)]
    df = spark.createDataFrame(rows, schema)
    sinks.upsert_files(df, df, store, "1")
    whole = incremental.merge_incremental(spark, processed, {LIS04: schema}, out, "t", buckets=64)[LIS04]
    assert len(whole.buckets) == 64 and whole.rows == 3000
    one = spark.createDataFrame([("small", 0, "P7", "a", "2023-01-01"), ("small", 1, "new", "a", "2023-01-01")], schema)
    sinks.upsert_files(one, one, store, "2")
    changed, buckets = incremental._changed_rows, incremental._read_buckets

    def noted(which, call):
        def run(*args):
            found = call(*args)
            read.append((which, found.inputFiles()))
            return found
        return run

    monkeypatch.setattr(incremental, "_changed_rows", noted("changed", changed))
    monkeypatch.setattr(incremental, "_read_buckets", noted("old", buckets))
    change = incremental.merge_incremental(spark, processed, {LIS04: schema}, out, "t")[LIS04]
    assert change.files == 1 and 1 <= len(change.buckets) <= 2 and change.rows == 3001
    files = dict(read)
    assert files["changed"] and all("run-2" in f for f in files["changed"])
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in files["old"]} <= set(change.buckets)
    # Nothing new: nothing is read at all.
    read.clear()
    assert incremental.merge_incremental(spark, processed, {LIS04: schema}, out, "t")[LIS04] == incremental.Change(0, (), 3001)
    assert read == []


def test_a_merge_that_is_overtaken_changes_nothing(spark, tmp_path, monkeypatch):
    processed, out = str(tmp_path / "processed"), str(tmp_path / "out")
    df = spark.createDataFrame([("a", 0, "P1", "x", "2023-01-01")], ROWS[LIS04])
    sinks.upsert_files(df, df, f"{processed}/{LIS04}", "1")
    incremental.merge_incremental(spark, processed, {LIS04: df.schema}, out, "t", 4)
    more = spark.createDataFrame([("b", 0, "P2", "x", "2023-01-01")], ROWS[LIS04])
    sinks.upsert_files(more, more, f"{processed}/{LIS04}", "2")
    work = incremental.merge_changes

    def late(*args):
        done = work(*args)
        commits.append(spark, f"{out}/{incremental.VERSIONS}", commits.last_entry(spark, f"{out}/{incremental.VERSIONS}"))
        return done

    with monkeypatch.context() as m:
        m.setattr(incremental, "merge_changes", late)
        with pytest.raises(RuntimeError):
            incremental.merge_incremental(spark, processed, {LIS04: df.schema}, out, "t")
    assert incremental.read_incremental(spark, out, LIS04).count() == 1
    incremental.merge_incremental(spark, processed, {LIS04: df.schema}, out, "t")
    assert incremental.read_incremental(spark, out, LIS04).where(F.col("患者ID") == "P2").count() == 1
    with pytest.raises(ValueError):
        incremental.read_incremental(spark, str(tmp_path / "none"), LIS04)
