"""Several writers of one store, and tables that are published together."""

import threading

import pytest
from pyspark.sql import functions as F

from careflow.plans import merge
from careflow.schemas import LIS04, LIS06
from careflow.sources import commits, generations, sinks


def stored(spark, path):
    return sorted((r["_source_file"], r["x"]) for r in sinks.read_store(spark, path).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "_source_file string, x int")


def test_four_writers_at_once(spark, tmp_path):
    path, problems = str(tmp_path / "t"), []

    def write(i):
        try:
            for k in range(3):
                df = frame(spark, [(f"own{i}", 10 * i + k), ("shared", 10 * i + k)])
                positions.append(sinks.upsert_files(df, df, path, f"{i}-{k}"))
        except Exception as problem:
            problems.append(problem)

    positions = []
    writers = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert not problems and sorted(positions) == list(range(1, 13))
    rows = stored(spark, path)
    last = commits.last_entry(spark, f"{path}/{sinks.COMMITS}").removeprefix(sinks.MARK)
    i, k = map(int, last.split("-"))
    assert rows == [(f"own{n}", 10 * n + 2) for n in range(4)] + [("shared", 10 * i + k)]


def test_a_place_is_given_once(spark, tmp_path):
    folder = str(tmp_path / "log")
    assert commits.last_entry(spark, folder) is None and commits.entries(spark, folder).isEmpty()
    assert commits.append(spark, folder, "一") == 1
    assert commits.append(spark, folder, "b", after=0) is None
    assert commits.append(spark, folder, "b", after=1) == 2
    assert [tuple(r) for r in commits.entries(spark, folder).orderBy("position").collect()] == [(1, "一"), (2, "b")]
    assert commits.last_entry(spark, folder) == "b"
    for wrong in ("", "two\nlines"):
        with pytest.raises(ValueError):
            commits.append(spark, folder, wrong)
    # Nothing but the entries is left.
    assert sorted(p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")) == ["000000000001", "000000000002"]


def test_a_run_that_does_not_end_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = frame(spark, [("a", 1), ("b", 2)])
    sinks.upsert_files(first, first, path, "1")

    def fail(*_):
        raise OSError("the machine is gone")

    second = frame(spark, [("a", 9)])
    with monkeypatch.context() as m:
        m.setattr(commits, "append", fail)
        with pytest.raises(OSError):
            sinks.upsert_files(second, second, path, "2")
    assert stored(spark, path) == [("a", 1), ("b", 2)]
    assert sinks.upsert_files(second, second, path, "2") == 2
    assert stored(spark, path) == [("a", 9), ("b", 2)]


def test_compaction_yields_to_a_run_that_ends_meanwhile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first, newer = frame(spark, [("a", 1), ("b", 2)]), frame(spark, [("a", 7)])
    sinks.upsert_files(first, first, path, "1")
    whole = sinks.read_store

    def read_and_then_another_writes(*args, **kwargs):
        found = whole(*args, **kwargs)
        if not commits.entries(spark, f"{path}/{sinks.COMMITS}").where("entry = 'run-2'").count():
            sinks.upsert_files(newer, newer, path, "2")
        return found

    with monkeypatch.context() as m:
        m.setattr(sinks, "read_store", read_and_then_another_writes)
        assert not sinks.compact_store(spark, path, "c1")
    assert stored(spark, path) == [("a", 7), ("b", 2)]
    assert sinks.compact_store(spark, path, "c2")
    assert stored(spark, path) == [("a", 7), ("b", 2)]


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") % 97).alias("k")).groupBy("k").count()
    assert sinks.write_table(rows, str(tmp_path / "w")) == 97
    assert sinks.write_table(rows.limit(0), str(tmp_path / "w")) == 0
    assert spark.read.parquet(str(tmp_path / "w")).count() == 0


PATIENTS = "_source_file string, _row_idx bigint, `患者ID` string"


def test_a_merge_that_fails_leaves_the_last_whole_one(spark, tmp_path):
    out = str(tmp_path / "m")
    good = spark.createDataFrame([("f", 0, "1"), ("f", 1, "2")], PATIENTS)
    broken = good.withColumn("x", F.raise_error(F.lit("broken")))
    files = spark.createDataFrame([("f",)], "path string")

    def run(ts, keep_last=True, **tables):
        return merge.merge_results(spark, tables, files, out, ts, keep_last=keep_last)

    def now():
        return {t: merge.read_merged(spark, out, t).count() for t in (LIS06, LIS04)}

    drugs = good.withColumns({"药物名称": F.lit("x"), "用药日期": F.lit("2023-01-01")})
    run("t1", **{LIS06: good, LIS04: drugs})
    old = merge.read_merged(spark, out, LIS06)
    assert now() == {LIS06: 2, LIS04: 2}
    attempt = run("t2", **{LIS06: good.limit(1), LIS04: broken})
    assert {r["sheet名称"]: r["状态"] for r in attempt["详细结果"].collect()}[LIS04] == "error"
    assert now() == {LIS06: 2, LIS04: 2}
    report = {r["sheet名称"]: (r["状态"], r["行数"]) for r in merge.read_report(spark, out, "详细结果").collect()}
    assert report[LIS04] == ("success", 2) and report[LIS06] == ("success", 2)
    assert spark.read.parquet(f"{out}/{merge.ATTEMPT}/详细结果").where("`状态` = 'error'").count() == 1
    run("t3", **{LIS06: good.limit(1), LIS04: drugs})
    assert now() == {LIS06: 1, LIS04: 2}
    # Whoever still reads the set before is not disturbed.
    assert old.count() == 2
    run("t4", keep_last=False, **{LIS06: good, LIS04: broken})
    assert merge.read_merged(spark, out, LIS06).count() == 2
    assert len([p for p in (tmp_path / "m").iterdir() if p.name.startswith(generations.PREFIX)]) == generations.KEPT
    with pytest.raises(ValueError):
        merge.read_merged(spark, str(tmp_path / "none"), LIS06)
