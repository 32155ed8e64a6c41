"""Only files that changed are opened; dates that cannot be read are kept with their reason."""

import os

import pytest
from pyspark.sql import functions as F
from workbooks import write_workbook

from careflow.functions import temporal
from careflow.plans import batch, incremental, merge
from careflow.schemas import LIS05
from careflow.sources import ledger

HEAD = ["患者ID", "检查名称", "检查结果", "检查日期"]


def book(folder, name, *tests, visit="2023-01-01", **options):
    write_workbook(folder / name, {
        "门急诊信息": [["患者ID", "姓名", "年龄", "性别", "就诊日期", "诊断"], ["P1", "x", 30, "男", visit, "新冠肺炎"]],
        "住院信息": [["患者ID", "姓名", "年龄", "性别", "入院日期", "诊断"], ["P2", "y", 60, "女", "2023-02-30", "肺炎"]],
        "药物医嘱信息": [["患者ID", "药物名称", "开始日期"], ["P1", "奥司他韦", "2023-01-01"]],
        "检查信息": [HEAD, *[[p, "新冠核酸", r, "2023-01-01"] for p, r in tests]],
        "统计数据": [["统计项目", "统计值"], ["总患者数", 6]]}, **options)


def test_a_second_run_opens_no_file(spark, tmp_path, monkeypatch):
    folder, out, merged = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "merged")
    folder.mkdir()
    book(folder, "a [1].xlsx", ("P1", "阳性"), visit="1月4日")
    book(folder, "b.xlsx", ("P1", "阳性"), ("P2", "阴性"))
    (folder / "bad.xlsx").write_bytes(b"not a workbook")
    opened, scan = [], batch.scan_workbooks

    def noted(spark, places, *args):
        opened.append(sorted(p.rsplit("/", 1)[-1] for p in places))
        return scan(spark, places, *args)

    monkeypatch.setattr(batch, "scan_workbooks", noted)

    def run():
        found = batch.process_workbooks(spark, str(folder), out, changed_only=True)
        return found, sorted((r.path.rsplit("/", 1)[-1], r.change) for r in found["文件变化"].collect())

    first, changes = run()
    assert changes == [("a [1].xlsx", "new"), ("b.xlsx", "new"), ("bad.xlsx", "new")]
    assert {r["文件名"]: r["状态"] for r in first["详细结果"].collect()} == {"a [1]": "success", "b": "success", "bad": "error"}
    quarantine = sorted((r["sheet名称"], r["行号"], r["列名"], r["原文"], r["原因"]) for r in first["日期隔离"].collect())
    assert quarantine == [
        ("住院信息", 0, "入院日期", "2023-02-30", temporal.NO_DAY), ("住院信息", 0, "入院日期", "2023-02-30", temporal.NO_DAY),
        ("门急诊信息", 0, "就诊日期", "1月4日", temporal.NO_LAYOUT)]
    assert batch.merge_changed(spark, out, merged, "t")[LIS05].files == 3

    second, changes = run()
    assert {c for _, c in changes} == {"same"} and set(second) == {"文件变化"} and len(opened) == 1

    book(folder, "b.xlsx", ("P2", "阳性"), ("P9", "阴性"), ("P8", "阴性"))
    book(folder, "c.xlsx", ("P7", "阴性"))
    os.remove(folder / "a [1].xlsx")
    third, changes = run()
    assert changes == [("a [1].xlsx", "gone"), ("b.xlsx", "changed"), ("bad.xlsx", "same"), ("c.xlsx", "new")]
    assert opened == [["a [1].xlsx", "b.xlsx", "bad.xlsx"], ["b.xlsx", "c.xlsx"]]
    assert third["详细结果"].count() == 2
    # What is stored and merged is what one run over everything gives.
    stored = batch.stored_tables(spark, out)[LIS05]
    assert stored.count() == 5
    change = batch.merge_changed(spark, out, merged, "t")[LIS05]
    whole = merge.merged_rows(LIS05, stored, "t")
    found = incremental.read_incremental(spark, merged, LIS05).select(*[f"`{c}`" for c in whole.columns])
    assert change.files == 2 and sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))
    with pytest.raises(ValueError):
        batch.process_workbooks(spark, str(folder), out, numbers=[5], changed_only=True)


def test_comparison(spark):
    time = "timestamp'2024-01-01 00:00:00'"
    listing = spark.sql(f"""SELECT * FROM VALUES ('a', 1L, {time}), ('b', 2L, {time}), ('c', 3L, {time}), ('d', 4L, {time}), ('d', 4L, {time})
        AS t(path, length, modificationTime)""")
    known = spark.sql(f"""SELECT * FROM VALUES ('a', 1L, {time}), ('b', 9L, {time}), ('c', 3L, {time} + interval 1 second), ('e', 1L, {time})
        AS t(_source_file, length, modified)""")
    assert {tuple(r) for r in ledger.compare(listing, known).collect()} == {
        ("a", "same"), ("b", "changed"), ("c", "changed"), ("d", "new"), ("e", "gone")}
    assert ledger.compare(listing.limit(0), known.limit(0)).count() == 0


def test_a_run_with_a_table_that_failed_is_not_remembered(spark, tmp_path, monkeypatch):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    book(folder, "a.xlsx", ("P1", "阳性"))
    whole = batch.upsert_files

    def fails(df, files, path, run):
        if path.endswith(LIS05):
            raise OSError("disk full")
        return whole(df, files, path, run)

    with monkeypatch.context() as m:
        m.setattr(batch, "upsert_files", fails)
        report = batch.process_workbooks(spark, str(folder), out, changed_only=True)
    assert report["详细结果"].first()["状态"] == "partial"
    assert ledger.to_process(ledger.compare(batch.list_workbooks(spark, str(folder)), ledger.read_ledger(spark, out)))


def test_reasons_of_rejected_dates(spark, table):
    texts = ["2023-01-01", "2023/1/1 08:00", "20230101", "", " ", None, "1月4日", "2023-13-01", "20231301", "2023-01-01 25:00:00", "x"]
    df = table(["id", "日"], [(str(i), t) for i, t in enumerate(texts)])
    found = temporal.rejected_dates(df, ["日", "无"], ["id"])
    assert {(r.id, r.text, r.reason) for r in found.collect()} == {
        ("6", "1月4日", temporal.NO_LAYOUT), ("7", "2023-13-01", temporal.NO_DAY), ("8", "20231301", temporal.NO_DAY),
        ("9", "2023-01-01 25:00:00", temporal.NO_DAY), ("10", "x", temporal.NO_LAYOUT)}
    assert found.where(F.col("column") != "日").isEmpty()
    assert temporal.rejected_dates(df, ["无"], ["id"]).columns == ["id", "column", "text", "reason"]
