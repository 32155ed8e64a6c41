"""Workbook scan, table store, batch and merge."""

import re
import tracemalloc

import pytest
from pyspark.sql import functions as F
from workbooks import Date, edit_part, write_workbook

from careflow.plans import batch, merge, registry, reports
from careflow.schemas import LIS01, LIS02, LIS04, LIS05, LIS06, TABLES
from careflow.sources import sinks, tables, workbook

BOOK = {
    "门急诊信息": [
        ["患者ID", "姓名", "年龄", "性别", "就诊日期", "就诊科室", "诊断"],
        ["P001", "张三", 30, "男", "2023-01-01", "ICU", "新冠肺炎"],
        ["P001", "张三", 30, "男", Date(44927.5), "内科", "感冒"],
        ["030", "王五", 50.5, "NA", "2023-01-03", None, "高血压"]],
    "住院信息": [
        ["病人ID", "姓名", "年龄", "性别", "入院日期", "出院日期", "诊断"],
        ["P004", "赵六", 60.0, "女", "2023-01-04", "2023-01-10", "肺炎"]],
    "药物医嘱信息": [["患者ID", "药物名称", "开始日期"], ["P001", "奥司他韦胶囊", "2023-01-01"],
                ["P001", "阿莫西林", "2023-01-01"]],
    "检查信息": [["患者ID", "检查名称", "检查结果", "检查日期"], ["P001", "新冠核酸", "未检出", "2023-01-01"],
             ["P002", "血常规", "正常", "2023-01-01"]],
    "统计数据": [["统计项目", "统计值"], ["总患者数", 6]],
}


@pytest.fixture
def folder(tmp_path):
    """A good workbook, one with other headers and a sheet missing, a damaged one, no workbook."""
    source = tmp_path / "in"
    source.mkdir()
    write_workbook(source / "测试原始数据a.xlsx", BOOK)
    other = {k: v for k, v in BOOK.items() if k != "统计数据"}
    other["门急诊信息"] = [["姓名", "病人ID", "诊断文字", "诊断ICD编码", "就诊日期"],
                     ["李四", "P001", "新型冠状病毒感染", "J18", "2023/01/01 08:00:00"]]
    other["住院信息"] = [BOOK["住院信息"][0], ["P004", "赵六", 60, "女", "1月4日", None, "肺炎"]]
    other["药物医嘱信息"] = BOOK["药物医嘱信息"][:1]
    write_workbook(source / "b.xlsx", other, shared=False)
    write_workbook(source / "c.xlsx", BOOK, damage="检查信息")
    (source / "bad.xlsx").write_bytes(b"not a workbook")
    (source / "notes.txt").write_text("x")
    return source


def names(df, column):
    return sorted(r[0].rsplit("/", 1)[-1] for r in df.select(column).distinct().collect())


def test_list_workbooks(spark, folder):
    assert names(workbook.list_workbooks(spark, str(folder)), "path") == [
        "b.xlsx", "bad.xlsx", "c.xlsx", "测试原始数据a.xlsx"]
    assert names(workbook.list_workbooks(spark, str(folder), "b*.xlsx"), "path") == ["b.xlsx", "bad.xlsx"]


def test_scan_of_every_sheet_keeps_text_and_reads_dates(spark, tmp_path):
    write_workbook(tmp_path / "x.xlsx", {
        "甲": [["编码", "日期", "数", None, "真"], ["030", Date(44927.5), 2.50, "x", True], None,
              ["031", Date(44928), 3.0, None, False]],
        "空": []})
    scan = workbook.scan_workbooks(spark, str(tmp_path))
    rows = workbook.any_sheet(scan, "甲", ["编码", "日期", "数", "Unnamed: 3", "真", "无"])
    got = [tuple(r)[1:] for r in rows.orderBy("_row_idx").collect()]
    assert got == [
        (0, "030", "2023-01-01 12:00:00", "2.5", "x", "True", None),
        (1, None, None, None, None, None, None),
        (2, "031", "2023-01-02 00:00:00", "3", None, "False", None)]
    assert {r.sheet for r in scan.filter("_row_idx = -1").collect()} == {"甲", "空"}


def test_damaged_attributes_do_not_stop_the_scan():
    assert workbook._column_number("AB7", 0) == 27
    assert workbook._column_number("7", 5) == 5
    assert workbook._column_number("ZZZZZZ1", 0) >= workbook.MAX_COLUMNS
    assert workbook._whole("x", 3) == 3 and workbook._whole("4", 3) == 4


def test_batch(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    report = batch.process_workbooks(spark, str(folder), out)
    summary = {r["指标"]: r["数值"] for r in report["总体统计"].collect()}
    assert summary == {"总文件数": "4", "处理文件数": "4", "成功文件数": "1", "部分成功文件数": "2",
                       "失败文件数": "1", "成功率": "25.00%"}
    details = {r["文件名"]: r for r in report["详细结果"].collect()}
    assert {k: r["状态"] for k, r in details.items()} == {
        "原始数据a": "success", "b": "partial", "c": "partial", "bad": "error"}
    assert details["b"]["失败处理的sheet"] == "sheet6"
    assert details["c"]["失败处理的sheet"] == "sheet3, sheet5"
    assert details["bad"]["错误信息"].startswith("BadZipFile")

    assert [tuple(r)[1:] for r in report["日期异常"].collect()] == [("住院信息", 1)]
    stored = batch.stored_tables(spark, out)
    assert {t: df.count() for t, df in stored.items()} == dict(zip(TABLES, (8, 8, 4, 2, 2, 8, 8)))
    b = stored[LIS02].filter(F.col("_source_file").endswith("/b.xlsx") & (F.col("来源") == "门急诊"))
    row = b.first()
    assert (row["患者唯一编码"], row["就诊日期"], row["新冠患者"], row["RS患者"]) == (
        "030-P001", "2023-01-01 08:00:00", "是", "是")
    assert names(stored[LIS05], "_source_file") == ["b.xlsx", "测试原始数据a.xlsx"]
    assert "030" in {r["患者ID"] for r in stored[LIS06].collect()}

    # Every file's tables hold what the file alone gives.
    alone = batch.process_workbooks(spark, str(folder), str(tmp_path / "one"), pattern="b.xlsx")
    assert alone["详细结果"].count() == 1
    one = batch.stored_tables(spark, str(tmp_path / "one"))
    for t in TABLES:
        same = stored[t].filter(F.col("_source_file").endswith("/b.xlsx"))
        assert sorted(map(repr, same.collect())) == sorted(map(repr, one[t].collect())), t

    merged = str(tmp_path / "merged")
    final = batch.merge_processed(spark, out, merged, "2024-01-01 00:00:00")
    lines = {r["指标"]: r["数值"] for r in final["总体统计"].collect()}
    assert lines["合并状态"] == "success" and lines["输入文件数"] == "4"
    assert [r["行数"] for r in final["详细结果"].collect()] == [4, 4, 3, 1, 1, 3, 3]
    assert [r["文件名"] for r in final["输入文件列表"].orderBy("序号").collect()] == [
        "b.xlsx", "bad.xlsx", "c.xlsx", "测试原始数据a.xlsx"]
    skipped = {(r.file.rsplit("/", 1)[-1], r.sheet, r.reason) for r in final["跳过的文件"].collect()}
    assert skipped >= {("b.xlsx", LIS04, "empty"), ("b.xlsx", LIS06, "missing sheet"),
                       ("c.xlsx", LIS05, "missing sheet"), ("bad.xlsx", LIS01, "unreadable")}
    assert len(skipped) == 2 + 2 + 7
    visits = merge.read_merged(spark, merged, LIS01)
    assert {"年龄周岁", "诊断ICD编码", "数据来源", "数据更新时间"} <= set(visits.columns)
    assert {r["数据更新时间"] for r in visits.collect()} == {"2024-01-01 00:00:00"}


def test_batch_of_one_table(spark, folder, tmp_path):
    report = batch.process_workbooks(spark, str(folder), str(tmp_path / "o"), "b.xlsx", numbers=[4])
    assert report["详细结果"].first()["目标文件路径"].endswith("/b合并phase1sheet4")
    assert report["详细结果"].first()["状态"] == "success"


def test_rerun_replaces_only_the_processed_files(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    batch.process_workbooks(spark, str(folder), out)
    fewer = dict(BOOK)
    fewer["药物医嘱信息"] = BOOK["药物医嘱信息"][:1]
    write_workbook(folder / "b.xlsx", fewer)
    batch.process_workbooks(spark, str(folder), out, pattern="b.xlsx")
    stored = batch.stored_tables(spark, out)
    assert names(stored[LIS04], "_source_file") == ["c.xlsx", "测试原始数据a.xlsx"]
    assert names(stored[LIS06], "_source_file") == ["b.xlsx", "c.xlsx", "测试原始数据a.xlsx"]
    assert stored[LIS02].count() == stored[LIS01].count()


def test_merge_after_a_partial_rerun_is_of_all_files(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    batch.process_workbooks(spark, str(folder), out)
    batch.process_workbooks(spark, str(folder), out, pattern="b.xlsx")
    final = batch.merge_processed(spark, out, str(tmp_path / "merged"), "t")
    assert [r["文件名"] for r in final["输入文件列表"].orderBy("序号").collect()] == [
        "b.xlsx", "bad.xlsx", "c.xlsx", "测试原始数据a.xlsx"]
    lines = {r["指标"]: r["数值"] for r in final["总体统计"].collect()}
    assert lines["输入文件数"] == "4"
    assert len({r.file for r in final["跳过的文件"].collect()}) == 3


def test_a_table_that_fails_leaves_the_others_and_what_was_stored(spark, folder, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    batch.process_workbooks(spark, str(folder), out, numbers=[4, 5])
    before = batch.stored_tables(spark, out)[LIS04].count()

    def broken(*args, **options):
        raise RuntimeError("no such drug list\nand more")

    monkeypatch.setattr(registry.orders, "antiviral_orders", broken)
    report = batch.process_workbooks(spark, str(folder), out, numbers=[4, 5])
    details = {r["文件名"]: r for r in report["详细结果"].collect()}
    good = details["原始数据a"]
    assert (good["状态"], good["成功处理的sheet"], good["失败处理的sheet"]) == ("partial", "sheet5", "sheet4")
    assert good["错误信息"] == "sheet4: RuntimeError: no such drug list"
    assert details["bad"]["状态"] == "error" and details["bad"]["错误信息"].startswith("BadZipFile")
    assert batch.stored_tables(spark, out)[LIS04].count() == before > 0


def test_readings_are_no_text(spark, tmp_path):
    """Phonetic runs of shared and inline strings are left out, rich text is joined."""
    write_workbook(tmp_path / "x.xlsx", {"甲": [["名"], ["东京"], ["大阪"]]})
    shared = ('<si><t>名</t></si><si><t>东京</t><rPh sb="0" eb="2"><t>トウキョウ</t></rPh></si>'
              '<si><r><t>大</t></r><r><t>阪</t></r><rPh sb="0" eb="2"><t>オオサカ</t></rPh></si>')
    edit_part(tmp_path / "x.xlsx", "xl/sharedStrings.xml", lambda xml: re.sub("(?<=>)<si>.*</si>", shared, xml))
    write_workbook(tmp_path / "y.xlsx", {"甲": [["名"], ["东京"]]}, shared=False)
    edit_part(tmp_path / "y.xlsx", "xl/worksheets/sheet1.xml",
              lambda xml: xml.replace("<t>东京</t>", "<r><t>东京</t></r><rPh><t>トウキョウ</t></rPh>"))
    rows = workbook.any_sheet(workbook.scan_workbooks(spark, str(tmp_path)), "甲", ["名"]).collect()
    assert sorted(r["名"] for r in rows) == ["东京", "东京", "大阪"]


def peak_mb(rows):
    """Memory that reading a sheet of so many rows takes beyond the file itself."""
    from io import BytesIO

    held = BytesIO()
    write_workbook(held, {"甲": [["a"] * 20, *([[1] * 20] * rows)]}, shared=False)
    book = workbook._Workbook(held.getvalue())
    tracemalloc.start()
    book.check("甲")
    assert sum(1 for _ in book.rows("甲")) == rows + 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_memory_stays_flat_as_sheets_grow():
    small, large = peak_mb(2_000), peak_mb(16_000)
    assert large < small + 5


def data_files(path):
    return {str(f) for f in path.rglob("*.parquet") if "_files" not in f.parts}


def test_a_rerun_leaves_all_other_files_in_place(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "_source_file string, x int")
    sinks.upsert_files(df, df, str(path), "007")
    before = {f: (path / f).stat().st_mtime_ns for f in data_files(path)}
    with pytest.raises(ValueError):
        sinks.upsert_files(df, df, str(path), "007")
    sinks.upsert_files(df.filter("x = 2").withColumn("x", F.lit(5)), df.filter("x = 2"), str(path), "008")
    assert before == {f: (path / f).stat().st_mtime_ns for f in data_files(path) if f in before}
    assert sorted(map(tuple, sinks.read_store(spark, str(path)).collect())) == [("a", 1), ("b", 5), ("c", 3)]
    assert sinks.read_store(spark, str(path), df.schema, "007").count() == 3
    sinks.compact_store(spark, str(path), "009")
    assert sorted(map(tuple, sinks.read_store(spark, str(path)).collect())) == [("a", 1), ("b", 5), ("c", 3)]
    assert not data_files(path) & set(before)


def test_rows_of_a_run_that_failed_are_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1)], "_source_file string, x int")
    sinks.upsert_files(df, df, path, "1")
    df.withColumn("x", F.lit(9)).withColumn(sinks.PART, F.lit("run-2")).write.mode("append").partitionBy(sinks.PART).parquet(path)
    assert [r["x"] for r in sinks.read_store(spark, path).collect()] == [1]
    sinks.upsert_files(df.withColumn("x", F.lit(3)), df, path, "2")
    assert [r["x"] for r in sinks.read_store(spark, path).collect()] == [3]


def test_store_upsert(spark, tmp_path):
    path = str(tmp_path / "t")

    def put(run, files, rows):
        df = spark.createDataFrame(rows, "_source_file string, x int")
        listed = spark.createDataFrame([(f,) for f in files], "_source_file string")
        sinks.upsert_files(df, listed, path, run)
        stored = sinks.read_store(spark, path, df.schema)
        return sorted((r["_source_file"], r["x"]) for r in stored.collect())

    assert put("1", "abc", [("a", 1), ("a", 2), ("b", 3)]) == [("a", 1), ("a", 2), ("b", 3)]
    assert put("2", "b", [("b", 4), ("b", 5)]) == [("a", 1), ("a", 2), ("b", 4), ("b", 5)]
    assert put("3", "ad", [("d", 6)]) == [("b", 4), ("b", 5), ("d", 6)]
    assert put("4", "bd", []) == []


def test_merge_keys(spark):
    rows = [("b.xlsx", 0, "1", "x", "2023-01-01 08:00:00"), ("a.xlsx", 1, "1", "y", "2023-01-01"),
            ("a.xlsx", 0, "1", "z", "2023-01-02"), ("a.xlsx", 2, None, "n", "2023-01-02"),
            ("b.xlsx", 3, None, "m", "2023-01-02")]
    df = spark.createDataFrame(
        rows, "_source_file string, _row_idx bigint, `患者编号` string, v string, `就诊日期` string")
    by_id = merge.merge_table(df, "t")
    assert sorted(r.v for r in by_id.collect()) == ["n", "z"]
    by_day = merge.merge_table(df, "t", ("患者编号", "就诊日期"))
    assert sorted(r.v for r in by_day.collect()) == ["n", "y", "z"]
    kept = merge.merge_table(df, "t", ("患者编号", "就诊日期"), keep_null_keys=True)
    assert sorted(r.v for r in kept.collect()) == ["m", "n", "y", "z"]
    plain = df.select("_source_file", "_row_idx", F.lit("same").alias("v"))
    assert merge.merge_table(plain, "t").count() == 2
    assert merge.id_column(["姓名", "covid状态", "编号"]) == "covid状态"


def test_merge_isolates_a_failing_table(spark, tmp_path):
    good = spark.createDataFrame([("f", 0, "1")], "_source_file string, _row_idx bigint, `患者ID` string")
    broken = good.withColumn("x", F.raise_error(F.lit("broken")))
    report = merge.merge_results(
        spark, {LIS06: good, LIS04: broken}, spark.createDataFrame([("f",)], "path string"),
        str(tmp_path / "m"), "t", compat=True)
    states = {r["sheet名称"]: r["状态"] for r in report["详细结果"].collect()}
    assert states[LIS06] == "success" and states[LIS04] == "error" and states[LIS01] == "empty"
    assert {r["数值"] for r in report["总体统计"].collect()} >= {"partial", "1", "6"}
    assert merge.read_merged(spark, str(tmp_path / "m"), LIS01).count() == 0


def test_report_without_files(spark):
    none = spark.createDataFrame([], "source_file string, sheet string, ok boolean, error string")
    lines = {r["指标"]: r["数值"] for r in reports.batch_summary(reports.file_results(none)).collect()}
    assert lines["总文件数"] == "0" and lines["成功率"] == "0.00%"


def test_read_table_keeps_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,x\n030,1\n")
    (tmp_path / "b.csv").write_text("code,x\n031,2\n")
    df = tables.read_table(spark, str(tmp_path), "csv", pattern="*.csv")
    assert {r.code for r in df.collect()} == {"030", "031"}
    assert names(df, "_source_file") == ["a.csv", "b.csv"]
    df.coalesce(1).drop("_source_file").write.parquet(str(tmp_path / "p"))
    numbered = tables.read_table(spark, [str(tmp_path / "p")])
    assert sorted(r["_row_idx"] for r in numbered.collect()) == [0, 1]


PATIENTS = "_source_file string, _row_idx bigint, `患者ID` string, `姓名` string, `首次就诊日期` string, `最近就诊日期` string, `就诊次数` bigint"


def test_merge_of_patients_counts_all_files(spark):
    rows = [("a.xlsx", 0, "P001", "old", "2023-01-01", "2023-01-01 12:00:00", 2),
            ("b.xlsx", 0, "P001", "new", "2022/05/01", "2024-05-01", 2),
            ("b.xlsx", 1, None, "x", "2023-01-01", "2023-01-01", 1), ("a.xlsx", 1, " ", "y", "", "", None),
            ("a.xlsx", 2, "P002", "z", "", "no date", 1), ("b.xlsx", 2, "P002", "w", "", "", 3)]
    df = spark.createDataFrame(rows, PATIENTS)
    got = {(r["患者ID"], r["姓名"]): (r["首次就诊日期"], r["最近就诊日期"], r["就诊次数"], r["数据来源"])
           for r in merge.merge_patients(df, "t").collect()}
    assert got == {
        ("P001", "new"): ("2022-05-01", "2024-05-01", 4, "b.xlsx"), (None, "x"): ("2023-01-01", "2023-01-01", 1, "b.xlsx"),
        (" ", "y"): ("", "", None, "a.xlsx"), ("P002", "z"): ("", "", 4, "a.xlsx")}


def test_merge_keeps_tests_of_one_day_and_unknown_patients(spark):
    rows = [("a", 0, "P1", "核酸", "2023-01-01 08:00:00", "阳性"), ("a", 1, "P1", "核酸", "2023-01-01 18:00:00", "阴性"),
            ("b", 0, "P1", "核酸", "2023-01-01 08:00:00", "未检出"), ("b", 1, None, "核酸", "2023-01-01", "阴性"),
            ("c", 0, None, "核酸", "2023-01-01", "阴性")]
    df = spark.createDataFrame(
        rows, "_source_file string, _row_idx bigint, `患者ID` string, `检查名称` string, `检查日期` string, `检查结果` string")
    kept = merge.merged_rows(LIS05, df, "t")
    assert sorted(r["检查结果"] for r in kept.collect()) == ["阳性", "阴性", "阴性", "阴性"]
    assert merge.merged_rows(LIS05, df, "t", compat=True).count() == 2


def test_merge_of_days_in_any_layout(spark):
    rows = [("a", 0, "P1", "2023-01-01"), ("b", 0, "P1", "2023/01/01 08:00"), ("c", 0, "P1", "20230101"),
            ("a", 1, "P1", "1月4日"), ("b", 1, "P1", "1月4日"), ("b", 2, "P1", "")]
    df = spark.createDataFrame(rows, "_source_file string, _row_idx bigint, `患者唯一编码` string, `就诊日期` string")
    days = [r["就诊日期"] for r in merge.merged_rows(LIS01, df, "t").collect()]
    assert sorted(days) == ["", "1月4日", "1月4日", "2023-01-01"]


def test_merge_without_row_numbers_is_the_same_in_any_partitioning(spark):
    df = spark.range(4000).select(F.lit("f.csv").alias("_source_file"), F.lit("k").alias("患者ID"), F.col("id").alias("v"))
    assert {merge.merge_table(df.repartition(n), "t", ["患者ID"]).first()["v"] for n in (1, 3, 7)} == {0}
