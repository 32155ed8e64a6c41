"""Names, dates and classification rules."""

import pytest
from pyspark.sql import functions as F

from careflow.functions import classify, naming, status, temporal


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_clean_names():
    dirty = ["诊断（ICD编码）", " 年龄（周岁） ", "a_b-c#d", "甲　 乙", "x"]
    assert naming.clean_names(dirty) == ["诊断ICD编码", "年龄周岁", "a_bcd", "甲 乙", "x"]


def test_clean_names_collision():
    assert naming.clean_names(["a-b", "ab", "a#b"]) == ["ab", "ab_2", "ab_3"]
    with pytest.raises(ValueError):
        naming.clean_names(["a-b", "ab"], on_collision="raise")


def test_clean_column_names_and_lookup(table):
    df = table([" 姓名 ", "年龄 ", " 性别"], [("张三", "20", "男")])
    assert naming.clean_column_names(df).columns == ["姓名", "年龄", "性别"]
    assert naming.find_columns(df.columns, ["姓名", "名字"]) == [" 姓名 "]
    assert naming.find_columns(df.columns, ["性别", "年龄"]) == ["年龄 ", " 性别"]
    assert naming.find_columns(df.columns, ["地址"]) == []
    assert naming.resolve_column(df.columns, ["性"]) == " 性别"
    with pytest.raises(ValueError):
        naming.resolve_column(df.columns, ["地址"])


def test_locate_tries_alternatives_in_turn():
    columns = ["诊断（ICD编码）", "诊断（文字）"]
    assert naming.locate(columns, ("诊断",)) == "诊断（ICD编码）"
    assert naming.locate(columns, (("诊断（文字）",), ("诊断",))) == "诊断（文字）"
    assert naming.locate(columns, (("无",),)) is None


@pytest.mark.parametrize("text, shown", [
    ("2023-01-01", "2023-01-01"),
    ("2023-01-01 00:00:00", "2023-01-01"),
    ("2023-01-01 10:30:00", "2023-01-01 10:30:00"),
    ("2023-01-01 10:30", "2023-01-01 10:30:00"),
    ("2023/01/02", "2023-01-02"),
    ("2023/1/2 3:04:05", "2023-01-02 03:04:05"),
    ("2023.01.03", "2023-01-03"),
    ("20230104", "2023-01-04"),
    (" 2023-01-01 ", "2023-01-01"),
    ("2023-02-30", ""), ("P001", ""), ("", ""), (None, ""), ("12:30:45", ""),
])
def test_dates(table, text, shown):
    df = table(["就诊日期", "备注"], [(text, text)])
    assert temporal.render_date_columns(df).first() == (shown, text)


def test_date_columns_in_any_zone(spark, table):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # This hour did not exist there; hospital time does not care.
        df = table(["入院日期"], [("2023-03-12 02:30:00",)])
        assert temporal.render_date_columns(df).first()[0] == "2023-03-12 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_unparsable_dates(table):
    df = table(["d"], [("2023-01-01",), ("x",), ("",), (None,), ("2023-13-01",)])
    assert df.agg(temporal.unparsable_dates(df, "d")).first()[0] == 2


def test_visit_type(table):
    rows = [("综合ICU", "门急诊", "ICU(I)"), ("发热急诊", "门急诊", "发热(F)"), ("急诊", "住院", "急诊(E)"),
            ("内科", "门急诊", "门诊(O)"), (None, "住院", "住院(H)"), (None, "检查", None), ("内科", None, None)]
    df = table(["d", "s", "want"], rows)
    got = df.select(classify.visit_type(F.col("d"), F.col("s")), "want").collect()
    assert all(r[0] == r[1] for r in got)


def test_codes(table):
    df = table(["h", "p"], [(None, "007"), ("031", "007"), (None, None)])
    hospital = classify.hospital_code(F.col("h"))
    assert column(df, classify.patient_code(hospital, F.col("p"))) == ["030-007", "031-007", None]


RESULTS = ["阳性", "检出", "未检出", "阴性", "Negative", "POSITIVE", "", None, "待定"]


def test_results(table):
    df = table(["r"], [(r,) for r in RESULTS])
    assert column(df, classify.infection_status(F.col("r"))) == [
        "确诊", "确诊", "排除", "排除", "排除", "确诊", "未知", "未知", "未知"]
    assert column(df, classify.result_type(F.col("r"))) == [
        "阳性", "阳性", "阴性", "阴性", "阴性", "阳性", "未知", "未知", "未知"]


def test_results_differ_in_compat_only_where_not_detected(table):
    df = table(["r"], [(r,) for r in RESULTS])
    now = column(df, classify.infection_status(F.col("r")))
    compat = column(df, classify.infection_status(F.col("r"), compat=True))
    assert [r for r, a, b in zip(RESULTS, now, compat) if a != b] == ["未检出"]


def test_detection_method(table):
    df = table(["m", "n"], [("快速", "新冠核酸"), (None, "新冠rt-pcr"), (None, "新冠抗原"), (None, "新冠igm"),
                            (None, "血常规"), ("", "新冠核酸"), (None, None)])
    assert column(df, classify.detection_method(F.col("m"), F.col("n"))) == [
        "快速", "核酸检测", "抗原检测", "抗体检测", "", "", ""]


def test_flags(table):
    rows = [("J18.900", "肺炎"), ("J18", "肺部感染"), ("J98.414", "新型冠状病毒感染"), ("J98.4", "肺炎"),
            ("J05", "肺炎"), ("XJ00", "新型冠状病毒感染，肺炎"), (None, "肺炎"), ("J18", None)]
    df = table(["c", "t"], rows)
    code, text = F.col("c"), F.col("t")
    assert column(df, classify.respiratory_flag(code)) == list("是是是否否是否是")
    assert column(df, classify.respiratory_flag(code, exact=True)) == list("否是是否否否否是")
    assert column(df, classify.covid_flag(text)) == ["否", "否", "是", "否", "否", "是", "否", None]
    assert column(df, classify.covid_flag(text, exact=True)) == list("否否是否否是否否")
    rs = classify.respiratory_flag(code)
    assert column(df, classify.pneumonia_flag(rs, text)) == list("是是否否否是否否")


AGES = ["-1", "2", "2.5", "3", "5", "6", "11", "12", "17", "18", "34", "35", "59", "60", "64", "65", "79", "80",
        "30岁", None, "NaN", "30d"]


def test_ages(table):
    df = table(["a", "g"], [(a, None) for a in AGES] + [(None, "男"), (None, "女"), ("x", "男")])
    bands = column(df, classify.age_band(F.col("a")))
    assert bands[:18] == (
        ["婴幼儿(0-2岁)"] * 3 + ["学龄前(3-5岁)"] * 2 + ["儿童(6-11岁)"] * 2 + ["青少年(12-17岁)"] * 2
        + ["青年(18-34岁)"] * 2 + ["中年(35-59岁)"] * 2 + ["老年(60-79岁)"] * 4 + ["高龄老人(80岁以上)"])
    assert bands[18:] == ["未知"] * 7
    categories = column(df, classify.population_category(F.col("a"), F.col("g")))
    assert categories[:18] == ["儿童青少年"] * 9 + ["成年人"] * 6 + ["老年人"] * 3
    assert categories[18:] == ["未分类"] * 4 + ["男性", "女性", "男性"]


def test_population_labels(table):
    df = table(["a", "g"], [("70", "男"), ("10", None), (None, "女"), (None, None)])
    assert column(df, classify.population_labels(F.col("a"), F.col("g"))) == [
        ["老年人", "男性"], ["儿童"], ["女性"], []]


def test_contains_any_leaves_out_redundant_keywords(table):
    df = table(["t"], [("抗病毒药物",), ("抗病",), (None,)])
    expression = classify.contains_any(F.col("t"), ("抗病毒", "抗病毒药", "抗病毒药物"))
    assert column(df, expression) == [True, False, None]
    assert str(expression).count("contains") == 1
    assert column(df, classify.contains_any(F.col("t"), ())) == [False] * 3


def test_status_and_names(spark, table):
    df = spark.createDataFrame(
        [(7, 0, None), (3, 4, None), (0, 7, None), (0, 0, "bad")], "ok int, bad int, e string")
    assert column(df, status.file_status(F.col("ok"), F.col("bad"), F.col("e"))) == [
        "success", "partial", "failed", "error"]
    assert column(df, status.merge_status(F.col("ok"), F.col("bad"))) == [
        "success", "partial", "error", "success"]
    assert column(df, status.merge_message(F.col("ok"), F.col("bad")))[:3] == [
        "所有sheet合并成功，共7个sheet", "部分sheet合并成功，3个成功，4个失败", "所有sheet合并失败"]
    rate = spark.createDataFrame([(1, 3), (0, 0)], "ok int, n int")
    assert column(rate, status.success_rate(F.col("ok"), F.col("n"))) == ["33.33%", "0.00%"]
    path = table(["p"], [("/a/b/测试原始数据1.v2.xlsx",), ("x.xlsx",)])
    assert column(path, status.output_name(F.col("p"))) == ["原始数据1.v2_processed", "x_processed"]
    assert column(path, status.output_name(F.col("p"), 3))[1] == "x合并phase1sheet3"
