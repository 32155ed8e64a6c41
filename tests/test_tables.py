"""The seven tables on small sheets."""

import pytest
from pyspark.sql import functions as F

from careflow.plans import diagnosis, infections, orders, patients, visits

OUT = [("P001", "张三", "30", "男", "2023-01-01", "内科", "感冒"),
       ("P002", "李四", "40", "女", "2023-01-02", "外科", "骨折"),
       ("P003", "王五", "50", "男", "2023-01-03", "内科", "高血压")]
IN = [("P004", "赵六", "60", "女", "2023-01-04", "2023-01-10", "内科", "肺炎"),
      ("P005", "钱七", "70", "男", "2023-01-05", "2023-01-15", "外科", "骨折"),
      ("P006", "孙八", "80", "女", "2023-01-06", "2023-01-20", "内科", "心脏病")]


@pytest.fixture
def out(table):
    return table(["患者ID", "姓名", "年龄", "性别", "就诊日期", "就诊科室", "诊断"], OUT)


@pytest.fixture
def stay(table):
    return table(["患者ID", "姓名", "年龄", "性别", "入院日期", "出院日期", "住院科室", "诊断"], IN)


def numbered(spark, columns, rows):
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _row_idx bigint"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


def dicts(df, *columns):
    return sorted(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())


def test_visits_of_plain_sheets(out, stay):
    merged = visits.merge_visits(out, stay)
    assert dicts(merged, "患者唯一编码", "来源", "就诊类别", "就诊日期", "就诊结束日期") == [
        ("030-P001", "门急诊", "门诊(O)", "2023-01-01", ""),
        ("030-P002", "门急诊", "门诊(O)", "2023-01-02", ""),
        ("030-P003", "门急诊", "门诊(O)", "2023-01-03", ""),
        ("030-P004", "住院", "住院(H)", "2023-01-04", "2023-01-10"),
        ("030-P005", "住院", "住院(H)", "2023-01-05", "2023-01-15"),
        ("030-P006", "住院", "住院(H)", "2023-01-06", "2023-01-20")]


def test_visits_compat_knows_only_the_exact_id_header(out, stay):
    merged = visits.merge_visits(out, stay, compat=True)
    assert dicts(merged.filter("`患者唯一编码` is null"), "患者编号") == [(None,)] * 6


VISITS = [("007", None, "2023-01-01 08:00:00", "内科"), ("007", None, "2023-01-01 09:00:00", "急诊"),
          ("007", "031", "2023-01-01 07:00:00", "ICU"), ("8", None, "2023-01-01", "a"),
          ("8", None, "2023-01-01", "b"), (None, None, "2023-01-01", "c"), (None, None, "2023-01-01", "d"),
          ("9", None, None, "e"), ("9", None, "bad", "f")]


@pytest.fixture
def clash(spark):
    """Same-day visits, ties, unknown patients, unknown dates, and a stay on the same day."""
    first = numbered(spark, ["患者编号", "医院编码", "就诊日期", "就诊科室"], VISITS)
    second = numbered(spark, ["患者编号", "入院日期", "就诊科室"],
                      [("007", "2023-01-01 10:00:00", "病房"), ("8", "2023-01-01", "病房")])
    return first, second


def test_latest_visit_per_patient_and_day(clash):
    merged = visits.merge_visits(*clash)
    assert dicts(merged.fillna(""), "患者唯一编码", "就诊科室") == [
        ("", "c"), ("030-007", "病房"), ("030-8", "a"), ("030-9", "e"), ("031-007", "ICU")]
    kept = visits.merge_visits(*clash, keep_null_keys=True)
    assert kept.count() == 7
    assert merged.drop("_source_rank", "_row_idx").columns == list(visits.HEADERS[visits.LIS01])


def test_latest_visit_without_row_numbers_is_still_one_per_key(clash):
    bare = [s.drop("_row_idx") for s in clash]
    merged = visits.merge_visits(*bare)
    assert dicts(merged.fillna(""), "患者唯一编码") == [
        ("",), ("030-007",), ("030-8",), ("030-9",), ("031-007",)]


def test_visit_audit(clash):
    every = visits.all_visits(*clash)
    assert dicts(visits.duplicate_visit_groups(every), "患者唯一编码", "group_size", "removed") == [
        ("030-007", 3, 2), ("030-8", 3, 2)]
    assert visits.duplicate_visits(every).count() == 6
    assert visits.removed_visits(every).first()[0] == every.count() - visits.merge_visits(*clash).count()


def test_files_do_not_mix(clash):
    def twice(df):
        return df.withColumn("_source_file", F.lit("a")).unionByName(
            df.withColumn("_source_file", F.lit("b")))

    merged = visits.merge_visits(*map(twice, clash))
    assert merged.groupBy("_source_file").count().collect() == [
        r for r in merged.groupBy("_source_file").count().collect() if r["count"] == 5]


def test_flags_follow_the_visits(spark):
    first = numbered(spark, ["患者编号", "就诊日期", "诊断（ICD编码）", "诊断（文字）"], [
        ("1", "2023-01-01", "J18.900", "肺炎"), ("2", "2023-01-01", "J18", "新型冠状病毒感染"),
        ("3", "2023-01-01", None, None)])
    second = numbered(spark, ["患者编号", "入院日期"], [])
    merged = visits.merge_visits(first, second)
    flags = ("患者编号", "新冠患者", "RS患者", "诊断合并为肺炎")
    got = diagnosis.flag_diagnoses(merged)
    assert len(got.columns) - 2 == 17
    assert dicts(got, *flags) == [("1", "否", "是", "是"), ("2", "是", "是", "否"), ("3", None, "否", "否")]
    exact = diagnosis.flag_diagnoses(merged, exact=True)
    assert dicts(exact, *flags) == [("1", "否", "否", "否"), ("2", "是", "是", "否"), ("3", "否", "否", "否")]


def test_diagnosis_extract(out, stay):
    got = diagnosis.diagnosis_extract(out, stay)
    assert dicts(got, "患者ID", "就诊类型", "诊断", "诊断类型")[0] == ("P001", "门急诊", "感冒", None)
    compat = diagnosis.diagnosis_extract(out, stay, compat=True)
    assert dicts(compat, "患者ID", "就诊类型", "诊断", "诊断类型", "新冠患者")[0] == (
        "P001", "P001", "感冒", "感冒", "P001")
    assert diagnosis.diagnosis_extract(out.drop("诊断"), stay).count() == 3


LABS = [("1", "新冠核酸", "阳性", "2023-01-01", None), ("2", "新冠抗原", "未检出", "2023-01-02", "快速"),
        ("3", "新冠抗体IgM", None, "2023-01-03", None), ("4", "pcr", "阳性", "2023-01-04", None),
        ("5", "血常规", "阳性", "2023-01-05", None), ("6", None, "阳性", "2023-01-06", None)]


@pytest.fixture
def labs(table):
    return table(["患者ID", "检查名称", "检查结果", "检查日期", "检查方法"], LABS)


def test_infections(table, out, stay, labs):
    ill = table(["患者ID", "就诊日期", "诊断编码", "诊断（文字）"],
                [("9", "2023-02-01 10:00:00", "U07", "COVID-19"), ("8", "2023-02-01", "新冠", "感冒")])
    assert infections.infection_cases(out, stay, labs).count() == 3
    got = infections.infection_cases(ill, stay, labs)
    assert dicts(got, "患者ID", "就诊类型", "就诊日期", "感染状态", "检测日期")[-1] == (
        "9", "门急诊", "2023-02-01 10:00:00", "确诊", None)
    tests = got.filter("`就诊类型` = '检查'")
    assert dicts(tests, "患者ID", "感染状态", "检测结果", "检测日期", "就诊日期", "数据来源") == [
        ("1", "确诊", "阳性", "2023-01-01", "2023-01-01", "检查"),
        ("2", "排除", "未检出", "2023-01-02", "2023-01-02", "检查"),
        ("3", "未知", "", "2023-01-03", "2023-01-03", "检查")]
    # As written the first diagnosis column (here the code) decides and IDs fill visit columns.
    compat = infections.infection_cases(ill, stay, labs, compat=True)
    assert dicts(compat, "患者ID", "就诊类型", "就诊日期", "感染状态") == [
        ("1", "1", "", "确诊"), ("2", "2", "", "确诊"), ("3", "3", "", "未知"), ("8", "8", "", "确诊")]


def test_lab_tests(labs):
    got = orders.lab_tests(labs)
    assert dicts(got, "患者ID", "检查方法", "结果类型", "检查结果") == [
        ("1", "核酸检测", "阳性", "阳性"), ("2", "快速", "阴性", "未检出"), ("3", "抗体检测", "未知", "")]
    compat = orders.lab_tests(labs, compat=True)
    assert dicts(compat, "患者ID", "结果类型") == [("1", "阳性"), ("2", "未检出"), ("3", "")]
    assert orders.lab_tests(labs.drop("检查结果")).count() == 0


def test_antiviral_orders(table):
    drugs = table(["患者ID", "药品名称", "医嘱日期", "剂量", "频次", "给药途径"], [
        (str(i), name, "2023-01-01", "75mg", "一日两次", "口服") for i, name in enumerate(
            ["奥司他韦胶囊", "Oseltamivir", "oseltamivir", "抗病毒口服液", "阿莫西林", None])])
    got = orders.antiviral_orders(drugs)
    assert dicts(got, "患者ID", "药物名称", "药物类型", "用药日期", "剂量", "频次", "用药途径") == [
        ("0", "奥司他韦胶囊", "抗病毒药物", "2023-01-01", "75mg", "一日两次", "口服"),
        ("1", "Oseltamivir", "抗病毒药物", "2023-01-01", "75mg", "一日两次", "口服"),
        ("3", "抗病毒口服液", "抗病毒药物", "2023-01-01", "75mg", "一日两次", "口服")]
    assert orders.antiviral_orders(drugs.withColumnRenamed("药品名称", "x")).count() == 0


def test_population(out, stay):
    got = patients.population_split(patients.all_patients(out, stay))
    assert dicts(got, "患者ID", "年龄", "年龄段", "人群类别", "地区") == [
        ("P001", "30", "青年(18-34岁)", "成年人", ""), ("P002", "40", "中年(35-59岁)", "成年人", ""),
        ("P003", "50", "中年(35-59岁)", "成年人", ""), ("P004", "60", "老年(60-79岁)", "成年人", ""),
        ("P005", "70", "老年(60-79岁)", "老年人", ""), ("P006", "80", "高龄老人(80岁以上)", "老年人", "")]
    compat = patients.population_split(patients.all_patients(out, stay), compat=True)
    assert dicts(compat, "年龄段")[0] == ("30",)
    assert patients.population_split(out.drop("患者ID")).count() == 0


def test_unique_patients(spark):
    first = numbered(spark, ["出生日期", "患者ID", "姓名", "就诊日期", "电话"], [
        ("1990-01-01", "1", "早", "2023-01-01", None), ("1980-01-01", "1", "晚", "2023-03-01", "110"),
        ("1990-01-01", "2", "坏", "bad", None), ("1990-01-01", "2", "空", None, None),
        (None, None, "无", "2023-01-01", None)])
    second = numbered(spark, ["患者ID", "姓名", "入院日期"], [
        ("1", "住", "2023-02-01"), ("3", "院", "2023-02-01 10:00:00")])
    everyone = patients.all_patients(first, second)
    got = patients.unique_patients(everyone)
    assert dicts(got, "患者ID", "姓名", "出生日期", "联系方式", "首次就诊日期", "最近就诊日期", "就诊次数") == [
        ("1", "晚", "1980-01-01", "110", "2023-01-01", "2023-03-01", 3),
        ("2", "坏", "1990-01-01", "", "", "", 2),
        ("3", "院", None, "", "2023-02-01 10:00:00", "2023-02-01 10:00:00", 1)]
    # As written the birth date is the first date column, and the latest birth wins.
    compat = patients.unique_patients(everyone, compat=True)
    assert dicts(compat, "患者ID", "姓名", "就诊次数") == [("1", "早", None), ("2", "坏", None), ("3", "院", None)]
    assert dicts(patients.patient_ids(everyone), "患者ID") == [("1",), ("2",), ("3",)]


def test_unique_patients_shuffles_once(spark):
    sheet = numbered(spark, ["患者ID", "姓名", "就诊日期"], [("1", "a", "2023-01-01")])
    plan = patients.unique_patients(patients.all_patients(sheet, sheet))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_existing_header_decides_the_target(out, stay, labs):
    got = infections.infection_cases(out, stay, labs, target=["病人ID", "检测结果", "新列"])
    assert dicts(got, "病人ID", "检测结果", "新列")[0] == ("1", "阳性", None)


def test_names_are_cleaned_before_they_are_compared(table):
    sheet = table(["患者（ID）", " 姓名 ", "年-龄"], [("1", "甲", "70")])
    other = table(["患者ID", "姓名", "年龄"], [("2", "乙", "10")])
    got = patients.population_split(patients.all_patients(sheet, other))
    assert dicts(got, "患者ID", "姓名", "年龄", "人群类别") == [
        ("1", "甲", "70", "老年人"), ("2", "乙", "10", "儿童青少年")]
