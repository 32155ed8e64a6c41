"""The seven clinical tables and their variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.catalog import inputs as i
from careflow.catalog.registry import query, read
from careflow.functions.naming import quoted
from careflow.functions.temporal import render_timestamp
from careflow.plans import diagnosis, infections, orders, patients, visits
from careflow.schemas import ROW_IDX


def _sheets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return i.outpatients(spark, sf_dir), i.inpatients(spark, sf_dir)


def _pick(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*map(quoted, columns), F.col(ROW_IDX).alias("row_key"))


@query("visits_merged", f"""WITH {i.LATEST_SQL}
SELECT {i.VISIT_COLUMNS_SQL} {i.STAY_COLUMNS_SQL}, row_key FROM latest""")
def visits_merged(spark, sf_dir):
    merged = visits.merge_visits(*_sheets(spark, sf_dir))
    return _pick(merged, *i.VISIT_COLUMNS, *i.STAY_COLUMNS)


@query("visits_merged_keep_null_keys", f"""WITH {i.VISITS_SQL}
SELECT {i.VISIT_COLUMNS_SQL}, row_key FROM (
  SELECT * FROM visits WHERE patient_code IS NOT NULL AND visit_day IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY patient_code, visit_day
                             ORDER BY ts DESC, src_rank, row_key) = 1
  UNION ALL SELECT * FROM visits WHERE patient_code IS NULL OR visit_day IS NULL)""")
def visits_merged_keep_null_keys(spark, sf_dir):
    merged = visits.merge_visits(*_sheets(spark, sf_dir), keep_null_keys=True)
    return _pick(merged, *i.VISIT_COLUMNS)


@query("visit_duplicates_audit", f"""WITH {i.VISITS_SQL}
SELECT patient_code AS "患者唯一编码", strftime(visit_day, '%Y-%m-%d') AS visit_day,
  count(*) AS group_size, count(*) - 1 AS removed,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS kept_ts, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts
FROM visits WHERE patient_code IS NOT NULL AND visit_day IS NOT NULL
GROUP BY patient_code, visit_day HAVING count(*) > 1""")
def visit_duplicates_audit(spark, sf_dir):
    groups = visits.duplicate_visit_groups(visits.all_visits(*_sheets(spark, sf_dir)))
    return groups.select(
        "患者唯一编码", F.col(visits.VISIT_DAY).cast("string").alias("visit_day"), "group_size",
        "removed", *[F.substring(c, 1, 19).alias(c) for c in ("kept_ts", "first_ts")],
    )


@query("visit_duplicate_members", f"""WITH {i.VISITS_SQL}
SELECT patient_code AS "患者唯一编码", strftime(visit_day, '%Y-%m-%d') AS visit_day,
  source AS "来源", dept AS "就诊科室", visit_type AS "就诊类别", {i.shown("ts")} AS "就诊日期",
  row_key, count(*) OVER (PARTITION BY patient_code, visit_day) AS group_size
FROM visits WHERE patient_code IS NOT NULL AND visit_day IS NOT NULL
QUALIFY count(*) OVER (PARTITION BY patient_code, visit_day) > 1""")
def visit_duplicate_members(spark, sf_dir):
    members = visits.duplicate_visits(visits.all_visits(*_sheets(spark, sf_dir)))
    return members.select(
        "患者唯一编码", F.col(visits.VISIT_DAY).cast("string").alias("visit_day"),
        "来源", "就诊科室", "就诊类别", "就诊日期", F.col(ROW_IDX).alias("row_key"), "group_size",
    )


@query("visits_removed", f"""WITH {i.VISITS_SQL}
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS removed_rows
FROM (SELECT count(*) AS n FROM visits GROUP BY patient_code, visit_day)""")
def visits_removed(spark, sf_dir):
    return visits.removed_visits(visits.all_visits(*_sheets(spark, sf_dir)))


# The lists as the SQL knows them, apart from the library's, so that a wrong entry shows.
SQL_COVID_DIAGNOSIS = ("新冠", "冠状病毒", "COVID", "SARS-CoV-2", "新型冠状")
SQL_COVID_TEST = ("新冠", "冠状病毒", "COVID", "SARS-CoV-2", "核酸", "PCR", "抗原")
SQL_ANTIVIRAL = (
    "利巴韦林", "阿比多尔", "奥司他韦", "扎那米韦", "帕拉米韦", "法匹拉韦",
    "瑞德西韦", "洛匹那韦", "利托那韦", "达芦那韦", "克立芝", "克力芝",
    "抗病毒", "抗病毒药", "抗病毒药物", "抗病毒治疗",
    "Ribavirin", "Arbidol", "Oseltamivir", "Zanamivir", "Peramivir", "Favipiravir",
    "Remdesivir", "Lopinavir", "Ritonavir", "Darunavir", "Kaletra",
)
SQL_RS_CODES = (
    "R50", "J00", "J01", "J02", "J03", "J04", "J06", "J07", "J08", "J09", "J10", "J11",
    "J12", "J13", "J14", "J15", "J16", "J17", "J18", "J20", "J21", "J98.414", "J98.802",
)

_ANY_RS = " OR ".join(f"contains(code, '{c}')" for c in SQL_RS_CODES)
_EXACT_RS = "code IN (" + ", ".join(f"'{c}'" for c in SQL_RS_CODES) + ")"


def _flags_sql(covid: str, rs: str) -> str:
    return f"""WITH {i.LATEST_SQL}, flagged AS (
  SELECT *, {covid} AS covid, CASE WHEN {rs} THEN '是' ELSE '否' END AS rs FROM latest)
SELECT {i.VISIT_COLUMNS_SQL}, covid AS "新冠患者", rs AS "RS患者",
  CASE WHEN rs = '是' AND (contains(words, '肺部感染') OR contains(words, '肺炎'))
       THEN '是' ELSE '否' END AS "诊断合并为肺炎", row_key FROM flagged"""


_FLAGS = ("新冠患者", "RS患者", "诊断合并为肺炎")


@query("diagnosis_flags", _flags_sql(
    "CASE WHEN contains(words, '新型冠状病毒感染') THEN '是' WHEN words IS NOT NULL THEN '否' END",
    _ANY_RS))
def diagnosis_flags(spark, sf_dir):
    merged = visits.merge_visits(*_sheets(spark, sf_dir))
    return _pick(diagnosis.flag_diagnoses(merged), *i.VISIT_COLUMNS, *_FLAGS)


@query("diagnosis_flags_exact", _flags_sql(
    "CASE WHEN contains(words, '新型冠状病毒感染') THEN '是' ELSE '否' END", _EXACT_RS))
def diagnosis_flags_exact(spark, sf_dir):
    merged = visits.merge_visits(*_sheets(spark, sf_dir))
    return _pick(diagnosis.flag_diagnoses(merged, exact=True), *i.VISIT_COLUMNS, *_FLAGS)


_EXTRACT = ("患者ID", "就诊类型", "就诊日期", "诊断", "诊断编码", "诊断科室", "数据来源",
            "诊断（ICD编码）", "诊断（文字）", "新冠患者", "RS患者", "诊断合并为肺炎")


@query("diagnosis_extract", f"""WITH {i.VISITS_SQL}, flagged AS (
  SELECT *, CASE WHEN {_ANY_RS} THEN '是' ELSE '否' END AS rs FROM visits)
SELECT patient AS "患者ID", source AS "就诊类型",
  CASE WHEN src_rank = 0 THEN {i.shown("ts")} ELSE '' END AS "就诊日期",
  words AS "诊断", code AS "诊断编码", CAST(NULL AS VARCHAR) AS "诊断科室", source AS "数据来源",
  code AS "诊断（ICD编码）", words AS "诊断（文字）",
  CASE WHEN contains(words, '新型冠状病毒感染') THEN '是' WHEN words IS NOT NULL THEN '否' END AS "新冠患者",
  rs AS "RS患者",
  CASE WHEN rs = '是' AND (contains(words, '肺部感染') OR contains(words, '肺炎'))
       THEN '是' ELSE '否' END AS "诊断合并为肺炎", row_key FROM flagged""")
def diagnosis_extract(spark, sf_dir):
    return _pick(diagnosis.diagnosis_extract(*_sheets(spark, sf_dir)), *_EXTRACT)


@query("diagnosis_extract_compat", f"""WITH {i.VISITS_SQL}
SELECT patient AS "患者ID", patient AS "就诊类型", '' AS "就诊日期", code AS "诊断",
  code AS "诊断编码", code AS "诊断科室", source AS "数据来源", code AS "诊断（ICD编码）",
  code AS "诊断（文字）", patient AS "新冠患者", patient AS "RS患者", code AS "诊断合并为肺炎",
  row_key FROM visits""")
def diagnosis_extract_compat(spark, sf_dir):
    renamed = [s.withColumnRenamed("患者编号", "患者ID") for s in _sheets(spark, sf_dir)]
    return _pick(diagnosis.diagnosis_extract(*renamed, compat=True), *_EXTRACT)


_CASES = ("患者ID", "就诊类型", "就诊日期", "诊断", "感染状态", "检测结果", "检测日期", "数据来源")


@query("infection_cases", f"""WITH {i.VISITS_SQL}, {i.EXAMINATIONS_SQL}
SELECT patient AS "患者ID", source AS "就诊类型",
  CASE WHEN src_rank = 0 THEN {i.shown("ts")} ELSE '' END AS "就诊日期", words AS "诊断",
  '确诊' AS "感染状态", CAST(NULL AS VARCHAR) AS "检测结果", CAST(NULL AS VARCHAR) AS "检测日期",
  source AS "数据来源", row_key
FROM visits WHERE {i.is_covid_sql("words", SQL_COVID_DIAGNOSIS)}
UNION ALL
SELECT patient, '检查', {i.shown("ts")}, NULL,
  CASE WHEN regexp_matches(coalesce(result, ''), '阴性|未检出|negative', 'i') THEN '排除'
       WHEN regexp_matches(coalesce(result, ''), '阳性|检出|positive', 'i') THEN '确诊'
       ELSE '未知' END,
  coalesce(result, ''), strftime(ts, '%Y-%m-%d %H:%M:%S'), '检查', row_key
FROM tests WHERE {i.is_covid_sql("name", SQL_COVID_TEST)}""")
def infection_cases(spark, sf_dir):
    cases = infections.infection_cases(*_sheets(spark, sf_dir), i.examinations(spark, sf_dir))
    return _pick(cases, *_CASES)


@query("infection_cases_compat", f"""WITH {i.VISITS_SQL}, {i.EXAMINATIONS_SQL}
SELECT patient AS "患者ID", patient AS "就诊类型", '' AS "就诊日期", words AS "诊断",
  '确诊' AS "感染状态", CAST(NULL AS VARCHAR) AS "检测结果", CAST(NULL AS VARCHAR) AS "检测日期",
  source AS "数据来源", row_key
FROM visits WHERE {i.is_covid_sql("words", SQL_COVID_DIAGNOSIS)}
UNION ALL
SELECT patient, patient, {i.shown("TRY_CAST(NULL AS TIMESTAMP)")}, NULL,
  CASE WHEN regexp_matches(coalesce(result, ''), '阳性|检出|positive', 'i') THEN '确诊'
       WHEN regexp_matches(coalesce(result, ''), '阴性|未检出|negative', 'i') THEN '排除'
       ELSE '未知' END,
  coalesce(result, ''), NULL, '检查', row_key
FROM tests WHERE {i.is_covid_sql("name", SQL_COVID_TEST)}""")
def infection_cases_compat(spark, sf_dir):
    # As written only ID headers count, and the first diagnosis column is the one used.
    sheets = [
        s.select(F.col("患者编号").alias("患者ID"), quoted("诊断（文字）"), *rest, ROW_IDX)
        for s, rest in zip(_sheets(spark, sf_dir), (["就诊日期"], ["入院日期"]))
    ]
    cases = infections.infection_cases(*sheets, i.examinations(spark, sf_dir), compat=True)
    return _pick(cases, *_CASES)


_DRUGS = {"ring": "奥司他韦胶囊", "gear": "Oseltamivir", "bolt": "oseltamivir", "rod": "抗病毒口服液",
          "plate": "阿莫西林", "widget": "利巴韦林颗粒"}
_DRUG_SQL = "CASE split_part(p_name, ' ', 2) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in _DRUGS.items()) + " END"


@query("antiviral_orders", f"""WITH o AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS patient, {_DRUG_SQL} AS drug, l_shipdate AS ts, l_quantity,
    l_returnflag, l_linestatus, l_orderkey, l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT patient AS "患者ID", drug AS "药物名称", '抗病毒药物' AS "药物类型",
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS "用药日期", CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "剂量",
  l_returnflag AS "频次", l_linestatus AS "用药途径", l_orderkey AS row_key
FROM o WHERE {i.is_covid_sql("drug", SQL_ANTIVIRAL)}""")
def antiviral_orders(spark, sf_dir):
    lines, part = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    named = part.select("p_partkey", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word"))
    sheet = lines.join(named, lines.l_partkey == named.p_partkey).select(
        F.col("l_suppkey").cast("string").alias("患者ID"), i.case("word", _DRUGS).alias("药品名称"),
        F.col("l_shipdate").alias("医嘱日期"), F.col("l_quantity").alias("单次用量"),
        F.col("l_returnflag").alias("给药频次"), F.col("l_linestatus").alias("给药途径"),
        F.col("l_orderkey").alias(ROW_IDX),
    )
    return _pick(orders.antiviral_orders(sheet), "患者ID", "药物名称", "药物类型", "用药日期", "剂量",
                 "频次", "用药途径")


def _labs_sql(kind: str) -> str:
    return f"""WITH {i.EXAMINATIONS_SQL}
SELECT patient AS "患者ID", name AS "检查名称",
  coalesce(method, CASE WHEN regexp_matches(name, '核酸|PCR|RT-PCR', 'i') THEN '核酸检测'
    WHEN regexp_matches(name, '抗原', 'i') THEN '抗原检测'
    WHEN regexp_matches(name, '抗体|IgM|IgG', 'i') THEN '抗体检测' ELSE '' END) AS "检查方法",
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS "检查日期", coalesce(result, '') AS "检查结果",
  {kind} AS "结果类型", dept AS "检查部门", row_key
FROM tests WHERE {i.is_covid_sql("name", SQL_COVID_TEST)}"""


_LABS = ("患者ID", "检查名称", "检查方法", "检查日期", "检查结果", "结果类型", "检查部门")


@query("lab_tests", _labs_sql("""
  CASE WHEN regexp_matches(coalesce(result, ''), '阴性|未检出|negative', 'i') THEN '阴性'
       WHEN regexp_matches(coalesce(result, ''), '阳性|检出|positive', 'i') THEN '阳性'
       ELSE '未知' END"""))
def lab_tests(spark, sf_dir):
    return _pick(orders.lab_tests(i.examinations(spark, sf_dir)), *_LABS)


@query("lab_tests_compat", _labs_sql("coalesce(result, '')"))
def lab_tests_compat(spark, sf_dir):
    return _pick(orders.lab_tests(i.examinations(spark, sf_dir), compat=True), *_LABS)


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with an age (twice the size, some as unreadable text), customers without one."""
    part, customer = read(spark, sf_dir, "part"), read(spark, sf_dir, "customer")
    known = part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("患者ID"),
        F.when(F.col("p_type") == "PROMO", F.concat(F.col("p_size").cast("string"), F.lit("岁")))
        .when(F.col("p_type") == "SMALL", (F.col("p_size") / 2).cast("string"))
        .otherwise((F.col("p_size") * 2).cast("string")).alias("年龄"),
        F.when(F.col("p_brand") < "Brand#2", "男").otherwise("女").alias("性别"),
        F.col("p_partkey").alias(ROW_IDX),
    )
    unknown = customer.select(
        F.nullif(F.col("c_name"), F.lit("Customer#000000007")).alias("患者ID"),
        i.case("c_mktsegment", {"MACHINERY": "男", "BUILDING": "女"}).alias("性别"),
        F.col("c_mktsegment").alias("家庭住址"),
        F.col("c_custkey").alias(ROW_IDX),
    )
    return patients.all_patients(known, unknown)


_PEOPLE_SQL = """people AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS id,
    CASE p_type WHEN 'PROMO' THEN CAST(p_size AS VARCHAR) || '岁'
      WHEN 'SMALL' THEN CAST(CAST(p_size AS DOUBLE) / 2 AS VARCHAR)
      ELSE CAST(p_size * 2 AS VARCHAR) END AS age,
    CASE WHEN p_brand < 'Brand#2' THEN '男' ELSE '女' END AS gender,
    CAST(NULL AS VARCHAR) AS region, p_partkey AS row_key FROM part
  UNION ALL
  SELECT nullif(c_name, 'Customer#000000007'), NULL,
    CASE c_mktsegment WHEN 'MACHINERY' THEN '男' WHEN 'BUILDING' THEN '女' END, c_mktsegment, c_custkey
  FROM customer),
aged AS (SELECT *, TRY_CAST(age AS DOUBLE) AS years FROM people)"""
_BAND_SQL = """CASE WHEN years IS NULL THEN '未知' WHEN years < 3 THEN '婴幼儿(0-2岁)'
    WHEN years < 6 THEN '学龄前(3-5岁)' WHEN years < 12 THEN '儿童(6-11岁)'
    WHEN years < 18 THEN '青少年(12-17岁)' WHEN years < 35 THEN '青年(18-34岁)'
    WHEN years < 60 THEN '中年(35-59岁)' WHEN years < 80 THEN '老年(60-79岁)'
    ELSE '高龄老人(80岁以上)' END"""


def _population_sql(band: str) -> str:
    return f"""WITH {_PEOPLE_SQL}
SELECT coalesce(id, '') AS "患者ID", age AS "年龄", coalesce(gender, '') AS "性别",
  coalesce(region, '') AS "地区", {band} AS "年龄段",
  CASE WHEN years >= 65 THEN '老年人' WHEN years >= 18 THEN '成年人'
       WHEN years IS NOT NULL THEN '儿童青少年' WHEN gender = '男' THEN '男性'
       WHEN gender = '女' THEN '女性' ELSE '未分类' END AS "人群类别", row_key FROM aged"""


_POPULATION = ("患者ID", "年龄", "性别", "地区", "年龄段", "人群类别")


@query("population_split", _population_sql(_BAND_SQL))
def population_split(spark, sf_dir):
    return _pick(patients.population_split(_people(spark, sf_dir)), *_POPULATION)


@query("population_split_compat", _population_sql("age"))
def population_split_compat(spark, sf_dir):
    return _pick(patients.population_split(_people(spark, sf_dir), compat=True), *_POPULATION)


@query("population_labels", f"""WITH {_PEOPLE_SQL}
SELECT id AS "患者ID", row_key, concat_ws(',', CASE WHEN years >= 65 THEN '老年人' END,
  CASE WHEN years >= 18 AND years < 65 THEN '成年人' END, CASE WHEN years < 18 THEN '儿童' END,
  CASE WHEN gender = '男' THEN '男性' END, CASE WHEN gender = '女' THEN '女性' END) AS labels FROM aged""")
def population_labels(spark, sf_dir):
    labelled = patients.population_labels(_people(spark, sf_dir), "年龄", "性别")
    return labelled.select(
        "患者ID", F.col(ROW_IDX).alias("row_key"), F.array_join("人群标签", ",").alias("labels")
    )


def _patient_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = i.outpatients(spark, sf_dir).select(
        F.col("患者编号").alias("患者ID"), F.col("性别"), F.col("就诊科室").alias("联系电话"),
        F.col("就诊日期"), F.col("年龄（周岁）").cast("string").alias("年龄"), ROW_IDX)
    stay = i.inpatients(spark, sf_dir).select(
        F.col("患者编号").alias("患者ID"), "入院日期", F.col("就诊科室").alias("住址"), ROW_IDX)
    return patients.all_patients(out, stay)


_PATIENTS_SQL = f"""rows_ AS (
  SELECT patient, gender, dept AS contact, ts, CAST(NULL AS TIMESTAMP) AS admitted, age,
    CAST(NULL AS VARCHAR) AS address, src_rank, row_key FROM ({i.OUTPATIENTS_SQL})
  UNION ALL
  SELECT patient, NULL, NULL, NULL, ts, NULL, dept, src_rank, row_key FROM ({i.INPATIENTS_SQL})),
known AS (SELECT *, coalesce(ts, admitted) AS seen FROM rows_ WHERE patient IS NOT NULL)"""


def _unique_sql(order: str, stats: str) -> str:
    return f"""WITH {_PATIENTS_SQL}
SELECT patient AS "患者ID", age AS "年龄", coalesce(gender, '') AS "性别",
  coalesce(contact, '') AS "联系方式", coalesce(address, '') AS "家庭住址", {stats}
FROM (SELECT *, min(seen) OVER w AS first_seen, max(seen) OVER w AS last_seen, count(*) OVER w AS visits
      FROM known WINDOW w AS (PARTITION BY patient)
      QUALIFY row_number() OVER (PARTITION BY patient
                                 ORDER BY {order} DESC NULLS LAST, src_rank, row_key) = 1)"""


_UNIQUE = ("患者ID", "年龄", "性别", "联系方式", "家庭住址", "首次就诊日期", "最近就诊日期", "就诊次数")


@query("unique_patients", _unique_sql("seen", f"""{i.shown("first_seen")} AS "首次就诊日期",
  {i.shown("last_seen")} AS "最近就诊日期", visits AS "就诊次数" """))
def unique_patients(spark, sf_dir):
    return patients.unique_patients(_patient_sheets(spark, sf_dir)).select(*_UNIQUE)


@query("unique_patients_compat", _unique_sql("ts", """'' AS "首次就诊日期", '' AS "最近就诊日期",
  CAST(NULL AS BIGINT) AS "就诊次数" """))
def unique_patients_compat(spark, sf_dir):
    return patients.unique_patients(_patient_sheets(spark, sf_dir), compat=True).select(*_UNIQUE)


@query("patient_ids", f"""WITH {_PATIENTS_SQL} SELECT DISTINCT patient AS "患者ID" FROM known""")
def patient_ids(spark, sf_dir):
    return patients.patient_ids(_patient_sheets(spark, sf_dir))


@query("rendered_visit_days", f"""WITH {i.VISITS_SQL}
SELECT {i.shown("ts")} AS shown, count(*) AS n FROM visits GROUP BY 1""")
def rendered_visit_days(spark, sf_dir):
    all_ = visits.all_visits(*_sheets(spark, sf_dir))
    return all_.groupBy(render_timestamp(F.col(visits.VISIT_TS)).alias("shown")).agg(
        F.count("*").alias("n"))
