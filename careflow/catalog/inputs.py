"""The test tables dressed as clinical sheets, in Spark and (with the same rules) in SQL.

Events become outpatient visits and orders inpatient stays; the tables have no nulls, so
some values are blanked by rules on other columns.  Order dates are moved into January
2024, keeping the day of the month, so that stays and visits share days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.catalog.registry import read
from careflow.schemas import ROW_IDX


def case(column: str, mapping: dict[str, str]) -> Column:
    result = F
    for value, label in mapping.items():
        result = result.when(F.col(column) == value, F.lit(label))
    return result.otherwise(F.lit(None).cast("string"))


def case_sql(column: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{value}' THEN '{label}'" for value, label in mapping.items())
    return f"CASE {column} {whens} END"


HOSPITAL = {"signup": "031"}
DEPARTMENT = {"error": "发热门诊", "purchase": "急诊科", "click": "ICU病房", "view": "内科"}
EVENT_CODE = {"error": "J18.900", "purchase": "J98.414", "click": "J05.0", "view": "R50"}
WARD = {"1-URGENT": "综合ICU", "2-HIGH": "急诊科", "3-MEDIUM": "内科", "5-LOW": "发热门诊"}
ORDER_CODE = {"1-URGENT": "J18", "2-HIGH": "XJ00", "3-MEDIUM": "J98.414", "5-LOW": "J98.4"}
ORDER_TEXT = {"F": "新型冠状病毒感染，肺炎", "O": "肺部感染"}


def outpatients(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return read(spark, sf_dir, "events").select(
        F.when(value >= 5, F.col("user_id").cast("string")).alias("患者编号"),
        case("event_type", HOSPITAL).alias("医院编码"),
        case("event_type", DEPARTMENT).alias("就诊科室"),
        F.col("ts").alias("就诊日期"),
        case("event_type", EVENT_CODE).alias("诊断（ICD编码）"),
        F.when(value < 20, "新型冠状病毒感染").when(value < 40, "SARS-CoV-2 肺炎")
        .when(value < 80, "肺部感染").alias("诊断（文字）"),
        F.col("user_id").alias("年龄（周岁）"),
        F.when(value < 50, "男").otherwise("女").alias("性别"),
        F.col("event_id").alias(ROW_IDX),
    )


OUTPATIENTS_SQL = f"""
  SELECT CASE WHEN value >= 5 THEN CAST(user_id AS VARCHAR) END AS patient,
    {case_sql("event_type", HOSPITAL)} AS hospital,
    {case_sql("event_type", DEPARTMENT)} AS dept,
    ts, CAST(NULL AS TIMESTAMP) AS ended,
    CAST(NULL AS TIMESTAMP) AS admitted, CAST(NULL AS TIMESTAMP) AS discharged,
    {case_sql("event_type", EVENT_CODE)} AS code,
    CASE WHEN value < 20 THEN '新型冠状病毒感染' WHEN value < 40 THEN 'SARS-CoV-2 肺炎'
         WHEN value < 80 THEN '肺部感染' END AS words,
    CAST(user_id AS VARCHAR) AS age, CASE WHEN value < 50 THEN '男' ELSE '女' END AS gender,
    '门急诊' AS source, 0 AS src_rank, event_id AS row_key FROM events"""


def moved_date(column: str) -> Column:
    """The same day of the month in January 2024."""
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.dayofmonth(column) - 1)


MOVED_DATE_SQL = "TIMESTAMP '2024-01-01' + to_days(CAST(day(o_orderdate) AS INTEGER) - 1)"


def inpatients(spark: SparkSession, sf_dir: str) -> DataFrame:
    admitted = moved_date("o_orderdate")
    left = F.make_dt_interval(F.lit(4), F.lit(9), F.lit(30))
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("患者编号"),
        case("o_orderpriority", WARD).alias("就诊科室"),
        admitted.alias("入院日期"),
        F.when(F.col("o_orderstatus") != "P", admitted + left).alias("出院日期"),
        case("o_orderpriority", ORDER_CODE).alias("诊断（ICD编码）"),
        case("o_orderstatus", ORDER_TEXT).alias("诊断（文字）"),
        F.col("o_orderkey").alias(ROW_IDX),
    )


INPATIENTS_SQL = f"""
  SELECT CAST(o_custkey AS VARCHAR) AS patient, CAST(NULL AS VARCHAR) AS hospital,
    {case_sql("o_orderpriority", WARD)} AS dept,
    {MOVED_DATE_SQL} AS ts,
    CASE WHEN o_orderstatus <> 'P'
         THEN {MOVED_DATE_SQL} + INTERVAL '4 days 9 hours 30 minutes' END AS ended,
    {MOVED_DATE_SQL} AS admitted,
    CASE WHEN o_orderstatus <> 'P'
         THEN {MOVED_DATE_SQL} + INTERVAL '4 days 9 hours 30 minutes' END AS discharged,
    {case_sql("o_orderpriority", ORDER_CODE)} AS code,
    {case_sql("o_orderstatus", ORDER_TEXT)} AS words,
    CAST(NULL AS VARCHAR) AS age, CAST(NULL AS VARCHAR) AS gender,
    '住院' AS source, 1 AS src_rank, o_orderkey AS row_key FROM orders"""


def shown(ts: str) -> str:
    """SQL for a rendered time."""
    return (
        f"CASE WHEN {ts} IS NULL THEN '' WHEN {ts} = date_trunc('day', {ts}) "
        f"THEN strftime({ts}, '%Y-%m-%d') ELSE strftime({ts}, '%Y-%m-%d %H:%M:%S') END"
    )


# All visits with patient code, visit type and day.
VISITS_SQL = f"""visits AS (
  SELECT *, coalesce(hospital, '030') AS hospital_code,
    coalesce(hospital, '030') || '-' || patient AS patient_code,
    CASE WHEN contains(coalesce(dept, ''), 'ICU') THEN 'ICU(I)'
         WHEN contains(coalesce(dept, ''), '发热') THEN '发热(F)'
         WHEN contains(coalesce(dept, ''), '急诊') THEN '急诊(E)'
         WHEN source = '门急诊' THEN '门诊(O)' WHEN source = '住院' THEN '住院(H)' END AS visit_type,
    CAST(ts AS DATE) AS visit_day
  FROM ({OUTPATIENTS_SQL} UNION ALL {INPATIENTS_SQL}))"""

LATEST_SQL = f"""{VISITS_SQL}, latest AS (
  SELECT * FROM visits QUALIFY row_number() OVER (
    PARTITION BY patient_code, visit_day ORDER BY ts DESC NULLS LAST, src_rank, row_key) = 1)"""

VISIT_COLUMNS_SQL = f"""
  hospital_code AS "医院编码", patient AS "患者编号", patient_code AS "患者唯一编码",
  source AS "来源", age AS "年龄（周岁）", gender AS "性别", dept AS "就诊科室",
  visit_type AS "就诊类别", {shown("ts")} AS "就诊日期", {shown("ended")} AS "就诊结束日期",
  code AS "诊断（ICD编码）", words AS "诊断（文字）" """
VISIT_COLUMNS = (
    "医院编码", "患者编号", "患者唯一编码", "来源", "年龄（周岁）", "性别", "就诊科室", "就诊类别",
    "就诊日期", "就诊结束日期", "诊断（ICD编码）", "诊断（文字）",
)
STAY_COLUMNS = ("入院日期", "出院日期")
STAY_COLUMNS_SQL = f""", {shown("admitted")} AS "入院日期", {shown("discharged")} AS "出院日期" """

TEST_NAMES = {
    "1-URGENT": "新冠核酸检测", "2-HIGH": "新冠抗原", "3-MEDIUM": "新冠抗体IgM",
    "4-NOT SPECIFIED": "血常规", "5-LOW": "COVID pcr",
}
TEST_METHODS = {"1-URGENT": "快速法", "4-NOT SPECIFIED": "镜检"}


def examinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as laboratory tests; status and price settle the result."""
    price = F.col("o_totalprice")
    result = (
        F.when((F.col("o_orderstatus") == "F") & (price < 250000), "阳性")
        .when(F.col("o_orderstatus") == "F", "检出")
        .when((F.col("o_orderstatus") == "O") & (price < 250000), "未检出")
        .when(F.col("o_orderstatus") == "O", "Negative")
        .when(price < 250000, "待复核")
    )
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("患者ID"),
        case("o_orderpriority", TEST_NAMES).alias("检查名称"),
        result.alias("检查结果"),
        F.col("o_orderdate").alias("检查日期"),
        case("o_orderpriority", TEST_METHODS).alias("检查方法"),
        F.col("o_orderstatus").alias("检查科室"),
        F.col("o_orderkey").alias(ROW_IDX),
    )


EXAMINATIONS_SQL = f"""tests AS (
  SELECT CAST(o_custkey AS VARCHAR) AS patient, {case_sql("o_orderpriority", TEST_NAMES)} AS name,
    CASE WHEN o_orderstatus = 'F' AND o_totalprice < 250000 THEN '阳性'
         WHEN o_orderstatus = 'F' THEN '检出'
         WHEN o_orderstatus = 'O' AND o_totalprice < 250000 THEN '未检出'
         WHEN o_orderstatus = 'O' THEN 'Negative'
         WHEN o_totalprice < 250000 THEN '待复核' END AS result,
    o_orderdate AS ts, {case_sql("o_orderpriority", TEST_METHODS)} AS method,
    o_orderstatus AS dept, o_orderkey AS row_key FROM orders)"""


def is_covid_sql(column: str, keywords: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{k}')" for k in keywords) + ")"
