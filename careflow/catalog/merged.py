"""Merging one table of several files: patients, tests, rows without numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.catalog.registry import query, read
from careflow.plans import merge
from careflow.schemas import LIS05, LISA1, ROW_IDX, SOURCE_FILE

RUN_TS = "2024-02-01 00:00:00"


def _file():
    return F.concat(F.lit("/in/"), F.col("o_orderstatus"), F.lit(".xlsx")).alias(SOURCE_FILE)


def _patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as patients of three files (one per order status), orders as their visits; one
    customer is unknown.  A file's last visit is written with slashes."""
    orders = read(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"),
        F.count("*").alias("visits"), F.max("o_orderkey").alias("row"),
    ).select(
        F.nullif(F.col("o_custkey").cast("string"), F.lit("7")).alias("患者ID"),
        F.concat(F.lit("of "), F.col("o_orderstatus")).alias("姓名"),
        F.date_format("first", "yyyy-MM-dd").alias("首次就诊日期"),
        F.date_format("last", "yyyy/MM/dd").alias("最近就诊日期"),
        F.col("visits").alias("就诊次数"), _file(), F.col("row").alias(ROW_IDX))


_PATIENTS_SQL = """p AS (SELECT nullif(CAST(o_custkey AS VARCHAR), '7') AS patient, o_orderstatus AS status,
  min(o_orderdate) AS first, max(o_orderdate) AS last, count(*) AS visits, max(o_orderkey) AS row_key
  FROM orders GROUP BY o_custkey, o_orderstatus)"""
_PATIENT_COLUMNS = f"""'of ' || status AS "姓名", visits AS "就诊次数", status || '.xlsx' AS "数据来源",
  '{RUN_TS}' AS "数据更新时间\""""


@query("merge_unique_patients", f"""WITH {_PATIENTS_SQL}, known AS (
  SELECT patient, arg_min(status, (-epoch(last), status, row_key)) AS status, min(first) AS first,
    max(last) AS last, CAST(sum(visits) AS BIGINT) AS visits FROM p WHERE patient IS NOT NULL GROUP BY patient)
SELECT patient AS "患者ID", strftime(first, '%Y-%m-%d') AS "首次就诊日期",
  strftime(last, '%Y-%m-%d') AS "最近就诊日期", {_PATIENT_COLUMNS} FROM known
UNION ALL SELECT patient, strftime(first, '%Y-%m-%d'), strftime(last, '%Y/%m/%d'), {_PATIENT_COLUMNS}
FROM p WHERE patient IS NULL""")
def merge_unique_patients(spark, sf_dir):
    """Patients of several files: first and last visit and number of visits over all."""
    return merge.merged_rows(LISA1, _patients(spark, sf_dir), RUN_TS)


@query("merge_unique_patients_compat", f"""WITH {_PATIENTS_SQL}
SELECT patient AS "患者ID", strftime(first, '%Y-%m-%d') AS "首次就诊日期",
  strftime(last, '%Y/%m/%d') AS "最近就诊日期", {_PATIENT_COLUMNS} FROM p
QUALIFY row_number() OVER (PARTITION BY patient ORDER BY status, row_key) = 1""")
def merge_unique_patients_compat(spark, sf_dir):
    return merge.merged_rows(LISA1, _patients(spark, sf_dir), RUN_TS, compat=True)


def _tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as tests: several of a patient and a day, at different hours."""
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.nullif(F.col("o_custkey").cast("string"), F.lit("7")).alias("患者ID"),
        F.col("l_linestatus").alias("检查名称"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 0"),
                 F.col("l_linenumber").cast("string"), F.lit(":00:00")).alias("检查日期"),
        F.when(F.col("l_returnflag") == "R", "阳性").otherwise("未检出").alias("检查结果"), _file(),
        (((F.col("l_orderkey").cast("bigint") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")) * 100000
         + F.col("l_suppkey")).cast("bigint").alias(ROW_IDX))


_TESTS_SQL = f"""t AS (SELECT nullif(CAST(o_custkey AS VARCHAR), '7') AS patient, l_linestatus AS test,
  strftime(o_orderdate, '%Y-%m-%d') || ' 0' || CAST(l_linenumber AS VARCHAR) || ':00:00' AS tested,
  CASE WHEN l_returnflag = 'R' THEN '阳性' ELSE '未检出' END AS result, o_orderstatus || '.xlsx' AS file,
  ((CAST(l_orderkey AS BIGINT) * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey AS row_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT patient AS "患者ID", test AS "检查名称", tested AS "检查日期", result AS "检查结果", file AS "数据来源",
  '{RUN_TS}' AS "数据更新时间" FROM t"""


@query("merge_lab_tests", f"""WITH {_TESTS_SQL} WHERE patient IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY patient, test, tested ORDER BY file, row_key) = 1
UNION ALL SELECT patient, test, tested, result, file, '{RUN_TS}' FROM t WHERE patient IS NULL""")
def merge_lab_tests(spark, sf_dir):
    """Tests of one day at different hours are different tests."""
    return merge.merged_rows(LIS05, _tests(spark, sf_dir), RUN_TS)


@query("merge_lab_tests_compat", f"""WITH {_TESTS_SQL}
QUALIFY row_number() OVER (PARTITION BY patient ORDER BY file, row_key) = 1""")
def merge_lab_tests_compat(spark, sf_dir):
    return merge.merged_rows(LIS05, _tests(spark, sf_dir), RUN_TS, compat=True)


@query("merge_keep_first_unnumbered", f"""SELECT o_orderpriority AS "患者ID", o_orderkey AS v,
  o_orderstatus || '.xlsx' AS "数据来源", '{RUN_TS}' AS "数据更新时间" FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderstatus, o_orderkey) = 1""")
def merge_keep_first_unnumbered(spark, sf_dir):
    """Without row numbers the content of rows settles which is first."""
    rows = read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("患者ID"), F.col("o_orderkey").alias("v"), _file())
    return merge.merge_table(rows.repartition(7, "v"), RUN_TS, ["患者ID"])
