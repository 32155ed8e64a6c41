"""Batch and merge reports, required inputs and skip reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.catalog.registry import query, read
from careflow.functions import status
from careflow.plans import reports
from careflow.schemas import TABLES
from careflow.sources.tables import missing_inputs, skip_reasons

_PATH = "/in/测试原始数据"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as workbooks; each priority they ordered with is a table of theirs, good
    when no order of it is pending; a customer in debt has an unreadable workbook."""
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    tables = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.max("o_orderstatus").alias("worst"))
    return tables.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit(_PATH), F.col("o_custkey").cast("string"), F.lit(".xlsx")).alias("source_file"),
        F.concat(F.lit("sheet"), F.left("o_orderpriority", F.lit(1))).alias("sheet"),
        (F.col("worst") != "P").alias("ok"),
        F.when(F.col("c_acctbal") < -500, "unreadable").alias("error"),
    )


_OUTCOMES_SQL = f"""outcomes AS (
  SELECT '{_PATH}' || CAST(o_custkey AS VARCHAR) || '.xlsx' AS source_file, o_custkey,
    'sheet' || left(o_orderpriority, 1) AS sheet, max(o_orderstatus) <> 'P' AS ok,
    max(CASE WHEN c_acctbal < -500 THEN 'unreadable' END) AS error
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey, o_orderpriority),
results AS (
  SELECT source_file, o_custkey, count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_bad, max(error) AS error,
    coalesce(string_agg(CASE WHEN ok THEN sheet END, ', ' ORDER BY sheet), '') AS ok_sheets,
    coalesce(string_agg(CASE WHEN NOT ok THEN sheet END, ', ' ORDER BY sheet), '') AS bad_sheets
  FROM outcomes GROUP BY 1, 2),
judged AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'error' WHEN n_bad = 0 THEN 'success'
  WHEN n_ok > 0 THEN 'partial' ELSE 'failed' END AS state FROM results),
totals AS (SELECT count(*) AS total, count(*) FILTER (state = 'success') AS good,
  count(*) FILTER (state = 'partial') AS partial, count(*) FILTER (state IN ('failed', 'error')) AS bad FROM judged)"""


@query("batch_report", f"""WITH {_OUTCOMES_SQL}
SELECT '总文件数' AS "指标", CAST(total AS VARCHAR) AS "数值" FROM totals
UNION ALL SELECT '处理文件数', CAST(total AS VARCHAR) FROM totals
UNION ALL SELECT '成功文件数', CAST(good AS VARCHAR) FROM totals
UNION ALL SELECT '部分成功文件数', CAST(partial AS VARCHAR) FROM totals
UNION ALL SELECT '失败文件数', CAST(bad AS VARCHAR) FROM totals
UNION ALL SELECT '成功率', CASE WHEN total > 0 THEN printf('%.2f%%', CAST(good AS DOUBLE) / total * 100) ELSE '0.00%' END FROM totals""")
def batch_report(spark, sf_dir):
    return reports.batch_summary(reports.file_results(_outcomes(spark, sf_dir)))


@query("batch_details", f"""WITH {_OUTCOMES_SQL}
SELECT CASE WHEN state = 'error' THEN '测试原始数据' ELSE '原始数据' END || CAST(o_custkey AS VARCHAR) AS "文件名",
  source_file AS "源文件路径",
  CASE WHEN state = 'error' THEN '' ELSE '/out/原始数据' || CAST(o_custkey AS VARCHAR) || '_processed' END AS "目标文件路径",
  state AS "状态", CASE WHEN state = 'error' THEN '' ELSE ok_sheets END AS "成功处理的sheet",
  CASE WHEN state = 'error' THEN '' ELSE bad_sheets END AS "失败处理的sheet",
  coalesce(error, '') AS "错误信息" FROM judged""")
def batch_details(spark, sf_dir):
    return reports.batch_details(reports.file_results(_outcomes(spark, sf_dir)), "/out")


_SHEETS = {"1-URGENT": TABLES[0], "2-HIGH": TABLES[1], "3-MEDIUM": TABLES[2], "5-LOW": TABLES[6]}


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table and file: orders by priority and status; one priority is an error."""
    sheet = F.col("o_orderpriority")
    named = F
    for priority, table in _SHEETS.items():
        named = named.when(sheet == priority, F.lit(table))
    return read(spark, sf_dir, "orders").groupBy(
        named.otherwise(F.lit(TABLES[3])).alias("sheet"), "o_orderstatus"
    ).agg(F.count("*").alias("rows")).withColumn(
        "error", F.when(F.col("sheet") == TABLES[3], "unreadable"))


_COUNTS_SQL = "counts AS (SELECT CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN '{t}'" for p, t in _SHEETS.items()
) + f" ELSE '{TABLES[3]}' END AS sheet, count(*) AS n FROM orders GROUP BY 1)," + """
expected AS (SELECT * FROM (VALUES """ + ", ".join(
    f"({n}, '{t}')" for n, t in enumerate(TABLES, 1)
) + f""") AS v(ordinal, sheet)),
details AS (SELECT ordinal, e.sheet, CASE WHEN e.sheet = '{TABLES[3]}' THEN 'error'
    WHEN n IS NOT NULL THEN 'success' ELSE 'empty' END AS state,
  CASE WHEN e.sheet = '{TABLES[3]}' THEN 0 ELSE coalesce(n, 0) END AS n,
  CASE WHEN e.sheet = '{TABLES[3]}' THEN 'unreadable' ELSE '' END AS error
  FROM expected e LEFT JOIN counts c ON e.sheet = c.sheet)"""


def _merge_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = spark.createDataFrame(list(enumerate(TABLES, 1)), "ordinal int, sheet string")
    return reports.merge_details(_row_counts(spark, sf_dir), expected)


@query("merge_details", f"""WITH {_COUNTS_SQL}
SELECT ordinal, sheet AS "sheet名称", state AS "状态", CAST(n AS BIGINT) AS "行数", error AS "错误信息" FROM details""")
def merge_details(spark, sf_dir):
    return _merge_details(spark, sf_dir)


@query("merge_report", f"""WITH {_COUNTS_SQL},
totals AS (SELECT count(*) FILTER (state = 'success') AS good, count(*) FILTER (state <> 'success') AS bad FROM details)
SELECT '合并状态' AS "指标", CASE WHEN bad > 0 AND good > 0 THEN 'partial' WHEN bad > 0 THEN 'error' ELSE 'success' END AS "数值" FROM totals
UNION ALL SELECT '合并信息', CASE WHEN bad > 0 AND good > 0 THEN printf('部分sheet合并成功，%d个成功，%d个失败', good, bad)
  WHEN bad > 0 THEN '所有sheet合并失败' ELSE printf('所有sheet合并成功，共%d个sheet', good) END FROM totals
UNION ALL SELECT '输入文件数', CAST((SELECT count(DISTINCT o_custkey) FROM orders) AS VARCHAR)
UNION ALL SELECT '成功处理的sheet数', CAST(good AS VARCHAR) FROM totals
UNION ALL SELECT '失败处理的sheet数', CAST(bad AS VARCHAR) FROM totals
UNION ALL SELECT '输出文件路径', '/out/merged'""")
def merge_report(spark, sf_dir):
    files = read(spark, sf_dir, "orders").agg(F.countDistinct("o_custkey")).scalar()
    return reports.merge_summary(_merge_details(spark, sf_dir), files, "/out/merged")


@query("merge_input_files", f"""SELECT row_number() OVER (ORDER BY path) AS "序号",
  split_part(path, '/', 3) AS "文件名", path AS "文件路径"
FROM (SELECT '{_PATH}' || CAST(c_custkey AS VARCHAR) || '.xlsx' AS path FROM customer)""")
def merge_input_files(spark, sf_dir):
    paths = read(spark, sf_dir, "customer").select(
        F.concat(F.lit(_PATH), F.col("c_custkey").cast("string"), F.lit(".xlsx")).alias("path"))
    return reports.input_files(paths)


@query("output_names", f"""SELECT '{_PATH}' || CAST(c_custkey AS VARCHAR) || '.xlsx' AS path,
  '原始数据' || CAST(c_custkey AS VARCHAR) || '_processed' AS whole,
  '原始数据' || CAST(c_custkey AS VARCHAR) || '合并phase1sheet3' AS one FROM customer""")
def output_names(spark, sf_dir):
    path = F.concat(F.lit(_PATH), F.col("c_custkey").cast("string"), F.lit(".xlsx"))
    return read(spark, sf_dir, "customer").select(
        path.alias("path"), status.output_name(path).alias("whole"),
        status.output_name(path, 3).alias("one"))


@query("missing_inputs", """SELECT file, sheet FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS file, sheet FROM customer,
    (SELECT DISTINCT o_orderpriority AS sheet FROM orders)
  EXCEPT SELECT CAST(o_custkey AS VARCHAR), o_orderpriority FROM orders)""")
def missing_sheets(spark, sf_dir):
    """Customers as files, priorities as required sheets: which did a customer never use?"""
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    present = orders.select(
        F.col("o_custkey").cast("string").alias("file"), F.col("o_orderpriority").alias("sheet"))
    files = customer.select(F.col("c_custkey").cast("string").alias("file"))
    return missing_inputs(present, files, present.select("sheet").distinct())


@query("skip_reasons", """WITH t AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n FROM orders GROUP BY 1),
r AS (SELECT CAST(c_custkey AS VARCHAR) AS file, CASE WHEN c_acctbal < 0 THEN 'missing file'
    WHEN c_mktsegment = 'MACHINERY' THEN 'unreadable' WHEN o_custkey IS NULL THEN 'missing sheet'
    WHEN n = 0 THEN 'empty' END AS reason FROM customer LEFT JOIN t ON c_custkey = o_custkey)
SELECT file, reason FROM r WHERE reason IS NOT NULL""")
def skipped_files(spark, sf_dir):
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    file = F.col("o_custkey").cast("string").alias("file")
    files = customer.select(
        F.col("c_custkey").cast("string").alias("file"), (F.col("c_acctbal") >= 0).alias("exists"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "corrupt").alias("error"))
    rows = orders.filter(F.col("o_orderstatus") == "F").groupBy(file).agg(F.count("*").alias("rows"))
    return skip_reasons(files, orders.select(file).distinct(), rows)
