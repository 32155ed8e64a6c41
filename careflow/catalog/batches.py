"""Batches over given tables as files: a table that fails, and a merge after a partial rerun."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.catalog import inputs
from careflow.catalog.registry import query, read
from careflow.operators import projection
from careflow.plans import batch, orders
from careflow.schemas import DRUG_ORDERS, EXAMINATIONS, SOURCE_FILE
from careflow.sources import scratch

RUN_TS = "2024-02-01 00:00:00"


def _file(status: str):
    return F.concat(F.lit("/in/"), F.col(status), F.lit(".xlsx")).alias(SOURCE_FILE)


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Orders as three files, one per status: tests, and drug orders that cannot be read."""
    tests = inputs.examinations(spark, sf_dir).withColumn(SOURCE_FILE, _file("检查科室"))
    drugs = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("患者ID"),
        F.when(F.col("o_orderkey") > 0, F.raise_error(F.lit("unreadable orders"))).cast("string").alias("药物名称"),
        _file("o_orderstatus"))
    files = tests.select(SOURCE_FILE).distinct().select(
        SOURCE_FILE, F.array().cast("array<string>").alias(projection.MISSING), F.lit(None).cast("string").alias("error"))
    return {EXAMINATIONS: tests, DRUG_ORDERS: drugs}, files


@query("batch_run", """SELECT o_orderstatus AS "文件名", 'partial' AS "状态", 'sheet5' AS "成功处理的sheet",
  'sheet4' AS "失败处理的sheet", true AS told FROM orders GROUP BY o_orderstatus""")
def batch_run(spark, sf_dir):
    """The drug table fails; the tests are built and both are reported."""
    sheets, files = _inputs(spark, sf_dir)
    folder = scratch.new_folder(spark)
    report = batch.process_sheets(sheets, files, folder, numbers=[4, 5])
    told = F.col("错误信息").startswith("sheet4: ") & F.col("错误信息").contains("unreadable orders")
    return scratch.without_folder(report["详细结果"].select(
        "文件名", "状态", "成功处理的sheet", "失败处理的sheet", told.alias("told")), folder)


@query("merge_after_partial_rerun", """WITH f AS (
  SELECT DISTINCT o_orderstatus || '.xlsx' AS name, '/in/' || o_orderstatus || '.xlsx' AS path FROM orders)
SELECT row_number() OVER (ORDER BY path) AS "序号", name AS "文件名", path AS "文件路径" FROM f""")
def merge_after_partial_rerun(spark, sf_dir):
    """All files are processed, then one again; the merge is of all of them and says so."""
    sheets, files = _inputs(spark, sf_dir)
    folder = scratch.new_folder(spark)
    batch.process_sheets(sheets, files, f"{folder}/processed", numbers=[5], run="first")
    one = F.col(SOURCE_FILE) == "/in/O.xlsx"
    batch.process_sheets(
        {n: df.filter(one) for n, df in sheets.items()}, files.filter(one), f"{folder}/processed", numbers=[5], run="second")
    report = batch.merge_processed(spark, f"{folder}/processed", f"{folder}/merged", RUN_TS)
    return scratch.without_folder(report["输入文件列表"], folder)


@query("existing_target_header", """SELECT CAST(o_custkey AS VARCHAR) AS "患者ID", CAST(NULL AS VARCHAR) AS "检查日期",
  CASE o_orderpriority WHEN '1-URGENT' THEN '新冠核酸检测' END AS "检查名称", CAST(NULL AS VARCHAR) AS "自定义"
FROM orders WHERE o_orderpriority = '1-URGENT'""")
def existing_target_header(spark, sf_dir):
    """A table that is already stored keeps its header: its columns and their order."""
    stored = spark.createDataFrame([], f"`患者ID` string, `检查日期` string, `检查名称` string, `自定义` string, {SOURCE_FILE} string")
    header = projection.existing_header(stored, ("患者ID",))
    tests = inputs.examinations(spark, sf_dir).filter(F.col("检查名称") == "新冠核酸检测").drop("检查日期")
    return tests.select(*projection.align(tests, header))


@query("missing_column_guard", """SELECT CAST(n AS BIGINT) AS rows, name FROM (
  SELECT 0 AS n, 'without' AS name UNION ALL
  SELECT (SELECT count(*) FROM orders), 'with')""")
def missing_column_guard(spark, sf_dir):
    """An input without a required column adds no row; with it, all of its rows count."""
    tests = inputs.examinations(spark, sf_dir)
    counted = [
        projection.Fields(df, orders.INTENT_LAB_LOOKUPS).rows_with("test_name", "patient_id")
        .agg(F.count("*").alias("rows")).withColumn("name", F.lit(name))
        for df, name in ((tests.drop("检查名称"), "without"), (tests, "with"))]
    return counted[0].unionByName(counted[1])
