"""Queries that write: the table store and a merge run, read back from what was written."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from careflow.catalog.registry import query, read
from careflow.plans import incremental, merge
from careflow.schemas import LIS04, LIS06, ROW_IDX, SOURCE_FILE, TABLES
from careflow.sources import scratch, sinks


def _by_status(spark: SparkSession, sf_dir: str):
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("/in/"), F.col("o_orderstatus"), F.lit(".xlsx")).alias(SOURCE_FILE),
        F.col("o_orderkey").alias("order_key"), F.round("o_totalprice", 2).alias("price"),
    )


@query("store_upsert", """SELECT o_orderstatus || '.xlsx' AS file, o_orderkey AS order_key,
  round(o_totalprice, 2) AS price FROM orders
WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_totalprice >= 100000)""")
def store_upsert(spark, sf_dir):
    """Three files are stored; then one comes with fewer rows and one with none."""
    rows, folder = _by_status(spark, sf_dir), scratch.new_folder(spark)
    path = f"{folder}/orders"
    files = rows.select(SOURCE_FILE).distinct()
    sinks.upsert_files(rows, files, path, "first")
    again = files.filter(~F.col(SOURCE_FILE).endswith("O.xlsx"))
    fewer = rows.filter(F.col(SOURCE_FILE).endswith("F.xlsx") & (F.col("price") >= 100000))
    sinks.upsert_files(fewer, again, path, "second")
    stored = sinks.read_store(spark, path, rows.schema)
    named = stored.select(
        F.element_at(F.split(SOURCE_FILE, "/"), -1).alias("file"), "order_key", "price")
    return scratch.without_folder(named, folder)


_FILLED = {LIS04: "SELECT count(DISTINCT (o_custkey, o_orderpriority, o_orderdate)) FROM orders",
           LIS06: "SELECT count(DISTINCT o_custkey) FROM orders"}


def _merge_rows(spark: SparkSession, sf_dir: str):
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("患者ID"),
        F.col("o_orderpriority").alias("药物名称"),
        F.col("o_orderdate").cast("string").alias("用药日期"),
        F.concat(F.lit("/in/"), F.col("o_orderstatus"), F.lit(".xlsx")).alias(SOURCE_FILE),
        F.col("o_orderkey").alias(ROW_IDX),
    )


@query("merge_run", " UNION ALL ".join(
    f"""SELECT '{t}' AS "sheet名称", '{"success" if t in _FILLED else "empty"}' AS "状态",
  CAST(({_FILLED.get(t, "0")}) AS BIGINT) AS "行数", '' AS "错误信息" """ for t in TABLES))
def merge_run(spark, sf_dir):
    """Two of the seven tables have rows, in three files; the merge writes and counts all."""
    rows = _merge_rows(spark, sf_dir)
    tables = {LIS04: rows, LIS06: rows.drop("药物名称", "用药日期")}
    files = rows.select(F.col(SOURCE_FILE).alias("path"))
    folder = scratch.new_folder(spark)
    report = merge.merge_results(spark, tables, files, f"{folder}/merged", "2024-02-01 00:00:00")
    return scratch.without_folder(report["详细结果"], folder)


_FIRST = "CAST(({0}) AS BIGINT)"


@query("merge_failed_table_rolls_back", f"""
SELECT '{LIS04}' AS "sheet名称", {_FIRST.format(_FILLED[LIS04])} AS rows, 'success' AS stored, 'error' AS attempt
UNION ALL SELECT '{LIS06}', {_FIRST.format(_FILLED[LIS06])}, 'success', 'success'""")
def merge_failed_table_rolls_back(spark, sf_dir):
    """A merge is whole; the next has fewer rows and a table that fails: tables and report stay as they were."""
    rows, folder = _merge_rows(spark, sf_dir), scratch.new_folder(spark)
    files, output = rows.select(F.col(SOURCE_FILE).alias("path")), f"{folder}/merged"
    patients = rows.drop("药物名称", "用药日期")
    merge.merge_results(spark, {LIS04: rows, LIS06: patients}, files, output, "2024-02-01 00:00:00")
    broken = rows.withColumn("药物名称", F.when(F.col(ROW_IDX) > 0, F.raise_error(F.lit("unreadable orders"))).cast("string"))
    fewer = patients.filter(F.col(SOURCE_FILE).endswith("F.xlsx"))
    attempt = merge.merge_results(spark, {LIS04: broken, LIS06: fewer}, files, output, "2024-02-02 00:00:00")
    counts = [merge.read_merged(spark, output, t).agg(F.count("*").alias("rows")).withColumn("sheet名称", F.lit(t))
              for t in (LIS04, LIS06)]
    stored = merge.read_report(spark, output, "详细结果").select("sheet名称", F.col("状态").alias("stored"))
    tried = attempt["详细结果"].select("sheet名称", F.col("状态").alias("attempt"))
    result = counts[0].unionByName(counts[1]).join(stored, "sheet名称").join(tried, "sheet名称")
    return scratch.without_folder(result.select("sheet名称", "rows", "stored", "attempt"), folder)


@query("merge_incremental", """WITH f AS (
  SELECT '/in/' || o_orderstatus || '.xlsx' AS path, o_orderstatus || '.xlsx' AS name, CAST(o_custkey AS VARCHAR) AS id,
    o_orderpriority AS drug, CAST(o_orderdate AS VARCHAR) AS day, o_orderkey AS row
  FROM orders WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_totalprice >= 100000)),
r AS (SELECT *, row_number() OVER (PARTITION BY id, drug, day ORDER BY path, row) AS n FROM f)
SELECT id AS "患者ID", drug AS "药物名称", day AS "用药日期", name AS "数据来源" FROM r WHERE n = 1""")
def merge_incremental(spark, sf_dir):
    """Three files are merged; then one comes with fewer rows and one with none, and only these are merged again."""
    folder = scratch.new_folder(spark)
    rows, store = _merge_rows(spark, sf_dir), f"{folder}/processed/{LIS04}"
    files = rows.select(SOURCE_FILE).distinct()
    sinks.upsert_files(rows, files, store, "first")
    schemas = {LIS04: rows.schema}
    incremental.merge_incremental(spark, f"{folder}/processed", schemas, f"{folder}/merged", "2024-02-01 00:00:00", 16)
    dear = read(spark, sf_dir, "orders").where(F.col("o_totalprice") >= 100000).select(F.col("o_orderkey").alias(ROW_IDX))
    fewer = rows.filter(F.col(SOURCE_FILE).endswith("F.xlsx")).join(dear, ROW_IDX, "left_semi").select(*rows.columns)
    sinks.upsert_files(fewer, files.filter(~F.col(SOURCE_FILE).endswith("O.xlsx")), store, "second")
    incremental.merge_incremental(spark, f"{folder}/processed", schemas, f"{folder}/merged", "2024-02-02 00:00:00", 16)
    return scratch.without_folder(incremental.read_incremental(spark, f"{folder}/merged", LIS04).drop(merge.UPDATED), folder)
