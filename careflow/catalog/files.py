"""Queries over given tables that are written as many files first, and read back as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.catalog.registry import query, read
from careflow.functions import temporal
from careflow.plans import merge
from careflow.schemas import ROW_ID, SOURCE_FILE
from careflow.sources import ledger, scratch, tables

RUN_TS = "2024-02-01 00:00:00"


def _values(df: DataFrame) -> DataFrame:
    return df.select(*[f"`{c}`" for c in df.columns if c not in ROW_ID])


@query("uneven_csv_headers", """WITH o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority,
    CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderstatus FROM orders)
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS o_orderdate, CASE WHEN o_orderstatus = 'P' THEN o_orderstatus END AS o_orderstatus
FROM o""")
def uneven_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files of three headers, in other orders and spellings: each value under its own name."""
    orders, folder = read(spark, sf_dir, "orders"), scratch.new_folder(spark)
    status = F.col("o_orderstatus")
    parts = {
        "even": orders.where((status == "F") & (F.col("o_custkey") % 2 == 0)).select("o_orderkey", "o_custkey", "o_orderpriority"),
        "odd": orders.where((status == "F") & (F.col("o_custkey") % 2 == 1)).select("o_orderkey", "o_custkey", "o_orderpriority"),
        "open": orders.where(status == "O").select(F.col("o_orderdate").cast("string"), "o_custkey", "o_orderkey"),
        "pending": orders.where(status == "P").select("o_orderstatus", F.col("o_orderkey").alias("o_orderkey!")),
    }
    for name, rows in parts.items():
        rows.write.option("header", True).csv(f"{folder}/{name}")
    found = tables.read_table(spark, [f"{folder}/{name}" for name in parts], "csv", clean=True)
    return scratch.without_folder(_values(found), folder)


@query("uneven_parquet_headers", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS o_orderdate, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def uneven_parquet_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files that share one column, in one of them as text: nothing is lost, text stays text."""
    orders, folder = read(spark, sf_dir, "orders"), scratch.new_folder(spark)
    parts = {
        "F": orders.select("o_orderkey", "o_custkey", "o_orderstatus"),
        "O": orders.select("o_orderdate", "o_orderkey", "o_orderstatus"),
        "P": orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority", "o_orderstatus"),
    }
    for status, rows in parts.items():
        rows.where(F.col("o_orderstatus") == status).drop("o_orderstatus").write.parquet(f"{folder}/{status}")
    found = tables.read_table(spark, [f"{folder}/{status}" for status in parts])
    return scratch.without_folder(_values(found), folder)


@query("merge_uneven_files", f"""WITH f AS (
  SELECT 1 AS file, c_custkey, c_name, NULL AS c_mktsegment FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 2, c_custkey, c_name, c_mktsegment FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY file) AS n FROM f)
SELECT CAST(c_custkey AS VARCHAR) AS "编号", c_name AS "姓名", c_mktsegment AS "分类", '{RUN_TS}' AS "数据更新时间" FROM r WHERE n = 1""")
def merge_uneven_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt without their segment, then all with it: who comes first stays as found there."""
    customer, folder = read(spark, sf_dir, "customer"), scratch.new_folder(spark)
    known = customer.select(
        F.col("c_custkey").alias("编号"), F.col("c_name").alias("姓名"), F.col("c_mktsegment").alias("分类"), "c_acctbal")
    known.where(F.col("c_acctbal") < 0).select("编号", "姓名").write.option("header", True).csv(f"{folder}/1")
    known.select("分类", "姓名", F.col("编号").alias("编号?")).write.option("header", True).csv(f"{folder}/2")
    merged, _ = merge.merge_files(spark, [f"{folder}/1", f"{folder}/2"], RUN_TS, "csv")
    return scratch.without_folder(merged.drop(merge.ORIGIN), folder)


@query("changed_files", """WITH now AS (
  SELECT '/in/' || c_custkey || '.xlsx' AS path, CAST(c_nationkey AS BIGINT) AS length FROM customer WHERE c_mktsegment <> 'MACHINERY'),
before AS (
  SELECT '/in/' || c_custkey || '.xlsx' AS path, CAST(CASE WHEN c_acctbal < 0 THEN -1 ELSE c_nationkey END AS BIGINT) AS length
  FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT coalesce(now.path, before.path) AS path, CASE WHEN before.path IS NULL THEN 'new' WHEN now.path IS NULL THEN 'gone'
  WHEN now.length = before.length THEN 'same' ELSE 'changed' END AS change
FROM now FULL JOIN before ON now.path = before.path""")
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as files: one segment came, one went, those in debt had another length."""
    customer = read(spark, sf_dir, "customer")
    path = F.concat(F.lit("/in/"), F.col("c_custkey"), F.lit(".xlsx"))
    time = F.lit("2024-02-01 00:00:00").cast("timestamp")
    listing = customer.where(F.col("c_mktsegment") != "MACHINERY").select(
        path.alias("path"), F.col("c_nationkey").cast("bigint").alias("length"), time.alias("modificationTime"))
    known = customer.where(F.col("c_mktsegment") != "BUILDING").select(
        path.alias(SOURCE_FILE),
        F.when(F.col("c_acctbal") < 0, -1).otherwise(F.col("c_nationkey")).cast("bigint").alias("length"), time.alias("modified"))
    folder = scratch.new_folder(spark)
    ledger.remember(known.withColumnsRenamed({SOURCE_FILE: "path", "modified": "modificationTime"}), folder, "first")
    return scratch.without_folder(ledger.compare(listing, ledger.read_ledger(spark, folder)), folder)


_DATES = """dated AS (SELECT o_orderkey, o_orderstatus, CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y/%m/%d') WHEN '2-HIGH' THEN strftime(o_orderdate, '%d.%m.%Y')
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y') || '-02-30' WHEN '5-LOW' THEN strftime(o_orderdate, '%Y%m%d') ELSE ' ' END AS day,
  CASE o_orderpriority WHEN '2-HIGH' THEN 'no known layout' WHEN '3-MEDIUM' THEN 'no such day or time' END AS reason FROM orders)"""


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose dates are written in five ways: two are read, one is blank, two are no dates."""
    date, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.date_format(date, "yyyy/MM/dd")).when(priority == "2-HIGH", F.date_format(date, "dd.MM.yyyy"))
        .when(priority == "3-MEDIUM", F.concat(F.date_format(date, "yyyy"), F.lit("-02-30")))
        .when(priority == "5-LOW", F.date_format(date, "yyyyMMdd")).otherwise(" "))
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", text.alias("就诊日期"))


@query("rejected_dates", f"""WITH {_DATES}
SELECT o_orderkey, '就诊日期' AS "column", day AS text, reason FROM dated WHERE reason IS NOT NULL""")
def rejected_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.rejected_dates(_dated(spark, sf_dir), ["就诊日期", "入院日期"], ["o_orderkey"])


@query("bad_date_counts", f"""WITH {_DATES}
SELECT o_orderstatus, count(reason) AS bad FROM dated GROUP BY o_orderstatus""")
def bad_date_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _dated(spark, sf_dir)
    return dated.groupBy("o_orderstatus").agg(temporal.unparsable_dates(dated, "就诊日期").alias("bad"))
