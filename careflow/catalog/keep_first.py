"""Deduplication and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.catalog.registry import query, read
from careflow.operators import dedup
from careflow.plans.merge import merge_table
from careflow.schemas import LIS04, ROW_IDX, SOURCE_FILE
from careflow.plans import merge

RUN_TS = "2024-02-01 00:00:00"


def _order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the rows of three files, one per status."""
    return read(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_custkey").cast("string"), F.lit("7")).alias("患者ID"),
        F.col("o_orderpriority").alias("药物名称（通用）"),
        F.col("o_orderdate").cast("date").cast("string").alias("用药日期"),
        F.concat(F.lit("/in/"), F.col("o_orderstatus"), F.lit(".xlsx")).alias(SOURCE_FILE),
        F.col("o_orderkey").alias(ROW_IDX),
    )


_FILES_SQL = """f AS (SELECT nullif(CAST(o_custkey AS VARCHAR), '7') AS patient, o_orderpriority AS drug,
  strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus || '.xlsx' AS file, o_orderkey AS row_key FROM orders)"""


def _merged_sql(keys: str) -> str:
    return f"""WITH {_FILES_SQL}
SELECT patient AS "患者ID", drug AS "药物名称通用", day AS "用药日期", file AS "数据来源",
  '{RUN_TS}' AS "数据更新时间" FROM f
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY file, row_key) = 1"""


@query("merge_dedup_id", _merged_sql("patient"))
def merge_dedup_id(spark, sf_dir):
    return merge_table(_order_files(spark, sf_dir), RUN_TS)


@query("merge_dedup_keys", _merged_sql("patient, drug, day"))
def merge_dedup_keys(spark, sf_dir):
    keys = ["药物名称（通用）" if k == "药物名称" else k for k in merge.KEYS[LIS04]]
    return merge_table(_order_files(spark, sf_dir), RUN_TS, keys)


@query("merge_dedup_keep_null_keys", f"""WITH {_FILES_SQL}, kept AS (
  SELECT * FROM f WHERE patient IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY patient ORDER BY file, row_key) = 1
  UNION ALL SELECT * FROM f WHERE patient IS NULL)
SELECT patient AS "患者ID", drug AS "药物名称通用", day AS "用药日期", file AS "数据来源",
  '{RUN_TS}' AS "数据更新时间" FROM kept""")
def merge_dedup_keep_null_keys(spark, sf_dir):
    return merge_table(_order_files(spark, sf_dir), RUN_TS, ["患者ID"], keep_null_keys=True)


@query("merge_dedup_all", f"""SELECT DISTINCT text, lang, source AS "数据来源",
  '{RUN_TS}' AS "数据更新时间" FROM documents""")
def merge_dedup_all(spark, sf_dir):
    """No identifier column: only rows equal in every column, origin included, collapse."""
    documents = read(spark, sf_dir, "documents").select(
        "text", "lang", F.concat(F.lit("/in/"), "source").alias(SOURCE_FILE),
        F.col("doc_id").alias(ROW_IDX))
    return merge_table(documents, RUN_TS)


@query("distinct_rows", "SELECT DISTINCT text, lang FROM documents")
def distinct_rows(spark, sf_dir):
    return dedup.drop_duplicate_rows(read(spark, sf_dir, "documents").select("text", "lang"))


@query("keep_first_line", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_extendedprice) = 1""")
def keep_first_line(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    kept = dedup.keep_first(
        lines, ["l_orderkey", "l_linenumber"],
        [F.desc_nulls_last("l_shipdate"),
         *dedup.tie_break(lines, ["l_partkey", "l_suppkey", "l_extendedprice"])])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("lines_with_group_size", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_extendedprice, count(*) OVER (PARTITION BY l_returnflag, l_linenumber) AS group_size FROM lineitem""")
def lines_with_group_size(spark, sf_dir):
    """Few keys, each with a large part of all rows: the salted path."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    sized = dedup.with_group_size(
        lines, ["l_returnflag", "l_linenumber"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return sized.drop("l_returnflag")


@query("distinct_keys", "SELECT DISTINCT user_id FROM events")
def distinct_users(spark, sf_dir):
    return dedup.distinct_keys(read(spark, sf_dir, "events"), "user_id")


@query("latest_sorted", """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day
FROM orders ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END DESC NULLS LAST, o_orderkey LIMIT 100""")
def latest_sorted(spark, sf_dir):
    """Top of the report: the newest hundred, unknown dates last."""
    orders = read(spark, sf_dir, "orders").withColumn(
        "known", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    top = dedup.latest_sorted(orders, "known", ["o_orderkey"], 100)
    return top.select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").cast("string").alias("day"))
