"""Reports of a batch run and of a merge, as small tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.functions import status
from careflow.functions.naming import quoted
from careflow.operators.running import with_total_before


def _lines(row: DataFrame, entries: Mapping[str, Column]) -> DataFrame:
    """A one-row frame as (指标, 数值) lines."""
    pairs = [F.struct(F.lit(k).alias("指标"), v.cast("string").alias("数值"))
             for k, v in entries.items()]
    return row.select(F.inline(F.array(*pairs)))


def file_results(outcomes: DataFrame) -> DataFrame:
    """One row per file from (source_file, sheet, ok, error) with one row per file and table.

    ``reason``, if there, says why a table could not be built.  The lists are as long as the table
    list, which is fixed.
    """
    reason = F.col("reason") if "reason" in outcomes.columns else F.lit(None).cast("string")
    def named(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("sheet")))), ", ")

    grouped = outcomes.groupBy("source_file").agg(
        F.count_if("ok").alias("_ok"),
        F.count_if(~F.col("ok")).alias("_bad"),
        F.max("error").alias("_error"),
        named(F.col("ok")).alias("_names_ok"),
        named(~F.col("ok")).alias("_names_bad"),
        F.array_join(F.array_sort(F.collect_set(reason)), "; ").alias("_reasons"),
    )
    return grouped.withColumn(
        "_status", status.file_status(F.col("_ok"), F.col("_bad"), F.col("_error"))
    )


def batch_details(results: DataFrame, output: str, table_number: int | None = None) -> DataFrame:
    path, error = F.col("source_file"), F.col("_status") == "error"
    return results.select(
        F.when(error, F.regexp_replace(status.base_name(path), r"(?<=.)\.[^.]*$", ""))
        .otherwise(status.workbook_name(path)).alias("文件名"),
        path.alias("源文件路径"),
        F.when(error, F.lit(""))
        .otherwise(F.concat(F.lit(output.rstrip("/") + "/"), status.output_name(path, table_number)))
        .alias("目标文件路径"),
        F.col("_status").alias("状态"),
        F.when(error, F.lit("")).otherwise(F.col("_names_ok")).alias("成功处理的sheet"),
        F.when(error, F.lit("")).otherwise(F.col("_names_bad")).alias("失败处理的sheet"),
        F.coalesce("_error", "_reasons").alias("错误信息"),
    )


def batch_totals(results: DataFrame) -> DataFrame:
    """Files in all and by outcome; a partial file is neither a success nor a failure."""
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("_status") == "success").alias("success"),
        F.count_if(F.col("_status") == "partial").alias("partial"),
        F.count_if(F.col("_status").isin("failed", "error")).alias("failed"),
    )


def batch_summary(results: DataFrame) -> DataFrame:
    return _lines(batch_totals(results), {
        "总文件数": F.col("total"),
        "处理文件数": F.col("total"),
        "成功文件数": F.col("success"),
        "部分成功文件数": F.col("partial"),
        "失败文件数": F.col("failed"),
        "成功率": status.success_rate(F.col("success"), F.col("total")),
    })


def merge_details(row_counts: DataFrame, expected: DataFrame) -> DataFrame:
    """One line per expected table from (sheet, rows, error); a table without rows is empty.

    ``expected`` (ordinal, sheet) is the fixed list of output tables.
    """
    counts = row_counts.groupBy("sheet").agg(
        F.sum("rows").alias("rows"), F.max("error").alias("error")
    )
    rows = F.when(F.col("error").isNull(), F.coalesce("rows", F.lit(0))).otherwise(F.lit(0))
    return expected.join(counts, "sheet", "left").select(
        "ordinal",
        F.col("sheet").alias("sheet名称"),
        F.when(F.col("error").isNotNull(), F.lit("error"))
        .when(rows > 0, F.lit("success"))
        .otherwise(F.lit("empty")).alias("状态"),
        rows.cast("bigint").alias("行数"),
        F.coalesce("error", F.lit("")).alias("错误信息"),
    )


def merge_summary(details: DataFrame, n_files: Column, output: str) -> DataFrame:
    totals = details.agg(
        F.count_if(F.col("状态") == "success").alias("processed"),
        F.count_if(F.col("状态") != "success").alias("failed"),
    )
    processed, failed = F.col("processed"), F.col("failed")
    return _lines(totals, {
        "合并状态": status.merge_status(processed, failed),
        "合并信息": status.merge_message(processed, failed),
        "输入文件数": n_files,
        "成功处理的sheet数": processed,
        "失败处理的sheet数": failed,
        "输出文件路径": F.lit(output),
    })


def input_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Input files in name order with a running number from 1.

    ``row_number`` over everything would be one task; ranges of names are numbered side by side.
    """
    paths = files.select(F.col(quoted(path)).alias("path")).distinct()
    numbered = with_total_before(paths, ["path"], F.lit(1))
    return numbered.select(
        (F.col("_before") + 1).alias("序号"), status.base_name(F.col("path")).alias("文件名"),
        F.col("path").alias("文件路径"))
