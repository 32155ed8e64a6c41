"""Run status, percentages and file names for the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name rewriting.
TEST_PREFIX, PREFIX = "测试原始数据", "原始数据"


def file_status(succeeded: Column, failed: Column, error: Column) -> Column:
    """``succeeded`` and ``failed`` count tables; ``error`` is set when nothing could run."""
    return (
        F.when(error.isNotNull(), F.lit("error"))
        .when(failed == 0, F.lit("success"))
        .when(succeeded > 0, F.lit("partial"))
        .otherwise(F.lit("failed"))
    )


def merge_status(processed: Column, failed: Column) -> Column:
    return (
        F.when((failed > 0) & (processed > 0), F.lit("partial"))
        .when(failed > 0, F.lit("error"))
        .otherwise(F.lit("success"))
    )


def merge_message(processed: Column, failed: Column) -> Column:
    return (
        F.when(
            (failed > 0) & (processed > 0),
            F.format_string("部分sheet合并成功，%d个成功，%d个失败", processed, failed),
        )
        .when(failed > 0, F.lit("所有sheet合并失败"))
        .otherwise(F.format_string("所有sheet合并成功，共%d个sheet", processed))
    )


def success_rate(succeeded: Column, total: Column) -> Column:
    """Two decimals and a per-cent sign; no files gives ``0.00%``."""
    return F.when(
        total > 0, F.format_string("%.2f%%", succeeded.cast("double") / total * 100)
    ).otherwise(F.lit("0.00%"))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def workbook_name(path: Column) -> Column:
    """Base name without its extension, test prefix removed."""
    return F.replace(
        F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", ""), F.lit(TEST_PREFIX), F.lit(PREFIX)
    )


def output_name(path: Column, table_number: int | None = None) -> Column:
    """Name of the processed output: of one table, or of the whole workbook."""
    suffix = "_processed" if table_number is None else f"合并phase1sheet{table_number}"
    return F.concat(workbook_name(path), F.lit(suffix))
