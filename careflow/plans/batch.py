"""Batch: all workbooks of a folder through all tables, as one set of Spark jobs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.functions import temporal
from careflow.operators.projection import MISSING, existing_header
from careflow.operators.union import union_aligned
from careflow.plans import incremental, merge, reports
from careflow.plans.registry import SPECS, TableSpec, layouts
from careflow.schemas import HEADERS, ROW_IDX, SOURCE_FILE, SOURCE_RANK, target_type
from careflow.sources import ledger
from careflow.sources.scratch import checkpointed
from careflow.sources.sinks import read_store, upsert_files, write_table
from careflow.sources.tables import holds_data, skip_reasons
from careflow.sources.workbook import MARKER, list_workbooks, scan_workbooks, sheet_table, widen

LANDED = "_landed"
# All processed files with what they lack, each as its last run found it.
INPUTS = "_inputs"
# Columns whose text must be a date.
DATES = ("就诊日期", "入院日期")
# Tables that are built side by side.
TABLES_AT_ONCE = 4
INPUT_SCHEMA = T.StructType([
    T.StructField(SOURCE_FILE, T.StringType()), T.StructField(MISSING, T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
])


def land_workbooks(
    spark: SparkSession, directory: str | Sequence[str], output: str, pattern: str = "*.xlsx", compat: bool = False
) -> DataFrame:
    """Parse every workbook once; the tables read the result, by sheet and by column."""
    wanted = layouts(compat)
    wide = widen(scan_workbooks(spark, directory, pattern, wanted), wanted)
    path = f"{output}/{LANDED}"
    wide.write.mode("overwrite").partitionBy("sheet").parquet(path)
    return read_landed(spark, output, wide.schema)


def read_landed(
    spark: SparkSession, output: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{output}/{LANDED}")


def input_sheets(landed: DataFrame, compat: bool = False) -> dict[str, DataFrame]:
    return {sheet: sheet_table(landed, sheet, layout) for sheet, layout in layouts(compat).items()}


def workbook_files(landed: DataFrame) -> DataFrame:
    """One row per file: the sheets it lacks, and why it (or a sheet of it) cannot be read."""
    markers = landed.filter(F.col(ROW_IDX) == MARKER)
    return markers.groupBy(SOURCE_FILE).agg(
        F.array_distinct(F.flatten(F.collect_set(MISSING))).alias(MISSING),
        F.max(F.when(F.col("sheet").isNull(), F.col("error"))).alias("error"),
    )


def table_outcomes(
    files: DataFrame, numbers: Sequence[int] | None = None, failed: Mapping[int, str] = {}
) -> DataFrame:
    """(source_file, sheet, ok, error, reason): which table was built from which file.

    ``failed`` has the tables that could not be built, with the reason; ``error`` is the file's own.
    """
    specs = [s for s in SPECS if numbers is None or s.number in numbers]
    outcomes = F.array(*[
        F.struct(
            F.lit(f"sheet{s.number}").alias("sheet"),
            (F.col("error").isNull() & F.lit(s.number not in failed)
             & ~F.arrays_overlap(F.col(MISSING), F.array(*map(F.lit, s.required)))).alias("ok"),
            F.lit(f"sheet{s.number}: {failed[s.number]}" if s.number in failed else None)
            .cast("string").alias("reason"),
        ) for s in specs
    ])
    return files.select(
        F.col(SOURCE_FILE).alias("source_file"), F.col("error"), F.inline(outcomes)
    ).select("source_file", "sheet", "ok", "error", "reason")


def bad_dates(landed: DataFrame) -> DataFrame:
    """Per file and sheet: visit and admission dates that no known layout reads.

    Such a date becomes blank and its row is kept, so this is where one learns of it.
    """
    unread = sum((temporal.unparsable_dates(landed, name) for name in DATES), F.lit(0))
    return (
        landed.filter(F.col(ROW_IDX) != MARKER)
        .groupBy(F.col(SOURCE_FILE).alias("源文件路径"), F.col("sheet").alias("sheet名称"))
        .agg(unread.alias("无法识别的日期数"))
        .filter(F.col("无法识别的日期数") > 0)
    )


def quarantined_dates(landed: DataFrame) -> DataFrame:
    """The visit and admission dates that no known layout reads, each with its row, its text and the reason."""
    rows = landed.filter(F.col(ROW_IDX) != MARKER)
    return temporal.rejected_dates(rows, DATES, [SOURCE_FILE, "sheet", ROW_IDX]).select(
        F.col(SOURCE_FILE).alias("源文件路径"), F.col("sheet").alias("sheet名称"), F.col(ROW_IDX).alias("行号"),
        F.col("column").alias("列名"), F.col("text").alias("原文"), F.col("reason").alias("原因"))


def skipped_inputs(files: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(file, sheet, reason): which processed file adds nothing to which table, and why."""
    counts = union_aligned([
        df.groupBy(F.col(SOURCE_FILE).alias("file"), F.lit(table).alias("sheet"))
        .agg(F.count("*").alias("rows")) for table, df in tables.items()
    ])
    number = F.create_map(*[F.lit(v) for s in SPECS for v in (f"sheet{s.number}", s.name)])
    outcomes = table_outcomes(files).select(
        F.col("source_file").alias("file"), number[F.col("sheet")].alias("sheet"),
        F.lit(True).alias("exists"), "error", "ok",
    )
    return skip_reasons(
        outcomes.drop("ok"), outcomes.filter("ok").select("file", "sheet"), counts,
        ("file", "sheet"),
    )


def stored_schema(header: Sequence[str]) -> T.StructType:
    """A stored table: the target columns and the row identity."""
    identity = [(SOURCE_FILE, T.StringType()), (SOURCE_RANK, T.IntegerType()), (ROW_IDX, T.LongType())]
    return T.StructType(
        [T.StructField(c, target_type(c)) for c in header]
        + [T.StructField(n, t) for n, t in identity]
    )


def output_header(spark: SparkSession, spec: TableSpec, output: str) -> list[str]:
    """The header of a table that is already stored, else the default one."""
    path, default = f"{output}/{spec.name}", HEADERS[spec.name]
    if spec.fixed_header or not holds_data(spark, path):
        return list(default)
    return existing_header(read_store(spark, path), default)


def process_workbooks(
    spark: SparkSession,
    directory: str,
    output: str,
    pattern: str = "*.xlsx",
    numbers: Sequence[int] | None = None,
    compat: bool = False,
    run: str | None = None,
    changed_only: bool = False,
) -> dict[str, DataFrame]:
    """Build the tables of all workbooks; rows of a file replace its earlier rows.

    ``numbers`` picks tables (1-7); ``run`` names the run and must be new.  Returns the report
    tables, which are written too.  With ``changed_only`` only files that are new or changed since they
    were last processed so are opened, and the report is of these; files that are gone keep their rows.
    A run in which a table could not be built is not remembered, so its files come again.
    """
    if not changed_only:
        return _process_files(spark, directory, output, pattern, numbers, compat, run)
    if numbers is not None:
        raise ValueError("files are remembered for all tables, not for some")
    run = run or uuid.uuid4().hex
    listing = checkpointed(list_workbooks(spark, directory, pattern))
    changes = checkpointed(ledger.compare(listing, ledger.read_ledger(spark, output)))
    paths = ledger.to_process(changes)
    report = {"文件变化": changes}
    if paths:
        report |= _process_files(spark, paths, output, pattern, None, compat, run)
        state, problem = F.col("状态"), F.col("错误信息")
        if report["详细结果"].where((state != "error") & problem.isNotNull() & (problem != "")).isEmpty():
            opened = changes.where(F.col("change").isin(ledger.NEW, ledger.CHANGED))
            ledger.remember(listing.join(opened, "path", "left_semi"), output, run)
    return report


def _process_files(
    spark: SparkSession, places: str | Sequence[str], output: str, pattern: str, numbers: Sequence[int] | None,
    compat: bool, run: str | None,
) -> dict[str, DataFrame]:
    landed = land_workbooks(spark, places, output, pattern, compat)
    return process_sheets(
        input_sheets(landed, compat), workbook_files(landed), output, numbers, compat, run,
        {"日期异常": bad_dates(landed), "日期隔离": quarantined_dates(landed)},
    )


def process_sheets(
    sheets: Mapping[str, DataFrame],
    files: DataFrame,
    output: str,
    numbers: Sequence[int] | None = None,
    compat: bool = False,
    run: str | None = None,
    reported: Mapping[str, DataFrame] = {},
) -> dict[str, DataFrame]:
    """Build the tables of the input ``sheets``, which name their file in ``_source_file``.

    ``files`` has (file, what it lacks, error) of every processed file.  A table that cannot be built
    leaves what is stored of it as it was, is reported, and does not stop the others.
    """
    spark, run = files.sparkSession, run or uuid.uuid4().hex
    built: dict[str, DataFrame] = {}
    failed: dict[int, str] = {}

    def build(spec: TableSpec) -> None:
        try:
            path = f"{output}/{spec.name}"
            header = output_header(spark, spec, output)
            table = spec.build(spec.inputs(sheets), built, header, compat)
            upsert_files(table, files.select(SOURCE_FILE), path, run)
        except Exception as problem:  # whatever it is, the other tables go on
            failed[spec.number] = f"{type(problem).__name__}: {problem}".splitlines()[0]
        else:
            # Later tables read what was written rather than build it again.
            built[spec.name] = read_store(spark, path, stored_schema(header), run)

    wanted = [spec for spec in SPECS if numbers is None or spec.number in numbers]
    # Others read the merged visits; the rest have nothing to do with each other.
    for spec in wanted[:1]:
        build(spec)
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        list(pool.map(build, wanted[1:]))
    upsert_files(files.select(*INPUT_SCHEMA.names), files.select(SOURCE_FILE), f"{output}/{INPUTS}", run)
    results = reports.file_results(table_outcomes(files, numbers, failed))
    only = numbers[0] if numbers is not None and len(numbers) == 1 else None
    report = {
        "总体统计": reports.batch_summary(results),
        "详细结果": reports.batch_details(results, output, only),
        **reported,
    }
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        list(pool.map(lambda name: write_table(report[name], f"{output}/batch_process_report/{name}"), report))
    return report


def processed_files(spark: SparkSession, output: str) -> DataFrame:
    """Every file that any run processed, as its last run found it."""
    return read_store(spark, f"{output}/{INPUTS}", INPUT_SCHEMA)


def stored_tables(spark: SparkSession, output: str) -> Mapping[str, DataFrame]:
    """The seven tables as they are stored; one without any row has its default header."""
    def stored(spec: TableSpec) -> DataFrame:
        path, schema = f"{output}/{spec.name}", stored_schema(output_header(spark, spec, output))
        return read_store(spark, path, schema) if holds_data(spark, path) else spark.createDataFrame([], schema)

    return {spec.name: stored(spec) for spec in SPECS}


def merge_processed(
    spark: SparkSession, processed: str, output: str, run_ts: str, compat: bool = False
) -> dict[str, DataFrame]:
    """Merge what ``process_workbooks`` left in ``processed``."""
    files, tables = processed_files(spark, processed), stored_tables(spark, processed)
    return merge.merge_results(
        spark, tables, files.select(F.col(SOURCE_FILE).alias("path")), output, run_ts, compat,
        {"跳过的文件": lambda: skipped_inputs(files, tables)},
    )


def merge_changed(spark: SparkSession, processed: str, output: str, run_ts: str) -> dict[str, incremental.Change]:
    """As ``merge_processed``, but only of what changed in ``processed`` since the last such merge.

    ``incremental.read_incremental`` reads the merged tables.
    """
    schemas = {}
    for spec in SPECS:
        if holds_data(spark, f"{processed}/{spec.name}"):
            schemas[spec.name] = stored_schema(output_header(spark, spec, processed))
    return incremental.merge_incremental(spark, processed, schemas, output, run_ts)
