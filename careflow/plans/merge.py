"""Merge: all files' rows of one table, with provenance, duplicates removed, and a report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow import vocab
from careflow.functions import status
from careflow.functions.naming import clean_name, clean_names, quoted
from careflow.functions.temporal import as_timestamp, render_timestamp
from careflow.operators import dedup
from careflow.operators.projection import lineage
from careflow.plans import reports
from careflow.schemas import (
    LIS01, LIS02, LIS03, LIS04, LIS05, LIS06, LISA1, ROW_ID, ROW_IDX, SOURCE_FILE, TABLES, target_schema,
)
from careflow.sources import generations, headers
from careflow.sources.sinks import write_table
from careflow.sources.tables import delete_path

ORIGIN, UPDATED = "数据来源", "数据更新时间"

# What makes two rows of a table the same record.
KEYS: dict[str, tuple[str, ...]] = {
    LIS01: ("患者唯一编码", "就诊日期"),
    LIS02: ("患者唯一编码", "就诊日期"),
    LIS03: ("患者ID", "就诊日期", "检测日期", "就诊类型"),
    LIS04: ("患者ID", "药物名称", "用药日期"),
    LIS05: ("患者ID", "检查名称", "检查日期"),
    LIS06: ("患者ID",),
    LISA1: ("患者ID",),
}
# Keys that count by day: visits, of which there is one per patient and day.
DAY_KEYS: dict[str, tuple[str, ...]] = {LIS01: ("就诊日期",), LIS02: ("就诊日期",)}
# Statistics of a patient's visits.
FIRST, LAST, VISITS = "首次就诊日期", "最近就诊日期", "就诊次数"
# Tables that are merged side by side.
MERGES = 4
REPORT, ATTEMPT = "merge_report", "last_attempt"


def with_provenance(df: DataFrame, run_ts: str) -> DataFrame:
    """Clean column names, then set (or overwrite) origin file and update time."""
    own = [c for c in df.columns if c not in ROW_ID]
    cleaned = df.select(
        *[F.col(quoted(c)).alias(n) for c, n in zip(own, clean_names(own))], *lineage(df)
    )
    return cleaned.withColumns({
        ORIGIN: status.base_name(F.col(SOURCE_FILE)), UPDATED: F.lit(run_ts),
    })


def id_column(columns: Sequence[str]) -> str | None:
    """First column whose lower-cased name marks it as an identifier."""
    return next(
        (c for c in columns if any(k in c.lower() for k in vocab.ID_COLUMN_NAMES)), None
    )


def _row_order(df: DataFrame, own: Sequence[str]) -> list[str]:
    """Row identity; without row numbers a row's content settles what the file leaves open."""
    return lineage(df) if ROW_IDX in df.columns else [*lineage(df), *own]


def _blank(column: Column) -> Column:
    return F.trim(F.coalesce(column.cast("string"), F.lit(""))) == ""


def _days(df: DataFrame, keys: Sequence[str], by_day: Sequence[str]) -> dict[str, Column]:
    """The day of each key that counts by day, null where none can be read."""
    days = {clean_name(k) for k in by_day}
    return {k: as_timestamp(df, k).cast("date").cast("string") for k in map(clean_name, keys) if k in days}


def key_columns(df: DataFrame, keys: Sequence[str], by_day: Sequence[str] = ()) -> list[Column]:
    """What must be equal for two rows to be one record."""
    day = _days(df, keys, by_day)
    return [
        F.coalesce(day[k], F.col(quoted(k)).cast("string")) if k in day else F.col(quoted(k)) for k in map(clean_name, keys)
    ]


def merge_table(
    df: DataFrame,
    run_ts: str,
    keys: Sequence[str] | None = None,
    keep_null_keys: bool = False,
    by_day: Sequence[str] = ("就诊日期",),
) -> DataFrame:
    """First row per key in (file, row) order.

    With ``keys`` those decide; of a key in ``by_day`` only the day counts, read from whatever
    layout it is written in.  Without, the first identifier column does, whatever it is, and a
    table without one loses only rows equal in every column (origin included).  With
    ``keep_null_keys`` rows without the first key, or without a readable day, are nobody's
    duplicates and all stay; else they are equal if their texts are.
    """
    merged = with_provenance(df, run_ts)
    own = [c for c in merged.columns if c not in ROW_ID]
    if keys is None:
        found = id_column(own)
        if found is None:
            return dedup.drop_duplicate_rows(merged, lineage(merged))
        keys = (found,)
    day = _days(merged, keys, by_day)
    columns = key_columns(merged, keys, by_day)
    order = dedup.tie_break(merged, _row_order(merged, own))
    if not keep_null_keys:
        return dedup.keep_first(merged, columns, order).select(*map(quoted, own))
    unknown = _blank(columns[0])
    for value in day.values():
        unknown = unknown | value.isNull()
    kept = dedup.keep_first(merged.filter(~unknown), columns, order)
    return kept.unionByName(merged.filter(unknown)).select(*map(quoted, own))


def merge_patients(df: DataFrame, run_ts: str, key: str = KEYS[LISA1][0]) -> DataFrame:
    """One row per known patient of all files: that of the latest visit, with the first and the
    last visit and the number of visits over all of them.

    One aggregation, partial before the shuffle.  Rows without a patient all stay.
    """
    merged = with_provenance(df, run_ts)
    own = [c for c in merged.columns if c not in ROW_ID]
    times = {c: as_timestamp(merged, c) for c in (FIRST, LAST) if c in own}
    last = times.get(LAST, F.lit(None).cast("timestamp_ntz"))
    # Least first: the newest time (none at the end), then the earliest row.
    age = -F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), last)
    ties = [part for c in _row_order(merged, own) for part in (F.col(quoted(c)).isNull(), F.col(quoted(c)))]
    rows = merged.filter(~_blank(F.col(quoted(key)))).select(
        F.col(quoted(key)).alias("_key"),
        F.struct(last.isNull(), age, *ties).alias("_order"),
        F.struct(*map(quoted, own)).alias("_row"),
        *[times.get(c, F.lit(None).cast("timestamp_ntz")).alias(n) for c, n in ((FIRST, "_first"), (LAST, "_last"))],
        (F.col(quoted(VISITS)) if VISITS in own else F.lit(None)).cast("bigint").alias("_visits"),
    )
    patients = rows.groupBy("_key").agg(
        F.min_by("_row", "_order").alias("_row"), F.min("_first").alias("_first"),
        F.max("_last").alias("_last"), F.sum("_visits").alias("_visits"),
    )
    computed = {
        FIRST: render_timestamp(F.col("_first")), LAST: render_timestamp(F.col("_last")),
        VISITS: F.col("_visits"),
    }
    known = patients.select(*[
        computed[c].cast(merged.schema[c].dataType).alias(c) if c in computed
        else F.col("_row").getField(c).alias(c) for c in own
    ])
    return known.unionByName(merged.filter(_blank(F.col(quoted(key)))).select(*map(quoted, own)))


def merge_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    run_ts: str,
    fmt: str = "parquet",
    keys: Sequence[str] | None = None,
    keep_null_keys: bool = False,
    by_day: Sequence[str] = ("就诊日期",),
    pattern: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One table from many files whose headers differ, merged as by ``merge_table``, and the files that add
    nothing to it (file, reason, error): missing, unreadable or empty.
    """
    found = headers.read_files(spark, paths, fmt, pattern, clean=True)
    skipped = spark.createDataFrame(found.skipped, "file string, reason string, error string")
    lost = {entry[0] for entry in found.skipped}
    there = [p for p in ([paths] if isinstance(paths, str) else paths) if p not in lost]
    listed = [f for f in (headers.file_names(spark, there, pattern) if there else []) if f not in lost]
    files = spark.createDataFrame([(f,) for f in listed], "file string")
    with_rows = found.rows.select(headers.plain_path(F.col(SOURCE_FILE)).alias("file")).distinct()
    empty = files.join(with_rows, "file", "left_anti").select(
        "file", F.lit("empty").alias("reason"), F.lit(None).cast("string").alias("error"))
    return merge_table(found.rows, run_ts, keys, keep_null_keys, by_day), skipped.unionByName(empty)


def merged_rows(table: str, df: DataFrame, run_ts: str, compat: bool = False) -> DataFrame:
    """The rows of one table over all files, without duplicates."""
    if compat:
        return merge_table(df, run_ts)
    if table == LISA1:
        return merge_patients(df, run_ts)
    return merge_table(df, run_ts, KEYS[table], True, DAY_KEYS.get(table, ()))


def merge_results(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    files: DataFrame,
    output: str,
    run_ts: str,
    compat: bool = False,
    reported: Mapping[str, Callable[[], DataFrame]] = {},
    keep_last: bool = True,
) -> dict[str, DataFrame]:
    """Merge and write every table, then report; all of it becomes current at once.

    ``files`` has (path).  A table that fails is reported and does not stop the others.  If one failed and an
    earlier merge of ``output`` was whole, that one stays current, all tables and its report, and this run's
    report is left in ``last_attempt``; with ``keep_last`` off, or where there is none before, what went well is
    published.  ``reported`` are more report tables.  ``read_merged`` reads the current tables.
    """
    folder = generations.new_generation(output)

    def merged(table: str) -> tuple[str, int, str | None]:
        """(sheet, rows, error) of one table, written; rows are counted on the way."""
        try:
            found = (
                merged_rows(table, tables[table], run_ts, compat) if table in tables
                else spark.createDataFrame([], target_schema(table)))
            return table, write_table(found, f"{folder}/{table}"), None
        except Exception as problem:
            return table, 0, f"{type(problem).__name__}: {problem}".splitlines()[0]

    # The tables have nothing to do with each other.
    with ThreadPoolExecutor(MERGES) as pool:
        per_table = spark.createDataFrame(list(pool.map(merged, TABLES)), "sheet string, rows bigint, error string")
    expected = spark.createDataFrame(list(enumerate(TABLES, 1)), "ordinal int, sheet string")
    details = reports.merge_details(per_table, expected)
    failed = not per_table.where(F.col("error").isNotNull()).isEmpty()
    rolled_back = failed and keep_last and generations.current_generation(spark, output) is not None
    n_files = files.agg(F.countDistinct("path")).scalar()
    report = {
        "总体统计": reports.merge_summary(details, n_files, output),
        "输入文件列表": reports.input_files(files),
        "详细结果": details.orderBy("ordinal").drop("ordinal"),
        **{name: make() for name, make in reported.items()},
    }
    place = f"{output}/{ATTEMPT}" if rolled_back else f"{folder}/{REPORT}"
    with ThreadPoolExecutor(MERGES) as pool:
        list(pool.map(lambda name: write_table(report[name], f"{place}/{name}"), report))
    if rolled_back:
        delete_path(spark, folder)
    else:
        generations.publish(spark, output, folder)
    return report


def read_merged(spark: SparkSession, output: str, table: str) -> DataFrame:
    """A merged table, of the last merge that counts."""
    return generations.read_published(spark, output, table)


def read_report(spark: SparkSession, output: str, name: str) -> DataFrame:
    """A table of the report that belongs to the merged tables."""
    return generations.read_published(spark, output, f"{REPORT}/{name}")
