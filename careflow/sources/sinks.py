"""Table store: runs are appended, and a log says which run is the current one of each file.

A table is one directory with a part per run, and beside them the files of each run (``_files``) and the log
of runs (``_commits``).  A rerun of some files adds their rows, its list of files and then one numbered
entry, with which it becomes current; nothing that is there is read or written again, whatever the store
holds.  Writers need not know of each other: each has folders of its own, and numbers are given once.  Readers
take of each file the rows of its last run.  ``compact_store`` rewrites a store without rows that are out of
date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.schemas import SOURCE_FILE
from careflow.sources import commits
from careflow.sources.tables import delete_path, holds_data

# A part's name: the mark keeps a run of digits from being read as a number.
PART, MARK = "careflow_run", "run-"
LOG, COMMITS = "_files", "_commits"
LOG_SCHEMA = f"{SOURCE_FILE} string, {PART} string, position bigint"
# Paths are a few hundred bytes at most: some megabytes in all.  More of them are joined by shuffle.
MAX_BROADCAST_FILES = 20_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_FILES) -> DataFrame:
    """Broadcast a list of keys when a count shows that it is short; else leave it to AQE."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def file_log(spark: SparkSession, path: str) -> DataFrame:
    """(file, part, position) of all files of all runs that ended; empty where the table was never written."""
    place = f"{path}/{LOG}"
    if not holds_data(spark, place):
        return spark.createDataFrame([], LOG_SCHEMA)
    runs = broadcast_if_small(commits.entries(spark, f"{path}/{COMMITS}").withColumnRenamed("entry", PART))
    lines = spark.read.schema(f"{SOURCE_FILE} string, {PART} string").parquet(place)
    return lines.join(runs, PART).select(SOURCE_FILE, PART, "position")


def current_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, part): the last run of each file."""
    return file_log(spark, path).groupBy(SOURCE_FILE).agg(F.max_by(PART, "position").alias(PART))


def read_store(
    spark: SparkSession, path: str, schema: T.StructType | None = None, run: str | None = None
) -> DataFrame:
    """The current rows of a stored table, or the rows that one run wrote.

    With its schema a table that never had a row can be read too.
    """
    if schema is None:
        # Runs may differ in columns: a later one can have a column more.
        df = spark.read.option("mergeSchema", True).parquet(path)
    else:
        df = spark.read.schema(T.StructType([*schema, T.StructField(PART, T.StringType())])).parquet(path)
    if run is not None:
        return df.filter(F.col(PART) == MARK + run).drop(PART)
    current = broadcast_if_small(current_files(spark, path))
    return df.join(current, [SOURCE_FILE, PART], "left_semi").select(*[c for c in df.columns if c != PART])


def upsert_files(
    df: DataFrame, files: DataFrame, path: str, run: str, after: int | None = None
) -> int | None:
    """Replace what the table at ``path`` holds of ``files`` by ``df``, as run ``run``; returns its number.

    ``files`` lists every processed ``_source_file``, also those without rows now.  Rows become current
    with the entry in the log that is made last, so a run that fails in between has changed nothing, and
    any number of writers may be at work: of a file that two of them bring, the one that ends last counts.
    A run's name must be new.  With ``after`` the run only counts if no other ended since that number; else
    None is returned and nothing has changed.
    """
    spark = df.sparkSession
    part = MARK + run
    if not commits.entries(spark, f"{path}/{COMMITS}").where(F.col("entry") == part).isEmpty():
        raise ValueError(f"{path} already holds run {run}")
    # What a run of this name left when it failed goes.
    df.hint("rebalance").write.mode("overwrite").parquet(f"{path}/{PART}={part}")
    files.select(SOURCE_FILE).distinct().write.mode("overwrite").parquet(f"{path}/{LOG}/{PART}={part}")
    position = commits.append(spark, f"{path}/{COMMITS}", part, after)
    if position is None:
        delete_path(spark, f"{path}/{PART}={part}")
        delete_path(spark, f"{path}/{LOG}/{PART}={part}")
    return position


def compact_store(spark: SparkSession, path: str, run: str, schema: T.StructType | None = None) -> bool:
    """Rewrite the current rows as one run and remove the parts of earlier runs.

    False, and nothing done, if another run ended meanwhile: its rows would be lost under older ones.
    """
    last = commits.last_position(spark, f"{path}/{COMMITS}")
    current = current_files(spark, path).select(SOURCE_FILE)
    earlier = [r[0] for r in commits.entries(spark, f"{path}/{COMMITS}").select("entry").collect()]  # one per run
    if upsert_files(read_store(spark, path, schema), current, path, run, after=last) is None:
        return False
    for part in earlier:
        delete_path(spark, f"{path}/{PART}={part}")
    return True


def write_table(df: DataFrame, path: str) -> int:
    """Whole-table overwrite; an empty table keeps its schema.  Returns the rows, counted as they are written."""
    counted = Observation()
    rows = df.hint("rebalance").observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(path)
    return counted.get["rows"]
