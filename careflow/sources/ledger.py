"""Which files of a folder are new, changed or gone since they were last processed.

The ledger has path, length and time of change of each processed file; it is a table store like any other.  A
listing is compared with it before any file is opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.schemas import SOURCE_FILE
from careflow.sources.sinks import read_store, upsert_files
from careflow.sources.tables import holds_data

NAME = "_ledger"
SCHEMA = f"{SOURCE_FILE} string, length bigint, modified timestamp"
NEW, CHANGED, GONE, SAME = "new", "changed", "gone", "same"


def compare(listing: DataFrame, known: DataFrame) -> DataFrame:
    """``path, change`` for every file of ``listing`` (``path, length, modificationTime``) and of ``known``
    (``_source_file, length, modified``): new, changed, gone or same.

    A file is the same if it has the length and the time of change that it had.  Of a path that is listed
    twice the newest counts.
    """
    seen = listing.groupBy("path").agg(
        F.max(F.struct("modificationTime", "length")).alias("now"))
    before = known.groupBy(F.col(SOURCE_FILE).alias("path")).agg(F.max(F.struct("modified", "length")).alias("then"))
    change = (
        F.when(F.col("then").isNull(), NEW).when(F.col("now").isNull(), GONE)
        .when((F.col("now.length") == F.col("then.length")) & (F.col("now.modificationTime") == F.col("then.modified")), SAME)
        .otherwise(CHANGED)
    )
    return seen.join(before, "path", "full").select("path", change.alias("change"))


def read_ledger(spark: SparkSession, output: str) -> DataFrame:
    path = f"{output}/{NAME}"
    schema = spark.createDataFrame([], SCHEMA).schema
    return read_store(spark, path, schema) if holds_data(spark, path) else spark.createDataFrame([], schema)


def remember(listing: DataFrame, output: str, run: str) -> None:
    """Note files as processed, as they were when they were listed; ``run`` must be new."""
    rows = listing.select(
        F.col("path").alias(SOURCE_FILE), F.col("length").cast("bigint").alias("length"),
        F.col("modificationTime").cast("timestamp").alias("modified"))
    upsert_files(rows, rows, f"{output}/{NAME}", run)


def to_process(comparison: DataFrame) -> Sequence[str]:
    """The paths that a run has to open: as many as files changed, for the reader's list of inputs."""
    return sorted(r["path"] for r in comparison.where(F.col("change").isin(NEW, CHANGED)).select("path").collect())
