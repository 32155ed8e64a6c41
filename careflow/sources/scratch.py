"""Intermediate results, in a folder that all machines of the session share."""

from __future__ import annotations

import uuid

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from careflow.sources.tables import delete_path

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``.

    A local session may do without: it has one machine, and Spark's own folder of the session, which
    goes when the session ends, serves.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or context.getConf().get(SETTING)
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all machines share")
    return f"{SparkFiles.getRootDirectory()}/careflow"


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/careflow-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, computed once and written to the shared folder; partitions stay as they are."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def without_folder(df: DataFrame, folder: str) -> DataFrame:
    """``df`` settled, after which the folder it was read from is removed."""
    settled = checkpointed(df)
    delete_path(df.sparkSession, folder)
    return settled
