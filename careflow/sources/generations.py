"""Sets of tables that are published together.

Every run writes a new generation, a folder of its own, and publishes it with one entry in a log.  Readers take
the last one published: all tables of one run, or none of it.  A run that fails leaves the set before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from careflow.sources import commits
from careflow.sources.tables import delete_path

LOG, PREFIX = "_generations", "generation-"
# Published generations that are kept: the last one, and the one that readers may still be at.
KEPT = 2


def new_generation(output: str) -> str:
    return f"{output}/{PREFIX}{uuid.uuid4().hex}"


def current_generation(spark: SparkSession, output: str) -> str | None:
    """The folder of the generation that was published last."""
    name = commits.last_entry(spark, f"{output}/{LOG}")
    return None if name is None else f"{output}/{name}"


def publish(spark: SparkSession, output: str, folder: str, kept: int = KEPT) -> int:
    """Make a generation the current one; those before the last ``kept`` are removed."""
    position = commits.append(spark, f"{output}/{LOG}", folder.rsplit("/", 1)[-1])
    ended = commits.entries(spark, f"{output}/{LOG}").orderBy("position").collect()  # one per run
    live = {r["entry"] for r in ended[-kept:]}
    for row in ended[-3 * kept:-kept]:
        if row["entry"] not in live:
            delete_path(spark, f"{output}/{row['entry']}")
    return position


def read_published(spark: SparkSession, output: str, table: str) -> DataFrame:
    """A table of the current generation."""
    folder = current_generation(spark, output)
    if folder is None:
        raise ValueError(f"nothing has been published in {output}")
    return spark.read.parquet(f"{folder}/{table}")
