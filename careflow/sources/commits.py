"""A log of numbered entries, each made by one writer only: what makes a change visible all at once.

An entry is one small file whose name is its number.  It is written under another name first and then put in
its place if the place is free, which succeeds for one writer; the others go on to the next number.
File systems with an atomic rename that does not overwrite (HDFS) and local or mounted ones (by a hard
link) have this; object stores that copy in place of renaming do not.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.sources.tables import hadoop_path

ENTRIES = "position bigint, entry string"
# Numbers have so many digits, so that names sort as numbers do.
DIGITS = 12


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, place = hadoop_path(spark, folder)
    if not fs.exists(place):
        return []
    return sorted(n for s in fs.listStatus(place) if (n := s.getPath().getName()).isdigit())


def last_position(spark: SparkSession, folder: str) -> int:
    """The number of the last entry, 0 if there is none."""
    return int((_names(spark, folder) or ["0"])[-1])


def _put_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    fs, here = hadoop_path(spark, source)
    _, there = hadoop_path(spark, target)
    if fs.getUri().getScheme() == "file":
        # A local rename would overwrite.
        try:
            os.link(here.toUri().getPath(), there.toUri().getPath())
        except FileExistsError:
            return False
        return True
    return not fs.exists(there) and fs.rename(here, there)


def append(spark: SparkSession, folder: str, entry: str, after: int | None = None) -> int | None:
    """Add an entry, one line, at the first free place and return its number.

    With ``after`` only the place right after that number will do: None says that someone else was first,
    and nothing has been added.
    """
    if "\n" in entry or not entry:
        raise ValueError("an entry is one line")
    fs, place = hadoop_path(spark, folder)
    fs.mkdirs(place)
    draft = f"{folder}/_{uuid.uuid4().hex}"
    _, path = hadoop_path(spark, draft)
    out = fs.create(path, True)
    out.write(bytearray(entry.encode("utf-8")))
    out.close()
    try:
        position = (last_position(spark, folder) if after is None else after) + 1
        while not _put_if_absent(spark, draft, f"{folder}/{position:0{DIGITS}}"):
            if after is not None:
                return None
            position += 1
        return position
    finally:
        fs.delete(path, False)


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """``position, entry`` of all entries."""
    if not _names(spark, folder):
        return spark.createDataFrame([], ENTRIES)
    lines = spark.read.option("wholetext", True).text(folder)
    return lines.select(F.col("_metadata.file_name").cast("bigint").alias("position"), F.col("value").alias("entry"))


def last_entry(spark: SparkSession, folder: str) -> str | None:
    names = _names(spark, folder)
    if not names:
        return None
    return spark.read.option("wholetext", True).text(f"{folder}/{names[-1]}").first()["value"]
