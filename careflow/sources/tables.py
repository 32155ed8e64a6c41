"""Column-file inputs, required-input checks and skip reasons."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    pattern: str | None = None,
    clean: bool = False,
) -> DataFrame:
    """One input table from one or many files, each row with where it came from.

    Columns are matched by name, whatever the files' headers (``headers.read_files``); with ``schema`` the
    result has its columns, and values that are not of its types are null.  Without one types are never
    inferred: text such as ``030`` must stay text.  Row numbers exist for Parquet only; elsewhere ties are
    settled by content.  A path that is missing or a file that can't be read is an error.
    """
    from careflow.sources import headers  # which needs the paths of this module

    found = headers.read_files(spark, paths, fmt, pattern, clean)
    lost = [entry for entry in found.skipped if entry[1] != "empty"]
    if lost:
        raise ValueError(f"{len(lost)} inputs cannot be read, the first: {': '.join(x for x in lost[0] if x)}")
    return found.rows if schema is None else headers.on_schema(found.rows, schema)


def literal_path(path: str) -> str:
    """A path that is read as it is, though its name holds characters of a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def hadoop_path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, or any that fits the path's pattern."""
    fs, place = hadoop_path(spark, path)
    return bool(fs.globStatus(place))


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether a directory holds anything but markers and logs, such as ``_SUCCESS``."""
    fs, place = hadoop_path(spark, path)
    return fs.exists(place) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(place)
    )


def delete_path(spark: SparkSession, path: str) -> None:
    fs, place = hadoop_path(spark, path)
    fs.delete(place, True)


def missing_inputs(present: DataFrame, files: DataFrame, required: DataFrame) -> DataFrame:
    """(file, sheet) pairs that are required but not there.

    ``present`` has (file, sheet), ``files`` has file, ``required`` has sheet: the short,
    fixed list of sheets, which becomes an array on each file.
    """
    wanted = required.agg(F.collect_set("sheet")).scalar()
    expected = files.select("file", F.explode(wanted).alias("sheet"))
    return expected.join(present, ["file", "sheet"], "left_anti")


def skip_reasons(
    files: DataFrame, table_files: DataFrame, row_counts: DataFrame, on: Sequence[str] = ("file",)
) -> DataFrame:
    """Why a file adds nothing to a table.

    ``files``: (file, exists, error); ``table_files``: (file) that hold the table;
    ``row_counts``: (file, rows).  Files that add rows are not listed.  With (file, sheet)
    in ``on`` all tables are judged at once.
    """
    keys = list(on)
    joined = (
        files.join(table_files.select(*keys, F.lit(True).alias("has_table")), keys, "left")
        .join(row_counts, keys, "left")
    )
    reason = (
        F.when(~F.col("exists"), F.lit("missing file"))
        .when(F.col("error").isNotNull(), F.lit("unreadable"))
        .when(F.col("has_table").isNull(), F.lit("missing sheet"))
        .when(F.coalesce("rows", F.lit(0)) == 0, F.lit("empty"))
    )
    return joined.select(*keys, reason.alias("reason")).filter(F.col("reason").isNotNull())
