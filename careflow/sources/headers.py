"""Many files of one table whose headers differ in names, order or types.

Each header is read once, files of one header are one scan, and scans are put together by name.
Parquet files whose schemas go together need no groups: Spark merges them in a single scan.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.functions.naming import clean_name, quoted
from careflow.operators.projection import as_text
from careflow.operators.union import outer_union
from careflow.schemas import ROW_IDX, SOURCE_FILE
from careflow.shipping import ship
from careflow.sources.tables import literal_path, path_exists

# One file to a partition, whatever its size: a header is at a file's beginning.
WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 60), "spark.sql.files.openCostInBytes": str(1 << 60)}
# Footers that are read at the same time.
READERS = 16
# A schema that can't be read fails while a frame is made, in a job of Spark's own.
FAILURES = (PySparkException, Py4JJavaError)


@dataclass
class FileSet:
    """What was read of many files: the rows, and why a file gave none (file, reason, error)."""

    rows: DataFrame
    skipped: list[tuple[str, str, str | None]] = field(default_factory=list)


def unique_names(names: Sequence[str], clean: bool = False) -> tuple[str, ...]:
    """Names for the columns of one header: blank ones by place, repeated ones (Spark does not tell cases
    apart) with a number."""
    found: list[str] = []
    taken: set[str] = set()
    for i, raw in enumerate(names):
        base = clean_name(raw) if clean else raw
        base = name = base if base.strip() else f"_c{i}"
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        found.append(name)
    return tuple(found)


def file_names(spark: SparkSession, paths: Sequence[str], pattern: str | None = None) -> list[str]:
    """All files in ``paths``, empty ones too, from the listing alone."""
    reader = spark.read.format("binaryFile")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return sorted({_plain(f) for f in reader.load(list(paths)).inputFiles()})


def plain_path(uri: Column) -> Column:
    """As ``file_names`` names a file, from the name that rows carry."""
    # A plus sign is one in a path, unlike in a query.
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def _plain(uri: str) -> str:
    """A file's URI as a path: ``file:/a b`` for ``file:///a%20b``."""
    return re.sub(r"^file:/+", "file:/", unquote(uri))


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the lines of one file the first that is not blank; the rest is not read."""
    for batch in batches:
        for i, value in enumerate(batch.column(1)):
            if (value.as_py() or "").strip("﻿ \t\r"):
                yield batch.slice(i, 1)
                return


def text_headers(
    spark: SparkSession, paths: Sequence[str], pattern: str | None = None, sep: str = ",", quote: str = '"'
) -> list[tuple[str, list[str]]]:
    """(file, header) of each text file that has a line; each is opened in a task of its own.

    A header is one line.  What comes to the driver is one line per file.
    """
    ship(spark)
    session = spark.newSession()
    for name, value in WHOLE_FILES.items():
        session.conf.set(name, value)
    reader = session.read.format("text")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.load(list(paths)).select(F.col("_metadata.file_path").alias("file"), "value")
    found = lines.mapInArrow(_first_line, "file string, value string").collect()
    return sorted(
        (_plain(r["file"]), next(csv.reader([r["value"].lstrip("﻿")], delimiter=sep, quotechar=quote))) for r in found)


def file_schemas(
    spark: SparkSession, files: Sequence[str], fmt: str = "parquet"
) -> tuple[list[tuple[str, T.StructType]], list[tuple[str, str]]]:
    """The schema of each file, and (file, error) of each that has none; footers are read side by side."""
    def schema(path: str) -> T.StructType | str:
        try:
            return spark.read.format(fmt).load(literal_path(path)).schema
        except FAILURES as problem:
            return _reason(problem)

    with ThreadPoolExecutor(READERS) as pool:
        found = list(zip(files, pool.map(schema, files)))
    return ([(f, s) for f, s in found if isinstance(s, T.StructType)], [(f, s) for f, s in found if isinstance(s, str)])


def _reason(problem: Exception) -> str:
    """The line of a failure that names its cause."""
    lines = [line.strip() for line in str(problem).splitlines()]
    return next((line for line in reversed(lines) if line.startswith("Caused by: ")), lines[0])


def _identified(df: DataFrame, names: Sequence[str], fmt: str) -> DataFrame:
    """Columns under their new names, with where each row came from."""
    identity = {SOURCE_FILE: F.col("_metadata.file_path")}
    if fmt == "parquet":
        identity[ROW_IDX] = F.col("_metadata.row_index")
    own = zip(df.columns, names, strict=True)
    return df.select(*[F.col(quoted(c)).alias(n) for c, n in own], *[c.alias(n) for n, c in identity.items()])


def _grouped(headers: Sequence[tuple[str, object]]) -> dict[object, list[str]]:
    """Files by header, in order of each header's first file."""
    groups: dict[object, list[str]] = {}
    for file, header in headers:
        groups.setdefault(header, []).append(literal_path(file))
    return groups


def _one_spelling(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """A name is spelled as where it comes first; unions by name do not tell cases apart."""
    spelled: dict[str, str] = {}
    for frame in frames:
        for name in frame.columns:
            spelled.setdefault(name.lower(), name)
    return [f.toDF(*[spelled[c.lower()] for c in f.columns]) for f in frames]


def _read_text(
    spark: SparkSession, paths: Sequence[str], pattern: str | None, clean: bool, options: dict[str, str]
) -> FileSet:
    sep, quote = options.get("sep", ","), options.get("quote", '"')
    headers = text_headers(spark, paths, pattern, sep, quote)
    with_lines = {file for file, _ in headers}
    skipped = [(file, "empty", None) for file in file_names(spark, paths, pattern) if file not in with_lines]
    frames = []
    for names, files in _grouped([(f, unique_names(h, clean)) for f, h in headers]).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        frame = spark.read.schema(schema).options(header=True, **options).csv(files)
        frames.append(_identified(frame, names, "csv"))
    if not frames:
        return FileSet(spark.createDataFrame([], f"{SOURCE_FILE} string"), skipped)
    return FileSet(outer_union(_one_spelling(frames)), skipped)


def _merged(spark: SparkSession, paths: Sequence[str], fmt: str, pattern: str | None, clean: bool) -> DataFrame | None:
    """All files as one scan, if their schemas go together and no two columns are to be one."""
    reader = spark.read.format(fmt).option("mergeSchema", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        frame = reader.load(list(paths))
    except FAILURES:
        return None
    names = [clean_name(c) if clean else c for c in frame.columns]
    if len({n.lower() for n in names}) < len(names) or not all(names):
        return None
    return _identified(frame, names, fmt)


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "parquet",
    pattern: str | None = None,
    clean: bool = False,
    **options: str,
) -> FileSet:
    """The rows of many files as one table, by column name, and the files that gave none.

    Files may differ in which columns they have, in their order and in their types: a column that a file
    lacks is null there, one whose types differ becomes text.  With ``clean`` names are cleaned first, so
    that ``" pid"`` and ``"pid"`` are one column.  Names that differ only in case are one.  Text is never
    read as numbers.  Paths that are not there, files that can't be read and files without a line are
    left out and named in ``skipped``; a file with a header and no row gives no row.

    ``csv`` is one scan for each distinct header, ``parquet`` and ``orc`` one scan in all if the schemas go
    together, else one for each distinct schema; other formats name their columns in each row.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    there = [p for p in wanted if path_exists(spark, p)]
    missing = [(p, "missing file", None) for p in wanted if p not in there]
    if not there:
        return FileSet(spark.createDataFrame([], f"{SOURCE_FILE} string"), missing)
    if fmt == "csv":
        found = _read_text(spark, there, pattern, clean, options)
    elif (whole := _merged(spark, there, fmt, pattern, clean)) is not None:
        found = FileSet(whole)
    else:
        schemas, problems = file_schemas(spark, file_names(spark, there, pattern), fmt)
        frames = []
        for names, group in _grouped([(f, (s.simpleString(), s)) for f, s in schemas]).items():
            schema = names[1]
            frame = spark.read.format(fmt).schema(schema).load(group)
            frames.append(_identified(frame, unique_names(schema.names, clean), fmt))
        rows = outer_union(_one_spelling(frames)) if frames else spark.createDataFrame([], f"{SOURCE_FILE} string")
        found = FileSet(rows, [(file, "unreadable", error) for file, error in problems])
    return FileSet(found.rows, missing + found.skipped)


def on_schema(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name, with its types; null where ``rows`` lacks one."""
    have = {c.lower(): c for c in rows.columns}
    own = []
    for f in schema:
        if f.name.lower() not in have:
            value = F.lit(None)
        elif isinstance(f.dataType, T.StringType):
            value = as_text(rows, have[f.name.lower()])
        else:
            value = F.col(quoted(have[f.name.lower()])).try_cast(f.dataType)
        own.append(value.cast(f.dataType).alias(f.name))
    identity = [c for c in (SOURCE_FILE, ROW_IDX) if c in rows.columns and c not in schema.names]
    return rows.select(*own, *identity)
