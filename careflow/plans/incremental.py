"""A merge that costs what changed.

The merged tables are kept by buckets of their keys, and beside them the rows that they were made from (the
state).  A merge looks up which files of a store changed since the last one, reads these, and recomputes only
the buckets that hold a key of theirs, now or before.  All other buckets stay as they are: a version is a list of
the newest folder of each bucket, and becomes current with one entry in a log.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.functions.naming import quoted
from careflow.plans import merge
from careflow.schemas import ROW_IDX, SOURCE_FILE
from careflow.sources import commits, sinks
from careflow.sources.scratch import checkpointed
from careflow.sources.sinks import PART, broadcast_if_small, write_table

BUCKET = "_bucket"
# Buckets of a table.  A rerun of one file rewrites those that its keys fall in; on a cluster thousands.
BUCKETS = 256
VERSIONS = "_versions"
_FILES = f"{SOURCE_FILE} string, {PART} string"
_BUCKETS = f"{BUCKET} int, version string, state_rows bigint, rows bigint"
_PLACES = f"{SOURCE_FILE} string, {BUCKET} int"


@dataclass(frozen=True)
class Change:
    """What a merge of one table did: files that changed or went, buckets recomputed, and rows in all."""

    files: int
    buckets: tuple[int, ...]
    rows: int


def bucket_of(df: DataFrame, keys: Sequence[str], by_day: Sequence[str], buckets: int) -> Column:
    """Rows that may be one record share a bucket; rows without a key go by file and place."""
    columns = merge.key_columns(df, keys, by_day)
    place = [F.col(c) for c in (SOURCE_FILE, ROW_IDX) if c in df.columns]
    known = F.trim(F.coalesce(F.col(quoted(keys[0])).cast("string"), F.lit(""))) != ""
    return F.pmod(F.when(known, F.xxhash64(*columns)).otherwise(F.xxhash64(*place)), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, output: str, version: str | None, table: str, name: str, schema: str) -> DataFrame:
    path = f"{output}/_manifests/{version}/{table}/{name}"
    if version is None or not sinks.holds_data(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _current(spark: SparkSession, output: str) -> tuple[str | None, int | None]:
    """Name and number of buckets of the last version."""
    entry = commits.last_entry(spark, f"{output}/{VERSIONS}")
    if entry is None:
        return None, None
    version, buckets = entry.rsplit(":", 1)
    return version, int(buckets)


def _read_buckets(
    spark: SparkSession, base: str, folders: Sequence[tuple[str, int]], schema: T.StructType
) -> DataFrame:
    """The rows of some buckets, each from the folder of the version that wrote it last."""
    kept = T.StructType([f for f in schema if f.name != BUCKET] + [T.StructField(BUCKET, T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], kept)
    paths = [f"{base}/version={version}/{BUCKET}={bucket}" for version, bucket in folders]
    return spark.read.schema(kept).option("basePath", base).parquet(*paths).select(*map(quoted, kept.names))


def _read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])).parquet(path)


def _changed_rows(spark: SparkSession, store: str, changed: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of files from the parts of the runs that wrote them; no other part is read."""
    parts = [r[0] for r in changed.select(PART).distinct().collect()]  # one per run since the last merge
    if not parts:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema, T.StructField(PART, T.StringType())])
    rows = spark.read.schema(whole).option("basePath", store).parquet(*[f"{store}/{PART}={p}" for p in parts])
    return rows.join(broadcast_if_small(changed), [SOURCE_FILE, PART], "left_semi").select(*map(quoted, schema.names))


def merge_changes(
    spark: SparkSession,
    table: str,
    store: str,
    schema: T.StructType,
    output: str,
    version: str,
    previous: str | None,
    buckets: int,
    keys: Sequence[str],
    by_day: Sequence[str],
    combine: Callable[[DataFrame], DataFrame],
) -> Change:
    """One table's part of ``version``: what changed in ``store`` since ``previous``.

    ``schema`` is that of the stored rows, ``combine`` merges rows of whole buckets and keeps column
    ``_bucket``.  Files that are no longer in the store count as changed.
    """
    log = sinks.current_files(spark, store)
    before = _manifest(spark, output, previous, table, "files", _FILES)
    changed = checkpointed(log.join(before, [SOURCE_FILE, PART], "left_anti"))
    gone = before.join(log, SOURCE_FILE, "left_anti").select(SOURCE_FILE)
    stale = checkpointed(changed.select(SOURCE_FILE).unionByName(gone))
    n_stale = stale.count()
    old_buckets = _manifest(spark, output, previous, table, "buckets", _BUCKETS)
    places = _manifest(spark, output, previous, table, "places", _PLACES)
    base = f"{output}/{table}"
    if n_stale:
        few = broadcast_if_small(stale)
        rows = _changed_rows(spark, store, changed, schema)
        rows = checkpointed(rows.withColumn(BUCKET, bucket_of(rows, keys, by_day, buckets)))
        new_places = rows.select(SOURCE_FILE, BUCKET).distinct()
        left = places.join(few, SOURCE_FILE, "left_semi").select(BUCKET)
        touched = sorted(r[0] for r in left.unionByName(new_places.select(BUCKET)).distinct().collect())  # at most ``buckets``
        held = old_buckets.where(F.col(BUCKET).isin(touched) & (F.col("state_rows") > 0)).select("version", BUCKET).collect()
        old = _read_buckets(spark, f"{base}/state", [tuple(r) for r in held], rows.schema)
        state = old.join(few, SOURCE_FILE, "left_anti").select(*map(quoted, rows.columns)).unionByName(rows)
        written = f"{base}/state/version={version}"
        state.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(written)
        again = _read_folder(spark, written, rows.drop(BUCKET).schema)
        merged = combine(again)
        target = f"{base}/merged/version={version}"
        merged.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        sizes = again.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("state_rows"))
        results = _read_folder(spark, target, T.StructType([])).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"))
        new = (
            spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int")
            .join(sizes, BUCKET, "left").join(results, BUCKET, "left").fillna(0, ["state_rows", "rows"])
            .withColumn("version", F.lit(version))
        )
        old_buckets = old_buckets.where(~F.col(BUCKET).isin(touched)).unionByName(new.select(*old_buckets.columns))
        places = places.join(few, SOURCE_FILE, "left_anti").unionByName(new_places)
    else:
        touched = []
    lists = {"files": log.select(SOURCE_FILE, PART), "buckets": old_buckets, "places": places}
    with ThreadPoolExecutor(len(lists)) as pool:
        list(pool.map(lambda name: write_table(lists[name], f"{output}/_manifests/{version}/{table}/{name}"), lists))
    total = _manifest(spark, output, version, table, "buckets", _BUCKETS)
    return Change(n_stale, tuple(touched), total.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])


def merge_incremental(
    spark: SparkSession,
    processed: str,
    schemas: Mapping[str, T.StructType],
    output: str,
    run_ts: str,
    buckets: int = BUCKETS,
) -> dict[str, Change]:
    """Bring the merged tables of ``output`` up to the stores in ``processed``, one per table.

    The result equals that of merging everything; the time of update is that of the merge that recomputed
    a row.  ``schemas`` has the stored columns of each table to merge.  The number of buckets stays what it
    was at first.  All tables become current at once; a merge that fails, or one that another overtakes,
    changes nothing (the latter raises, and can be started again).
    """
    previous, known = _current(spark, output)
    last = commits.last_position(spark, f"{output}/{VERSIONS}")
    buckets, version = known or buckets, uuid.uuid4().hex
    version = f"v-{version}"

    def one(table: str) -> Change:
        return merge_changes(
            spark, table, f"{processed}/{table}", schemas[table], output, version, previous, buckets,
            merge.KEYS[table], merge.DAY_KEYS.get(table, ()), lambda rows: merge.merged_rows(table, rows, run_ts))

    with ThreadPoolExecutor(merge.MERGES) as pool:
        changes = dict(zip(schemas, pool.map(one, schemas), strict=True))
    if commits.append(spark, f"{output}/{VERSIONS}", f"{version}:{buckets}", after=last) is None:
        raise RuntimeError(f"another merge of {output} ended meanwhile")
    return changes


def read_incremental(spark: SparkSession, output: str, table: str) -> DataFrame:
    """A merged table of the current version."""
    version, _ = _current(spark, output)
    if version is None:
        raise ValueError(f"nothing has been merged in {output}")
    held = _manifest(spark, output, version, table, "buckets", _BUCKETS).where(F.col("rows") > 0)
    folders = [(r["version"], r[BUCKET]) for r in held.collect()]  # at most one per bucket
    base = f"{output}/{table}/merged"
    if not folders:
        raise ValueError(f"{table} has no row")
    paths = [f"{base}/version={v}/{BUCKET}={b}" for v, b in folders]
    return spark.read.option("basePath", base).parquet(*paths).drop("version", BUCKET)
