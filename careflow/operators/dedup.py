"""Keep-first, duplicate detection and distinct keys.

Hot keys.  ``keep_first`` and the ``group_sizes`` family reduce each key to one row per
map task before the shuffle, so a key with a third of all rows costs one small row per
task.  Only ``with_group_size`` must bring whole groups together with their size; it
salts the hot ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.functions.naming import quoted
from careflow.operators.filters import keyed_rows
from careflow.sources.scratch import checkpointed

# A key is hot when it holds more than 1/HOT_SHARE of all rows.  There can be at most
# HOT_SHARE such keys whatever the data, which bounds what is broadcast.
HOT_SHARE = 20_000


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``; null keys are equal to each other.

    ``order`` must settle every tie.  The ``== 1`` filter becomes a WindowGroupLimit on
    both sides of the shuffle.
    """
    window = Window.partitionBy(*_columns(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def tie_break(df: DataFrame, row_key: Sequence[str] = ()) -> list[Column]:
    """Ascending row identity; without one, every sortable column.

    Rows equal in every column are interchangeable, so the fallback is deterministic too.
    """
    names = row_key or [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return [F.asc_nulls_last(quoted(c)) for c in names]


def drop_duplicate_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Whole-row distinct; ``ignore`` names the row identity, which goes."""
    return df.drop(*ignore).distinct()


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return keyed_rows(df.select(quoted(key)), key).distinct()


def group_sizes(df: DataFrame, keys: Sequence[str | Column], *extra: Column) -> DataFrame:
    """Rows per key, and any further aggregates; partial sums are made before the shuffle."""
    return df.groupBy(*_columns(keys)).agg(F.count("*").alias("group_size"), *extra)


def duplicate_groups(
    df: DataFrame, keys: Sequence[str], *extra: Column, keep_null_keys: bool = False
) -> DataFrame:
    """Keys held by more than one row."""
    rows = df if keep_null_keys else keyed_rows(df, *keys)
    return group_sizes(rows, keys, *extra).filter("group_size > 1")


def removed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows a keep-first on ``keys`` removes, without doing it."""
    removed = F.coalesce(F.sum(F.col("group_size") - 1), F.lit(0).cast("bigint"))
    return group_sizes(df, keys).agg(removed.alias("removed_rows"))


def with_group_size(
    df: DataFrame, keys: Sequence[str], row_key: Sequence[str] = (), hot_share: int = HOT_SHARE, least: int = 1
) -> DataFrame:
    """Every row with the size of its key's group, nulls being equal to each other; only rows of
    groups of ``least`` rows or more.

    ``count(*) OVER (PARTITION BY keys)`` would bring a whole group into one task.
    Sizes are aggregated first, then joined back; rows of hot keys are spread over as
    many salts as the key has shares of 1/``hot_share``: by ``row_key`` if there is one, else one
    after another, so that equal rows are spread as well.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    sizes = group_sizes(df, [F.col(quoted(k)).alias(n) for k, n in zip(keys, names)])
    total = sizes.agg(F.sum("group_size")).scalar()
    splits = F.ceil(F.col("group_size") * F.lit(hot_share) / total).cast("int")
    hot = sizes.filter(F.col("group_size") * hot_share > total).select(
        *[F.col(n).alias(f"h{n}") for n in names], splits.alias("_splits")
    )
    salted_sizes = sizes.filter(F.col("group_size") >= least).select(
        *names,
        "group_size",
        F.explode(
            F.when(F.col("group_size") * hot_share > total, F.sequence(F.lit(0), splits - 1))
            .otherwise(F.array(F.lit(0)))
        ).alias("_salt_of_key"),
    )
    on_hot = [F.col(quoted(k)).eqNullSafe(F.col(f"h{n}")) for k, n in zip(keys, names)]
    marked = df.join(F.broadcast(hot), on_hot, "left")
    if row_key:
        place = F.xxhash64(*[F.col(quoted(c)) for c in row_key])
        rows = marked.withColumn("_salt", F.coalesce(F.pmod(place, F.col("_splits")).cast("int"), F.lit(0)))
    else:
        rows = _running_salts(marked)
    on_key = [F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    joined = rows.join(salted_sizes, [*on_key, F.col("_salt") == F.col("_salt_of_key")], "inner")
    return joined.select(*[F.col(quoted(c)) for c in df.columns], "group_size")


def _running_salts(marked: DataFrame) -> DataFrame:
    """Salts dealt out one after another within each task.

    The rows of hot keys are settled first: a task that runs again must deal the same salts.
    """
    cold = marked.filter(F.col("_splits").isNull()).withColumn("_salt", F.lit(0))
    hot = checkpointed(marked.filter(F.col("_splits").isNotNull()))
    dealt = F.pmod(F.monotonically_increasing_id(), F.col("_splits")).cast("int")
    return cold.unionByName(hot.withColumn("_salt", dealt))


def duplicate_members(
    df: DataFrame, keys: Sequence[str], row_key: Sequence[str] = ()
) -> DataFrame:
    """Audit of duplicates: every row whose (known) key is held by several rows."""
    rows = keyed_rows(df, *keys)
    return with_group_size(rows, keys, row_key, least=2)


def latest_sorted(df: DataFrame, date: str, row_key: Sequence[str], n: int | None = None) -> DataFrame:
    """Newest first, unknown dates last, ties by row key; ``n`` keeps the top of the report."""
    ordered = df.orderBy(F.desc_nulls_last(quoted(date)), *tie_break(df, row_key))
    return ordered if n is None else ordered.limit(n)


def _columns(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(quoted(k)) if isinstance(k, str) else k for k in keys]
