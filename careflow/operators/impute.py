"""Missing-value imputation: default, mean, median and mode.

Statistics enter the plan as scalar subqueries of one row, or as literals where they are picked
beforehand: one median or mode per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.functions.naming import quoted
from careflow.operators.running import with_total_before
from careflow.schemas import ROW_ID


# An approximate median is off by at most one in so many ranks.
ACCURACY = 10_000


def fill_missing(df: DataFrame, strategy: str = "default", accuracy: int = ACCURACY) -> DataFrame:
    """Fill nulls.  Text is filled with '' unless the strategy is ``mode``.

    ``median_approx`` takes a value of the column whose rank is within 1/``accuracy`` of the middle; it
    shuffles one small summary per task where ``median`` shuffles all distinct values.
    """
    if strategy == "mode":
        return _fill_mode(df)
    numeric, text = _columns_of(df, T.NumericType), _columns_of(df, T.StringType)
    if strategy == "default":
        filled = df.fillna(0, subset=numeric) if numeric else df
    elif strategy == "mean":
        filled = _fill_mean(df, numeric)
    elif strategy == "median":
        filled = _fill_median(df, numeric)
    elif strategy == "median_approx":
        filled = _fill_approximately(df, numeric, accuracy)
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    return filled.fillna("", subset=text) if text else filled


def _columns_of(df: DataFrame, kind: type) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kind) and f.name not in ROW_ID]


def _known(df: DataFrame, column: str) -> Column:
    """The column with NaN, which also means missing, turned into null."""
    value, dtype = F.col(quoted(column)), df.schema[column].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(value, F.lit(None).cast(dtype))
    return value


def _fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    if not columns:
        return df
    # A column with fractional fill values becomes fractional.
    known = {c: _known(df, c).cast("double") for c in columns}
    stats = df.agg(
        F.struct(*[F.avg(known[c]).alias(f"c{i}") for i, c in enumerate(columns)]).alias("s")
    ).scalar()
    return df.withColumns(
        {c: F.coalesce(known[c], stats.getField(f"c{i}")) for i, c in enumerate(columns)}
    )


def _counts(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Number of rows, and of known values per column: one pass, one row."""
    found = df.agg(F.count("*"), *[F.count(_known(df, c)) for c in columns]).first()
    return found[0], dict(zip(columns, found[1:]))


def _fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    if not columns:
        return df
    total, known = _counts(df, columns)
    # A column without gaps needs no statistic.
    medians = exact_medians(df, [c for c in columns if known[c] < total], known)
    return df.withColumns(
        {c: F.coalesce(_known(df, c).cast("double"), F.lit(medians.get(c)).cast("double"))
         for c in columns}
    )


def approximate_medians(df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """One row with a value of each column near its middle, null for a column without values.

    Of n known values the rank of the result is within n / ``accuracy`` of n / 2.  Tasks summarise their rows
    in some multiple of ``accuracy`` values a column, and summaries are merged; one scan for all columns.
    """
    return df.agg(*[
        F.percentile_approx(_known(df, c).cast("double"), 0.5, accuracy).alias(c) for c in columns])


def _fill_approximately(df: DataFrame, columns: Sequence[str], accuracy: int) -> DataFrame:
    if not columns:
        return df
    medians = approximate_medians(df, columns, accuracy).first()
    return df.withColumns(
        {c: F.coalesce(_known(df, c).cast("double"), F.lit(medians[c]).cast("double")) for c in columns})


def exact_medians(
    df: DataFrame, columns: Sequence[str], counts: Mapping[str, int] | None = None
) -> dict[str, float | None]:
    """Exact interpolated medians of several columns, null for a column without values.

    ``median`` keeps every distinct value in one task.  Here the distinct values of all columns are
    counted in one scan, partial counts before the shuffle, and dealt out by ranges with running
    totals; the rows that hold the middle ranks, at most two a column, reach the driver.  ``counts``
    are the known values per column, where the caller has them.
    """
    if not columns:
        return {}
    counts = _counts(df, columns)[1] if counts is None else counts
    values = F.array(*[_known(df, c).cast("double") for c in columns])
    frequencies = (
        df.select(F.posexplode(values).alias("_column", "_value")).filter(F.col("_value").isNotNull())
        .groupBy("_column", "_value").agg(F.count("*").alias("_n"))
    )
    wanted, start = {}, 0
    for c in columns:
        wanted[c] = [start + r for r in {(counts[c] - 1) // 2, counts[c] // 2}] if counts[c] else []
        start += counts[c]
    ranks = sorted({r for own in wanted.values() for r in own})
    if not ranks:
        return dict.fromkeys(columns)
    before, after = F.col("_before"), F.col("_before") + F.col("_n")
    held = F.filter(F.array(*map(F.lit, ranks)), lambda r: (r >= before) & (r < after))
    totals = with_total_before(frequencies, ["_column", "_value"], F.col("_n"))
    at_rank = {
        row["rank"]: row["_value"] for row in totals.select("_value", F.explode(held).alias("rank")).collect()
    }
    return {c: sum(at_rank[r] for r in own) / len(own) if own else None for c, own in wanted.items()}


def _fill_mode(df: DataFrame) -> DataFrame:
    """Most frequent value of every column, the smallest on ties; '' where there is none.

    One scan per type counts the values of all columns of that type that have gaps, partial counts
    before the shuffle, then one row is kept per column.  Columns without gaps, such as unique keys,
    are never shuffled.
    """
    columns = [c for c in df.columns if c not in ROW_ID]
    if not columns:
        return df
    total, known = _counts(df, columns)
    by_type: dict[str, list[str]] = {}
    for c in columns:
        if known[c] < total:
            by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    filled = {}
    for own in by_type.values():
        for c, mode in _modes(df, own).items():
            value = F.coalesce(_known(df, c), mode)
            if isinstance(df.schema[c].dataType, T.StringType):
                value = F.coalesce(value, F.lit(""))
            filled[c] = value
    return df.withColumns(filled) if filled else df


def _modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """The most frequent value of each column, all of one type: one row per column."""
    values = F.array(*[_known(df, c) for c in columns])
    best = (
        df.select(F.posexplode(values).alias("place", "value")).filter(F.col("value").isNotNull())
        .groupBy("place", "value").agg(F.count("*").alias("n"))
        .groupBy("place").agg(F.min(F.struct((-F.col("n")).alias("n"), "value"))["value"].alias("value"))
    )
    dtype = df.schema[columns[0]].dataType
    if isinstance(dtype, (T.NumericType, T.StringType, T.BooleanType)):
        # A literal each: a wide table would repeat the whole count in the plan of every column.
        found = {r["place"]: r["value"] for r in best.collect()}
        return {c: F.lit(found.get(i)).cast(dtype) for i, c in enumerate(columns)}
    modes = best.agg(F.map_from_entries(F.collect_list(F.struct("place", "value")))).scalar()
    return {c: F.try_element_at(modes, F.lit(i)) for i, c in enumerate(columns)}
