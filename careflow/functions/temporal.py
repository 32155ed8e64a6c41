"""Date parsing and rendering.  All times are TIMESTAMP_NTZ: hospital wall-clock time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow import vocab
from careflow.functions.naming import quoted

# Text layouts rewritten to year-month-day before the cast, as (pattern, replacement).
TEXT_LAYOUTS = (
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})(?=$|[ T])", "$1-$2-$3"),
)
_ISO_DAY = r"^\d{4}-\d{1,2}-\d{1,2}(?:[ T]|$)"


def parse_text_timestamp(
    text: Column, layouts: Sequence[tuple[str, str]] = TEXT_LAYOUTS
) -> Column:
    """Lenient parse: text in none of the known layouts becomes null."""
    iso = _iso(text, layouts)
    return F.when(iso.rlike(_ISO_DAY), iso.try_cast(T.TimestampNTZType()))


def _iso(text: Column, layouts: Sequence[tuple[str, str]] = TEXT_LAYOUTS) -> Column:
    iso = F.trim(text)
    for pattern, replacement in layouts:
        iso = F.regexp_replace(iso, pattern, replacement)
    return iso


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Column ``name`` as TIMESTAMP_NTZ, parsing only where it is text."""
    column, dtype = F.col(quoted(name)), df.schema[name].dataType
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return column.cast(T.TimestampNTZType())
    return parse_text_timestamp(column.cast("string"))


def render_timestamp(ts: Column) -> Column:
    """Null gives '', midnight gives the day alone, anything else day and time."""
    day = ts.cast("date")
    return (
        F.when(ts.isNull(), F.lit(""))
        .when(ts == day.cast(T.TimestampNTZType()), day.cast("string"))
        .otherwise(F.substring(ts.cast("string"), 1, 19))
    )


def render_date_columns(
    df: DataFrame, name_keywords: Sequence[str] = vocab.DATE_COLUMN_NAMES
) -> DataFrame:
    """Render every column whose *name* marks it as a visit, admission or order date."""
    rendered = {
        c: render_timestamp(as_timestamp(df, c))
        for c in df.columns
        if any(k in c for k in name_keywords)
    }
    return df.withColumns(rendered) if rendered else df


def unparsable_dates(df: DataFrame, name: str) -> Column:
    """Aggregate: how many non-blank values of ``name`` are not dates."""
    text = F.col(quoted(name)).cast("string")
    return F.count_if(as_timestamp(df, name).isNull() & (F.trim(text) != ""))


NO_LAYOUT, NO_DAY = "no known layout", "no such day or time"


def date_problem(df: DataFrame, name: str) -> Column:
    """Why a non-blank value of ``name`` is not a date; null if it is one, or blank."""
    text = F.col(quoted(name)).cast("string")
    unread = as_timestamp(df, name).isNull() & (F.trim(text) != "")
    return F.when(unread, F.when(_iso(text).rlike(_ISO_DAY), NO_DAY).otherwise(NO_LAYOUT))


def rejected_dates(df: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per value of the columns ``names`` that is not a date: ``column, text, reason`` beside the
    columns ``keep`` of its row.  All columns are judged in one scan; a column that is not there has none."""
    judged = [
        F.struct(F.lit(n).alias("column"), F.col(quoted(n)).cast("string").alias("text"), date_problem(df, n).alias("reason"))
        for n in names if n in df.columns]
    if not judged:
        return df.select(*map(quoted, keep), *[F.lit(None).cast("string").alias(c) for c in ("column", "text", "reason")]).limit(0)
    bad = F.filter(F.array(*judged), lambda v: v["reason"].isNotNull())
    return df.select(*map(quoted, keep), F.inline(bad))
