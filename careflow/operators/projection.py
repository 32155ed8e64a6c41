"""Projections onto a target header: exact-name alignment and keyword-rule mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow import vocab
from careflow.functions.naming import clean_name, clean_names, locate, quoted
from careflow.functions.temporal import as_timestamp, parse_text_timestamp, render_timestamp
from careflow.schemas import ROW_ID, SOURCE_RANK, target_type


def lineage(df: DataFrame) -> list[str]:
    """The row-identity columns that this frame carries."""
    return [c for c in ROW_ID if c in df.columns]


def as_text(df: DataFrame, name: str) -> Column:
    """Column as text; whole floating-point numbers lose their ``.0`` (IDs stay IDs)."""
    column, dtype = F.col(quoted(name)), df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        whole = (column == F.floor(column)) & (F.abs(column) < 1e15)
        return F.when(whole, column.cast("bigint").cast("string")).otherwise(
            F.nanvl(column, F.lit(None).cast("double")).cast("string")
        )
    return column.cast("string")


def with_source_rank(df: DataFrame, rank: int) -> DataFrame:
    """Mark which input a row came from, so that a union keeps its order."""
    return df.withColumn(SOURCE_RANK, F.lit(rank))


def typed(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return as_text(df, name)
    return F.col(quoted(name)).try_cast(dtype)


def is_date_column(name: str) -> bool:
    return any(k in name for k in vocab.DATE_COLUMN_NAMES)


def target_value(df: DataFrame, source: str | None, target: str) -> Column:
    """Column ``source`` in the form that ``target`` wants; null (a blank date) without one."""
    dtype = target_type(target)
    if source is None:
        # One expression: most columns of a wide header are missing.
        value = "''" if is_date_column(target) else f"CAST(NULL AS {dtype.simpleString()})"
        return F.expr(f"{value} AS {quoted(target)}")
    if is_date_column(target):
        return render_timestamp(as_timestamp(df, source)).alias(target)
    return typed(df, source, dtype).alias(target)


def align(
    df: DataFrame, target: Sequence[str], clean: bool = False, renamed: Mapping[str, str] = {}
) -> list[Column]:
    """The target columns in target order, each from the input column of the same name.

    With ``clean`` both sides are cleaned before names are compared.  ``renamed`` maps a
    target to the input column it takes instead.
    """
    key = clean_name if clean else str
    have = {key(c): c for c in reversed(df.columns)}
    return [target_value(df, have.get(key(renamed.get(t, t))), t) for t in target]


def prefix_columns(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` columns by position, and the row identity."""
    own = [c for c in df.columns if c not in ROW_ID]
    return df.select(*[F.col(quoted(c)) for c in own[:n]], *lineage(df))


def existing_header(
    existing: DataFrame | None, default: Sequence[str]
) -> list[str]:
    """Header of an output that is already there, else the default."""
    if existing is None:
        return list(default)
    return [c for c in existing.columns if c not in ROW_ID]


@dataclass(frozen=True)
class Rule:
    """Target columns whose lower-cased name holds (or is) a key take ``column``.

    A rule whose column is None (the input has no such column) is passed over.
    ``timestamp`` is the same value as a time, where the input has it as one.
    """

    keys: tuple[str, ...]
    column: Column | None
    exact: bool = False
    timestamp: Column | None = None

    def applies(self, target: str) -> bool:
        if self.column is None:
            return False
        if self.exact:
            return target in self.keys
        return any(k in target.lower() for k in self.keys)

    def value(self, target: str) -> Column:
        if not is_date_column(target):
            return self.column.cast(target_type(target))
        if self.timestamp is not None:
            return render_timestamp(self.timestamp)
        return render_timestamp(parse_text_timestamp(self.column))


def map_columns(df: DataFrame, target: Sequence[str], rules: Sequence[Rule]) -> list[Column]:
    """First matching rule, else the column of the same name, else null.

    Names are compared after cleaning.  Rules depend on names only, so they are settled
    here and one ``select`` is left.
    """
    have = {clean_name(c): c for c in reversed(df.columns)}
    columns = []
    for name in target:
        rule = next((r for r in rules if r.applies(name)), None)
        if rule is not None:
            columns.append(rule.value(name).alias(name))
        else:
            columns.append(target_value(df, have.get(clean_name(name)), name))
    return columns


# Rows scanned from workbooks with uneven headers arrive with their fields already
# located, file by file, under this prefix.  MISSING lists what a row's file lacks:
# required fields and sheets.
FIELD_PREFIX = "@"
MISSING = "_missing"


def rows_having(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop rows of files that lack one of the named fields or sheets."""
    if MISSING not in df.columns:
        return df
    return df.filter(~F.arrays_overlap(F.col(MISSING), F.array(*map(F.lit, names))))


class Fields:
    """Input columns found by keyword in their cleaned names.

    ``fields["age"]`` is a text Column, or None when there is no such column.
    """

    def __init__(self, df: DataFrame, lookups: Mapping[str, Sequence]):
        self.df = df
        own = [c for c in df.columns if c not in ROW_ID and not c.startswith(FIELD_PREFIX)]
        cleaned = dict(zip(clean_names(own), own))
        self.names = {
            field: FIELD_PREFIX + field
            if FIELD_PREFIX + field in df.columns
            else cleaned.get(locate(list(cleaned), lookup))
            for field, lookup in lookups.items()
        }

    def __getitem__(self, field: str) -> Column | None:
        name = self.names[field]
        return None if name is None else as_text(self.df, name)

    def timestamp(self, field: str) -> Column | None:
        name = self.names[field]
        return None if name is None else as_timestamp(self.df, name)

    def date_rule(self, keys: tuple[str, ...], field: str, exact: bool = False) -> Rule:
        return Rule(keys, self[field], exact, self.timestamp(field))

    def rows_with(self, *required: str) -> DataFrame:
        """Input rows, or none where a required column does not exist."""
        if any(self.names[f] is None for f in required):
            return self.df.filter(F.lit(False))
        return rows_having(self.df, required)


def text_or_null(column: Column | None) -> Column:
    return F.lit(None).cast("string") if column is None else column
