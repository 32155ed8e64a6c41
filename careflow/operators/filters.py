"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.functions.classify import contains_any
from careflow.functions.naming import quoted


def keyword_rows(df: DataFrame, column: str, keywords: Sequence[str]) -> DataFrame:
    """Rows whose text holds any keyword, case-sensitive; null never matches."""
    return df.filter(contains_any(F.col(quoted(column)), keywords))


def keyed_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which every key is known.

    Plain null tests, unlike ``dropna``, are pushed down to the scan.
    """
    return df.filter(reduce(and_, [F.col(quoted(k)).isNotNull() for k in keys]))


def empty_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)
