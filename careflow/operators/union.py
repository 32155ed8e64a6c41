"""Unions of tables with uneven headers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.functions.naming import quoted
from careflow.operators.projection import as_text
from careflow.schemas import ROW_ID


def text_columns(df: DataFrame) -> DataFrame:
    """All columns as text but for the row identity, so that unions never need a cast."""
    return df.select(
        *[F.col(c) if c in ROW_ID else as_text(df, c).alias(c) for c in df.columns]
    )


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of frames already on one header."""
    return reduce(DataFrame.unionByName, frames)


def outer_union(frames: Sequence[DataFrame], as_strings: bool = False) -> DataFrame:
    """UNION ALL by name; a column that a frame lacks is null there.

    Columns keep the order in which they first appear.  Where one name has different
    types in two frames, that column becomes text in all of them: a bare union would
    cast text to numbers and fail.
    """
    if as_strings:
        frames = [text_columns(f) for f in frames]
    types: dict[str, set] = {}
    for frame in frames:
        for field in frame.schema:
            types.setdefault(field.name, set()).add(field.dataType.simpleString())
    mixed = {name for name, seen in types.items() if len(seen) > 1 and name not in ROW_ID}

    def settle(frame: DataFrame) -> DataFrame:
        if not mixed.intersection(frame.columns):
            return frame
        return frame.select(
            *[as_text(frame, c).alias(c) if c in mixed else F.col(quoted(c))
              for c in frame.columns]
        )

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [settle(f) for f in frames]
    )
