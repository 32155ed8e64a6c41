"""Column names: cleaning and keyword lookup.  Metadata only, no job is run."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """Collapse white space, then keep only letters, digits, underscores and spaces."""
    collapsed = " ".join(name.split())
    return "".join(ch for ch in collapsed if ch.isalnum() or ch in "_ ")


def clean_names(names: Iterable[str], on_collision: str = "suffix") -> list[str]:
    """Clean every name.  Names that become equal get ``_2``, ``_3``... or raise."""
    out: list[str] = []
    for name in names:
        base = candidate = clean_name(name)
        n = 1
        while candidate in out:
            if on_collision == "raise":
                raise ValueError(f"two columns are both named {base!r} after cleaning")
            n += 1
            candidate = f"{base}_{n}"
        out.append(candidate)
    return out


def clean_column_names(df: DataFrame, on_collision: str = "suffix") -> DataFrame:
    return df.toDF(*clean_names(df.columns, on_collision))


def find_columns(columns: Iterable[str], keywords: Sequence[str]) -> list[str]:
    """Columns whose name holds any keyword, in column order."""
    return [c for c in columns if any(k in c for k in keywords)]


def first_column(columns: Iterable[str], keywords: Sequence[str]) -> str | None:
    return next(iter(find_columns(columns, keywords)), None)


def locate(columns: Sequence[str], lookup: Sequence) -> str | None:
    """First column for a lookup: keywords, or several keyword lists tried in turn."""
    choices = [lookup] if isinstance(lookup[0], str) else lookup
    return next(filter(None, (first_column(columns, keywords) for keywords in choices)), None)


def resolve_column(columns: Iterable[str], keywords: Sequence[str]) -> str:
    """As ``first_column``, but a missing column is an error."""
    found = first_column(columns, keywords)
    if found is None:
        raise ValueError(f"no column holds any of: {', '.join(keywords)}")
    return found


def quoted(name: str) -> str:
    """Back-tick a name so that parentheses, dots and CJK text resolve."""
    return "`" + name.replace("`", "``") + "`"
