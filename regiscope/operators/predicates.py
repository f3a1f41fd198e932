"""Row filters and column layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.functions.exprs import matches


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from first to last in the table's order."""
    return df.columns[df.columns.index(first) : df.columns.index(last) + 1]


def relocate(df: DataFrame, column: str, after: str) -> DataFrame:
    rest = [c for c in df.columns if c != column]
    at = rest.index(after) + 1
    return df.select(*rest[:at], column, *rest[at:])


def keep_matching(df: DataFrame, column: str, pattern: str, ignore_case: bool = True) -> DataFrame:
    return df.where(matches(F.col(column), pattern, ignore_case))


def drop_matching(df: DataFrame, column: str, pattern: str, ignore_case: bool = True) -> DataFrame:
    """Drops matches; NULLs stay."""
    return df.where(~matches(F.col(column), pattern, ignore_case))


def both_positive(a: str, b: str) -> Column:
    return (F.col(a) > 0) & (F.col(b) > 0)


def within(column: str, low: float | None = None, high: float | None = None) -> Column:
    """Strictly between bounds; NULLs fail."""
    out = F.col(column).isNotNull()
    if low is not None:
        out &= F.col(column) > low
    if high is not None:
        out &= F.col(column) < high
    return out


def has_token(column: str) -> Column:
    return F.col(column) != ""
