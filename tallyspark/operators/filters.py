"""Projection and filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, columns: Sequence[str | Column], predicate: Column | None = None) -> DataFrame:
    """Rows that satisfy the predicate, with the given columns.

    The filter is stated first, on bare columns, so that it reaches the scan.
    """
    return (df if predicate is None else df.where(predicate)).select(*columns)


def between(column: str, low, high) -> Column:
    """low <= column < high."""
    return (F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high))


def any_like(column: str, patterns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(column).like(p) for p in patterns])


def same(left: str | Column, right) -> Column:
    """Equality in which null equals null; never null itself."""
    left = F.col(left) if isinstance(left, str) else left
    return left.eqNullSafe(right)
