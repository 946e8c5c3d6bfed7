"""Global order and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows; each task sends at most ``k``. ``order`` must be
    total, or the rows at the edge are arbitrary."""
    return df.orderBy(*order).limit(k)


def ordered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Total order over all rows (range partitioning plus local sorts)."""
    return df.orderBy(*order)
