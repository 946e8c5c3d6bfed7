"""Buckets and conditional values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(value: Column | str, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value: 0 below the first edge, null for null."""
    value = F.col(value) if isinstance(value, str) else value
    place = F.when(value.isNull(), F.lit(None).cast("int"))
    for n, edge in enumerate(edges):
        place = place.when(value < edge, n)
    return place.otherwise(len(edges))


def equal_width(value: Column | str, low: float, high: float, n: int) -> Column:
    """1..n for equal slices of [low, high); 0 below and n + 1 from high on."""
    value = F.col(value) if isinstance(value, str) else value
    return F.width_bucket(value, F.lit(float(low)), F.lit(float(high)), F.lit(n))


def ratio(part: Column, whole: Column) -> Column:
    """Null instead of an error where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
