"""Calendar series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


UNITS = ("year", "quarter", "month", "week", "day", "hour", "minute")


def period(ts: str, unit: str) -> Column:
    """Start of the period, zoneless like its input."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    return F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")


def by_period(df: DataFrame, ts: str, unit: str, aggs: dict[str, Column]) -> DataFrame:
    """One row per period that occurs, in column ``period``."""
    return df.groupBy(period(ts, unit).alias("period")).agg(*[a.alias(n) for n, a in aggs.items()])


def growth(series: DataFrame, value: str, unit: str) -> DataFrame:
    """Add ``previous`` and ``growth`` (relative, null after a zero) to what
    ``by_period`` returns.

    The previous value is that of the calendar period just before, null where
    that one does not occur. A join finds it, so no task orders all periods.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    step = F.expr("interval 3 month" if unit == "quarter" else f"interval 1 {unit}")
    before = series.select((F.col("period") + step).alias("_next"), F.col(value).alias("previous"))
    return series.join(before, F.col("period") == F.col("_next"), "left").drop("_next").withColumn(
        "growth", F.try_divide(F.col(value) - F.col("previous"), F.col("previous"))
    )


def day_parts(ts: str) -> dict[str, Column]:
    c = F.col(ts)
    return {
        "year": F.year(c).cast("long"),
        "quarter": F.quarter(c).cast("long"),
        "month": F.month(c).cast("long"),
        "weekday": F.dayofweek(c).cast("long"),
        "month_end": F.last_day(c.cast("date")),
    }
