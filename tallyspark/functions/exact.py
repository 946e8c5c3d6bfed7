"""Arithmetic whose result does not depend on the order of the rows.

Prices are doubles on disk. Summing doubles gives another last digit for each
partitioning, so amounts are turned into whole cents (or finer whole units),
multiplied as machine longs, summed as decimals, which do not overflow where
longs would, and turned back into doubles at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUMMABLE = "decimal(18,0)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hundredths(value: Column | str) -> Column:
    """A double of two decimals as a whole number of hundredths."""
    return F.rint(as_column(value) * 100).cast("long")


def cents(value: Column | str) -> Column:
    """Whole cents in a type whose sums are exact and do not overflow."""
    return hundredths(value).cast(SUMMABLE)


def net(price: Column | str, discount: Column | str) -> Column:
    """price * (1 - discount) in units of 1/10,000."""
    return (hundredths(price) * (100 - hundredths(discount))).cast(SUMMABLE)


def gross(price: Column | str, discount: Column | str, tax: Column | str) -> Column:
    """price * (1 - discount) * (1 + tax) in units of 1/1,000,000."""
    return (hundredths(price) * (100 - hundredths(discount)) * (100 + hundredths(tax))).cast(SUMMABLE)


def amount(units: Column | str, digits: int = 2) -> Column:
    """Units of 10^-digits as a double."""
    return as_column(units).cast("double") / F.lit(float(10**digits))


def total(units: Column, digits: int = 2) -> Column:
    """Exact sum, handed back as a double."""
    return amount(F.sum(units), digits)


def mean(units: Column, digits: int = 2) -> Column:
    """Exact sum over the number of non-null values; null where there are none."""
    return F.try_divide(total(units, digits), F.count(units).cast("double"))


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zoneless timestamp (session zone UTC)."""
    return F.unix_micros(as_column(ts).cast("timestamp"))
