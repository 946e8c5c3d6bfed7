"""Window work over groups of any size.

A plain window puts one whole group into one task. That is the best plan while
groups are small, and the wrong one when a single key holds a large part of
the table. ``over_groups`` looks for hot keys first, leaves all ordinary ones
to the plain window, and cuts the few hot ones into ordered slices:

1. range-partition the hot rows by key and order, which spreads one key over
   as many tasks as it needs, and pin the slice numbers in a written table;
2. compute inside each slice;
3. reduce each slice to one row, carry values from slice to slice over those
   rows (their number is bounded by the slices, not by the data), and merge.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyspark.session import pinned


@dataclass(frozen=True)
class Limits:
    """When a group counts as hot.

    Every group above ``rows_per_task`` is cut, into as many slices as its rows
    need. One that the sample misses goes through the plain window: slower,
    never wrong.
    """

    rows_per_task: int = 5_000_000
    # A hot group shows up in the sample with at least this many rows.
    sample_hits: int = 10_000

    @property
    def fraction(self) -> float:
        return min(1.0, self.sample_hits / self.rows_per_task)


DEFAULT = Limits()


@dataclass(frozen=True)
class Scan:
    """A running value, written so that slices can be scanned apart.

    within: the value inside one slice
    total:  one value per slice; ``_place`` is the row's place in its slice
    carry:  what earlier slices (column ``_total``) hand to this one
    merge:  value within the slice, carried value -> final value
    """

    within: Callable[[WindowSpec], Column]
    total: Column
    carry: Callable[[WindowSpec], Column]
    merge: Callable[[Column, Column], Column]


def _so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def sum_scan(value: Column) -> Scan:
    return Scan(
        within=lambda w: F.sum(value).over(_so_far(w)),
        total=F.sum(value),
        carry=lambda w: F.sum("_total").over(_earlier(w)),
        merge=lambda local, before: F.coalesce(local + before, local, before),
    )


def previous_scan(value: Column) -> Scan:
    """Value of the row before. It travels in a struct, so that a null value
    and a missing row stay apart."""
    boxed = F.struct(value.alias("x"))
    return Scan(
        within=lambda w: F.lag(boxed).over(w),
        total=F.max_by(boxed, "_place"),
        carry=lambda w: F.lag("_total").over(w),
        merge=lambda local, before: F.coalesce(local, before)["x"],
    )


def last_known_scan(value: Column) -> Scan:
    return Scan(
        within=lambda w: F.last(value, ignorenulls=True).over(_so_far(w)),
        total=F.max_by(value, F.when(value.isNotNull(), F.col("_place"))),
        carry=lambda w: F.last("_total", ignorenulls=True).over(_earlier(w)),
        merge=F.coalesce,
    )


def min_scan(value: Column) -> Scan:
    return Scan(
        within=lambda w: F.min(value).over(_so_far(w)),
        total=F.min(value),
        carry=lambda w: F.min("_total").over(_earlier(w)),
        merge=F.least,
    )


def first_scan(value: Column) -> Scan:
    boxed = F.struct(value.alias("x"))
    return Scan(
        within=lambda w: F.first(boxed).over(_so_far(w)),
        total=F.min_by(boxed, "_place"),
        carry=lambda w: F.first("_total").over(_earlier(w)),
        merge=lambda local, before: F.coalesce(before, local)["x"],
    )


def join_small(df: DataFrame, small: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Join on equal columns, null equal to null, with a side that has few rows.

    Spark broadcasts it if its size allows.
    """
    renamed = small.withColumnsRenamed({c: f"_key_{c}" for c in columns})
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in columns])
    return df.join(renamed, on, how).drop(*[f"_key_{c}" for c in columns])


def hot_groups(df: DataFrame, by: Sequence[str], limits: Limits) -> DataFrame | None:
    """(key.., _n) of the groups above the limit as a written table; None if there are none.

    One scan of the key columns. Only a sample is counted (all rows where the
    limit is small), combined per task before the shuffle. However many keys
    are found, they stay off the driver.
    """
    keys = df.select(*by)
    if limits.fraction < 1:
        keys = keys.sample(limits.fraction, seed=17)
    found = (
        keys.groupBy(*by)
        .agg((F.count(F.lit(1)) / limits.fraction).cast("long").alias("_n"))
        .where(F.col("_n") > limits.rows_per_task)
    )
    found = pinned(found, "hot-keys")
    return None if found.isEmpty() else found


def split_hot(df: DataFrame, by: Sequence[str], limits: Limits) -> tuple[DataFrame, DataFrame | None, int]:
    """(ordinary rows, hot rows or None, number of slices for the hot rows)."""
    found = hot_groups(df, by, limits)
    if found is None:
        return df, None, 0
    keys = found.select(*by)
    slices = math.ceil(found.agg(F.sum("_n")).first()[0] / limits.rows_per_task)
    return join_small(df, keys, by, "left_anti"), join_small(df, keys, by, "left_semi"), slices


def cut(hot: DataFrame, by: Sequence[str], order: Sequence[Column], slices: int) -> DataFrame:
    """Number the range partitions and pin the numbers in the shared folder."""
    ranged = hot.repartitionByRange(slices, *[F.col(c) for c in by], *order)
    return pinned(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def scan_slices(
    sliced: DataFrame, by: Sequence[str], order: Sequence[Column], scans: dict[str, Scan]
) -> DataFrame:
    """Add one column per scan to rows that carry ``_slice``."""
    inside = Window.partitionBy(*by, "_slice").orderBy(*order)
    across = Window.partitionBy(*by).orderBy("_slice")
    names = list(scans)
    local = sliced.withColumn("_place", F.row_number().over(inside))
    local = local.withColumns({f"_in_{n}": scans[n].within(inside) for n in names})
    ends = local.groupBy(*by, "_slice").agg(*[scans[n].total.alias(f"_end_{n}") for n in names])
    carried = ends
    for n in names:
        carried = carried.withColumnRenamed(f"_end_{n}", "_total")
        carried = carried.withColumn(f"_before_{n}", scans[n].carry(across)).drop("_total")
    # One row per (key, slice): no more than slices + hot groups.
    joined = join_small(local, carried, [*by, "_slice"], "left")
    merged = joined.withColumns(
        {n: scans[n].merge(F.col(f"_in_{n}"), F.col(f"_before_{n}")) for n in names}
    )
    return merged.drop("_place", *[f"_in_{n}" for n in names], *[f"_before_{n}" for n in names])


def over_groups(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    plain: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``plain`` for ordinary groups, ``sliced`` for rows cut into slices.

    ``order`` must end in a unique column; both callables must add the same
    columns.
    """
    cold, hot, slices = split_hot(df, by, limits)
    done = plain(cold)
    if hot is None:
        return done
    extra = sliced(cut(hot, by, order, slices)).drop("_slice")
    return done.unionByName(
        extra.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in done.schema])
    )


def scan_groups(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    scans: dict[str, Scan],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Running values over groups of any size, one column per scan."""
    window = Window.partitionBy(*by).orderBy(*order)

    def plain(rows: DataFrame) -> DataFrame:
        # With nothing carried in, merging leaves the plain window expression.
        local = rows.withColumns({f"_in_{n}": s.within(window) for n, s in scans.items()})
        merged = local.withColumns(
            {n: s.merge(F.col(f"_in_{n}"), F.lit(None).cast(local.schema[f"_in_{n}"].dataType)) for n, s in scans.items()}
        )
        return merged.drop(*[f"_in_{n}" for n in scans])

    return over_groups(df, by, order, plain, lambda rows: scan_slices(rows, by, order, scans), limits)
