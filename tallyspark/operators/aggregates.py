"""Grouped aggregation. All forms combine before the shuffle, so a hot group
reaches the final task as one partial row per map task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ordered import DEFAULT, Limits, scan_groups, sum_scan
from tallyspark.session import pinned


def summary(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[column.alias(name) for name, column in aggs.items()])


def distinct_counts(df: DataFrame, keys: Sequence[str], column: str, rsd: float | None = None) -> DataFrame:
    """Exact count of distinct values, or within ``rsd`` if that is given.

    The exact form shuffles (keys, value) first, which spreads a hot key by
    its values; the sketch sends a few kilobytes per key and map task.
    """
    how = F.count_distinct(F.col(column)) if rsd is None else F.approx_count_distinct(column, rsd)
    return df.groupBy(*keys).agg(how.alias(f"distinct_{column}"))


def levels(
    df: DataFrame,
    keys: Sequence[str],
    kind: str,
    aggs: dict[str, Column],
    sets: Sequence[Sequence[str]] | None = None,
    merge: dict[str, Callable[[str], Column]] | None = None,
) -> DataFrame:
    """Subtotals: ``rollup``, ``cube`` or explicit grouping ``sets``.

    ``level`` is the grouping id, which tells a subtotal from a null key.

    Rows are first aggregated by all keys, and the few results are rolled up.
    Rolling up the rows themselves would copy every row once per level. The
    aggregates must therefore be mergeable, and ``merge`` names the function
    for each: ``F.sum`` for sums and counts, ``F.max`` for a maximum; a mean
    is a sum and a count. As in SQL, a table without rows has a grand total.
    """
    if kind not in ("rollup", "cube", "sets"):
        raise ValueError(f"kind must be rollup, cube or sets, not {kind!r}")
    merge = merge or {}
    if set(merge) != set(aggs):
        raise ValueError(f"merge must name a function for each of {sorted(aggs)}")
    made = [column.alias(name) for name, column in aggs.items()]
    finest = df.groupBy(*keys).agg(*made)
    total = kind != "sets" or any(not s for s in sets or [])
    if total:
        # What the aggregates are over no rows joins the grand total; alone in a subtotal it goes.
        nothing = df.where(F.lit(False)).agg(*made).first().asDict()
        blank = [F.lit(nothing.get(f.name)).cast(f.dataType).alias(f.name) for f in finest.schema]
        one = df.sparkSession.range(0, 1, 1, 1).select(*blank, F.lit(True).alias("_blank"))
        finest = finest.withColumn("_blank", F.lit(False)).unionByName(one)
    if kind == "rollup":
        grouped = finest.rollup(*keys)
    elif kind == "cube":
        grouped = finest.cube(*keys)
    else:
        grouped = finest.groupingSets([[F.col(c) for c in s] for s in sets or []], *keys)
    merged = [merge[name](name).alias(name) for name in aggs]
    level = F.grouping_id().cast("int").alias("level")
    if not total:
        return grouped.agg(level, *merged)
    found = grouped.agg(level, *merged, F.min("_blank").alias("_blank"))
    return found.where((F.col("level") == 2 ** len(keys) - 1) | ~F.col("_blank")).drop("_blank")


def pivot(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], agg: Column) -> DataFrame:
    """One column per listed value. Listing them spares a pass to find them."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(agg)


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


# Rank error of the sketch that brackets exact quantiles: 1/SKETCH of a group.
SKETCH = 10_000


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: Column,
    fractions: dict[str, float],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Interpolated quantiles per group without sorting a large group.

    A sketch brackets each quantile first. A second scan counts the values
    below the bracket and keeps only those inside it, under a thousandth of
    the group, so next to nothing is shuffled; a running count over them finds
    the exact ranks. Groups no larger than the sketch keep all their values.
    The built-in exact percentile holds every distinct value of a group in
    one buffer instead. Without keys the whole table is one group.
    """
    if not keys:
        whole_table = exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], column, fractions, limits)
        return whole_table.drop("_all")
    margin = 4 / SKETCH
    probes = sorted({q for p in fractions.values() for q in (p - margin, p + margin) if 0 < q < 1})
    rows = df.select(*keys, column.alias("_v")).where(F.col("_v").isNotNull())
    found = F.percentile_approx("_v", probes, SKETCH) if probes else F.array()
    rough = rows.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_size"), found.alias("_cuts")
    )
    # Written, so that its size is known and decides how the rows are joined.
    rough = pinned(rough, "brackets")
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])

    def cut(q: float) -> Column:
        return F.get("_cuts", F.lit(probes.index(q)))

    v, large = F.col("_v"), F.col("_size") > SKETCH
    joined = rows.join(rough, on)
    inside, below = [], []
    for p in fractions.values():
        low = v >= cut(p - margin) if p - margin in probes else F.lit(True)
        high = v <= cut(p + margin) if p + margin in probes else F.lit(True)
        inside.append(low & high)
        below.append(F.count_if(~low))
    # Nearly all rows of a large group fall outside every bracket and are only counted.
    marks = [F.when(ok, F.struct(F.lit(i).alias("i"), v.alias("v"))) for i, ok in enumerate(inside)]
    whole = F.struct(F.lit(-1).alias("i"), v.alias("v"))
    mark = F.explode(F.when(large, F.array(*marks)).otherwise(F.array(whole))).alias("_m")
    near = joined.where(~large | reduce(Column.__or__, inside)).select(*keys, "_size", mark)
    near = near.where(F.col("_m").isNotNull()).groupBy(
        *keys, "_size", F.col("_m.i").alias("_i"), F.col("_m.v").alias("_v")
    )
    counts = joined.where(large).groupBy(*keys, "_size").agg(F.array(*below).alias("_below"))
    under = counts.select(*keys, "_size", F.posexplode("_below").alias("_i", "_n"))
    # Values below a bracket share the null value, which sorts first.
    hits = near.agg(F.count(F.lit(1)).alias("_n")).unionByName(under, allowMissingColumns=True)
    hits = pinned(hits, "bracketed")
    run = scan_groups(hits, [*keys, "_i"], [F.asc_nulls_first("_v")], {"_upto": sum_scan(F.col("_n"))}, limits)

    def at(i: int, rank: Column) -> Column:
        """The value that covers a rank counted from zero."""
        covers = F.col("_i").isin(i, -1) & (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(covers, F.col("_v").cast("double")))

    places = {name: F.lit(float(p)) * (F.col("_size") - 1) for name, p in fractions.items()}
    picks = []
    for i, (name, place) in enumerate(places.items()):
        picks += [at(i, F.floor(place)).alias(f"_lo_{name}"), at(i, F.ceil(place)).alias(f"_hi_{name}")]
    picked = run.groupBy(*keys).agg(F.max("_size").alias("_size"), *picks)

    def between(name: str, place: Column) -> Column:
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    return picked.select(*keys, *[between(name, place) for name, place in places.items()])


def approx_quantiles(df: DataFrame, keys: Sequence[str], column: str, fractions: dict[str, float], accuracy: int) -> DataFrame:
    """Quantiles whose rank is off by at most 1/accuracy of the group."""
    found = df.groupBy(*keys).agg(F.percentile_approx(column, list(fractions.values()), accuracy).alias("_q"))
    return found.select(*keys, *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(fractions)])


def spread(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Mean and deviations; one combinable pass."""
    c = F.col(column)
    return df.groupBy(*keys).agg(
        F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"), F.var_samp(c).alias("variance")
    )
