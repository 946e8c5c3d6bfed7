"""Sketches that are stored once per group and answer many later questions.

One scan of the raw rows makes, for each group (a day, say), a theta sketch of a
column's distinct values, a HyperLogLog sketch of them, and a KLL sketch of a
number's distribution: some kilobytes a group whatever it holds. Written as
binary columns they are merged for any set of groups without another look at the
rows: distinct values of a week, of two weeks together, of both weeks at once,
quantiles of a month.

Bounds, at 95 %: distinct counts within 5 % (theta with 2^12 entries, HyperLogLog
with 2^12 registers; intersections within 5 % of the union), ranks of quantiles
within 2 points. Small groups are exact: theta below 4,096 values.

Nulls are neither distinct values nor part of a distribution. A group without
values has sketches of nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ENTRIES = 12  # as a power of two
_KLL = 400


def sketched(df: DataFrame, by: Sequence[Column], distinct: dict[str, Column], spread: dict[str, Column]) -> DataFrame:
    """One row per group: ``<name>_theta`` and ``<name>_hll`` of each distinct column, ``<name>_kll`` of each number."""
    aggs = [F.theta_sketch_agg(c, _ENTRIES).alias(f"{n}_theta") for n, c in distinct.items()]
    aggs += [F.hll_sketch_agg(c, _ENTRIES).alias(f"{n}_hll") for n, c in distinct.items()]
    aggs += [F.kll_sketch_agg_double(c.cast("double"), _KLL).alias(f"{n}_kll") for n, c in spread.items()]
    return df.groupBy(*by).agg(*aggs)


def distinct_in_any(stored: DataFrame, name: str, by: Sequence[Column] = ()) -> DataFrame:
    """``<name>``: distinct values in any of the groups, by HyperLogLog."""
    return stored.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(f"{name}_hll")).alias(name))


def distinct_in_all(stored: DataFrame, name: str, sets: dict[str, Column]) -> DataFrame:
    """Distinct values that occur in each of several sets of groups (named conditions on the stored rows).

    Gives ``<set>`` for each set and ``all`` for their intersection, in one row.
    """
    unions = stored.agg(*[F.theta_union_agg(F.when(c, F.col(f"{name}_theta")), _ENTRIES).alias(n) for n, c in sets.items()])
    both = reduce(F.theta_intersection, [F.col(n) for n in sets])
    return unions.select(*[F.theta_sketch_estimate(n).alias(n) for n in sets], F.theta_sketch_estimate(both).alias("all"))


def quantiles_of(stored: DataFrame, name: str, ranks: Sequence[float], by: Sequence[Column] = ()) -> DataFrame:
    """``<name>``: approximate quantiles over all the groups, as an array."""
    merged = stored.groupBy(*by).agg(F.kll_merge_agg_double(f"{name}_kll").alias("_kll"))
    wanted = F.array(*[F.lit(float(r)) for r in ranks])
    return merged.withColumn(name, F.kll_sketch_get_quantile_double("_kll", wanted)).drop("_kll")
