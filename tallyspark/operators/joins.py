"""Joins.

No side is marked for broadcast here: Catalyst broadcasts a side whose size,
read from its files or measured at a shuffle, lies below
``spark.sql.autoBroadcastJoinThreshold``, and sort-merges otherwise. Adaptive
execution splits skewed partitions of inner joins on both sides, and of
semi, anti and left joins on the left side only; the operators below are laid
out so that the side it cannot split never holds a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.exact import micros
from tallyspark.operators.ordered import (
    DEFAULT,
    Limits,
    hot_groups,
    join_small,
    last_known_scan,
    scan_groups,
)
from tallyspark.operators.windows import moving

Pairs = Sequence[tuple[str, str]]


def _on(pairs: Pairs) -> Column:
    return reduce(Column.__and__, [F.col(left) == F.col(right) for left, right in pairs])


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner joins of a fact table with its dimensions (dim, left key, dim key).

    Keys of one name come out as one column.
    """
    for dim, left, right in dims:
        fact = fact.join(dim, left if left == right else F.col(left) == F.col(right))
    return fact


def _matches(left: DataFrame, right: DataFrame, pairs: Pairs, how: str) -> DataFrame:
    """Semi or anti join against one row per key of the right side.

    The keys are made distinct before their shuffle, so a hot key costs one
    row per task; the shuffle is the one the join needs anyway.
    """
    keys = right.select(*[F.col(r).alias(f"_key_{n}") for n, (_, r) in enumerate(pairs)]).distinct()
    return left.join(keys, _on([(l, f"_key_{n}") for n, (l, _) in enumerate(pairs)]), how)


def having_match(left: DataFrame, right: DataFrame, pairs: Pairs) -> DataFrame:
    """Left rows with at least one match."""
    return _matches(left, right, pairs, "left_semi")


def without_match(left: DataFrame, right: DataFrame, pairs: Pairs) -> DataFrame:
    """Left rows without any match."""
    return _matches(left, right, pairs, "left_anti")


def outer(
    left: DataFrame,
    right: DataFrame,
    pairs: Pairs,
    how: str,
    fill: dict | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Left, right or full outer join; ``fill`` values stand in for the columns
    of a side without a match, while nulls of matched rows stay.

    Keys of one name come out as one column, from whichever side is there.

    Spark cannot split a hot key on the null-supplying side of an outer join,
    and on neither side of a full one. Keys that are hot there take another
    way: an inner join, which can be split, and anti joins against distinct
    keys for the rows without a match. All other keys meet in one outer join.
    """
    if how not in ("left", "right", "full"):
        raise ValueError(f"how must be left, right or full, not {how!r}")
    same = [l for l, r in pairs if l == r]
    sides = {c: "_in_right" for c in right.columns} | {c: "_in_left" for c in left.columns}
    left = left.withColumn("_in_left", F.lit(True))
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in same}).withColumn("_in_right", F.lit(True))
    pairs = [(l, f"_right_{r}" if r in same and l == r else r) for l, r in pairs]
    l_keys, r_keys = [p[0] for p in pairs], [p[1] for p in pairs]
    unsplit = {"left": [(right, r_keys)], "right": [(left, l_keys)], "full": [(right, r_keys), (left, l_keys)]}[how]
    tables = []
    for side, keys in unsplit:
        found = hot_groups(side, keys, limits)
        if found is not None:
            tables.append(found.select(*keys).toDF(*l_keys))
    if not tables:
        whole = left.join(right, _on(pairs), how)
    else:
        l_hot = reduce(DataFrame.unionByName, tables).distinct()
        r_hot = l_hot.toDF(*r_keys)
        cold = join_small(left, l_hot, l_keys, "left_anti").join(
            join_small(right, r_hot, r_keys, "left_anti"), _on(pairs), how
        )
        hot = _outer_by_parts(
            join_small(left, l_hot, l_keys, "left_semi"), join_small(right, r_hot, r_keys, "left_semi"), pairs, how
        )
        whole = cold.unionByName(hot)
    whole = whole.withColumns({c: F.coalesce(c, f"_right_{c}") for c in same})
    filled = {c: F.when(F.col(sides[c]).isNull(), F.lit(v)).otherwise(F.col(c)) for c, v in (fill or {}).items()}
    return whole.withColumns(filled).drop("_in_left", "_in_right", *[f"_right_{c}" for c in same])


def _outer_by_parts(left: DataFrame, right: DataFrame, pairs: Pairs, how: str) -> DataFrame:
    parts = [left.join(right, _on(pairs))]
    if how in ("left", "full"):
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]
        parts.append(without_match(left, right, pairs).select("*", *blank))
    if how in ("right", "full"):
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema]
        flipped = [(r, l) for l, r in pairs]
        parts.append(without_match(right, left, flipped).select(*blank, *right.columns))
    return reduce(DataFrame.unionByName, parts)


def within(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str] | Pairs,
    times: tuple[str, str],
    seconds: int,
    least: int = 0,
) -> DataFrame:
    """Inner join: equal keys, and the right time ``least`` to ``seconds``
    before the left (negative: after it). ``on`` is one pair of keys or several.

    Both sides get a time bucket as wide as the interval, and right rows go to
    their own bucket and the next. That turns the range into an equi join on
    (keys, bucket) with a residual test, so only neighbours in time meet.
    """
    if seconds < least:
        raise ValueError(f"an interval from {least} to {seconds} seconds is empty")
    pairs = [on] if isinstance(on[0], str) else list(on)
    span = (seconds - least) * 1_000_000
    width = max(span, 1)
    l_ts, r_ts = times
    cell = "(({0} - pmod({0}, {1}L)) div {1}L)"
    # The left time moved back by the least distance is the latest that may match.
    l = left.withColumn("_l_at", micros(l_ts) - F.lit(least * 1_000_000)).withColumn("_l_cell", F.expr(cell.format("_l_at", width)))
    r = right.withColumn("_r_at", micros(r_ts))
    r = r.withColumn("_r_first", F.expr(cell.format("_r_at", width)))
    r = r.withColumn("_r_cell", F.explode(F.array(F.col("_r_first"), F.col("_r_first") + 1)))
    gap = F.col("_l_at") - F.col("_r_at")
    joined = l.join(r, _on([*pairs, ("_l_cell", "_r_cell")]) & (gap >= 0) & (gap <= span))
    return joined.drop("_l_at", "_l_cell", "_r_at", "_r_first", "_r_cell")


def as_of(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    ts: str,
    tie: str,
    take: Sequence[str],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """For each left row the newest right row of its key at or before its time.

    Both sides are merged into one ordered stream per key and the last right
    row seen so far is carried on: no pairs are formed, whatever the counts.
    ``tie`` (a column of both) decides between right rows of equal time; the
    columns in ``take`` come out as they are named, null without a match. As
    in any join, a null key or time matches nothing.
    """
    hit = F.struct(*[F.col(c) for c in take])
    seen = right.dropna(subset=[*by, ts]).select(*by, ts, tie, F.lit(0).alias("_side"), hit.alias("_hit"))
    hit_type = seen.schema["_hit"].dataType
    asked = left.withColumns({"_side": F.lit(1), "_hit": F.lit(None).cast(hit_type)})
    both = asked.unionByName(seen, allowMissingColumns=True)
    order = [F.col(ts), F.col("_side"), F.col(tie)]
    done = scan_groups(both, by, order, {"_last": last_known_scan(F.col("_hit"))}, limits)
    return done.where(F.col("_side") == 1).select(*left.columns, *[F.col("_last")[c].alias(c) for c in take])


def count_within(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    ts: str,
    seconds: int,
    value: Column,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Per left row the number ``n`` and sum ``total`` of right rows of its
    key 0 to ``seconds`` before it.

    Both sides form one stream of rows over which moving sums are kept; the
    pairs themselves are never formed. A null key or time matches nothing.
    """
    seen = right.dropna(subset=[*by, ts]).select(*by, ts, F.lit(1).alias("_one"), value.alias("_value"))
    both = left.withColumn("_asks", F.lit(True)).unionByName(seen, allowMissingColumns=True)
    sums = {"n": F.col("_one"), "total": F.col("_value")}
    return moving(both, by, ts, seconds, sums, limits).where(F.col("_asks")).select(*left.columns, "n", "total")
