"""Frames that move over a group of any size: so many rows about each row, or a span of time.

Row frames: hot groups are numbered in slices and cut into blocks of rows; each
block gets the few rows before and after it that its frames reach, so an
ordinary window over (group, block) gives the same answer. Any window
expression will do that looks no further than it says.

Extremes over a span of time are linear, whatever the span holds: time is cut
into cells as long as the span, so a frame is the end of one cell and the
beginning of the next. Running extremes from the beginning of each cell and
from its end, at the frame's edge, are all that is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyspark.functions.exact import micros
from tallyspark.operators.ordered import DEFAULT, Limits, Scan, over_groups, scan_groups, scan_slices, sum_scan


def row_frames(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    before: int,
    after: int,
    make: Callable[[WindowSpec], dict[str, Column]],
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Add window expressions that look at most ``before`` rows back and ``after`` rows ahead.

    ``make`` gets the ordered window of a group and gives the columns to add,
    for instance ``{"low": F.min("v").over(w.rowsBetween(-2, 0)), "old":
    F.lag("v", 3).over(w)}`` with ``before`` 3. ``order`` ends in a unique
    column. Null values are what the expression makes of them.
    """
    length = max(before + after + 1, limits.rows_per_task // 4)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumns(make(Window.partitionBy(*by).orderBy(*order)))

    def sliced(rows: DataFrame) -> DataFrame:
        numbered = scan_slices(rows, by, order, {"_rn": sum_scan(F.lit(1))})
        place = F.col("_rn") - 1
        # A row stands in its own block, and in those whose frames reach it.
        blocks = F.sequence(F.floor((place - after) / length), F.floor((place + before) / length))
        dealt = numbered.withColumn("_block", F.explode(F.filter(blocks, lambda b: b >= 0)))
        framed = dealt.withColumns(make(Window.partitionBy(*by, "_block").orderBy(*order)))
        return framed.where(F.col("_block") == F.floor(place / length)).drop("_rn", "_block")

    return over_groups(df, by, order, plain, sliced, limits)


def shifted(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], columns: Sequence[str], offset: int, limits: Limits = DEFAULT
) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>``: the values ``offset`` rows before and after."""

    def make(w: WindowSpec) -> dict[str, Column]:
        return {f"prev_{c}": F.lag(c, offset).over(w) for c in columns} | {f"next_{c}": F.lead(c, offset).over(w) for c in columns}

    return row_frames(df, by, order, offset, offset, make, limits)


def _extreme_scan(value: Column, kind: str) -> Scan:
    pick, both = (F.min, F.least) if kind == "min" else (F.max, F.greatest)
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return Scan(
        within=lambda w: pick(value).over(so_far(w)),
        total=pick(value),
        carry=lambda w: pick("_total").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        merge=both,
    )


def time_extremes(
    df: DataFrame, by: Sequence[str], ts: str, seconds: int, extremes: dict[str, tuple[str, str]], limits: Limits = DEFAULT
) -> DataFrame:
    """Add the least or largest value of the last ``seconds`` up to each row, rows of equal time included.

    ``extremes`` names columns to add: ("min" or "max", column). Nulls among the
    values are passed over. Rows without a time are a frame of their own.
    """
    span = F.lit(seconds * 1_000_000)
    picks = {n: (F.min if kind == "min" else F.max)(c).alias(n) for n, (kind, c) in extremes.items()}
    # One row for each time of a group: a cell's rows are its different times.
    points = df.groupBy(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(ts).alias("_ts")).agg(*picks.values())
    keys = [f"_by{i}" for i in range(len(by))]
    points = points.withColumn("_at", micros("_ts"))
    points = points.withColumn("_cell", F.floor(F.col("_at") / span))
    heads = scan_groups(
        points, [*keys, "_cell"], [F.asc("_at")], {f"_head_{n}": _extreme_scan(F.col(n), kind) for n, (kind, _) in extremes.items()}, limits
    )
    # Where a frame opens, in the cell before its row's: everything from there to the cell's end.
    marks = points.where("_at IS NOT NULL").select(
        *keys, "_ts", (F.col("_at") - span).alias("_at"), (F.col("_cell") - 1).alias("_cell"), F.lit(1).alias("_side")
    )
    both = points.where("_at IS NOT NULL").withColumn("_side", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    tails = scan_groups(
        both, [*keys, "_cell"], [F.desc("_at"), F.asc("_side")], {f"_tail_{n}": _extreme_scan(F.col(n), kind) for n, (kind, _) in extremes.items()}, limits
    )
    tails = tails.where("_side = 1").select(*[F.col(k).alias(f"t{k}") for k in keys], F.col("_ts").alias("t_ts"), *[f"_tail_{n}" for n in extremes])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"t{k}")) for k in [*keys, "_ts"]])
    found = heads.drop(*extremes, "_at", "_cell").join(tails, same, "left")
    found = found.withColumns(
        {n: (F.least if kind == "min" else F.greatest)(f"_head_{n}", f"_tail_{n}") for n, (kind, _) in extremes.items()}
    ).select(*keys, "_ts", *extremes)
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(k)) for c, k in [*zip(by, keys), (ts, "_ts")]])
    return df.join(found, on).select(*df.columns, *extremes)
