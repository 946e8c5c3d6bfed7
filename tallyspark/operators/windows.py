"""Window functions over groups of any size (see ``ordered``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.ordered import (
    DEFAULT,
    Limits,
    cut,
    first_scan,
    join_small,
    last_known_scan,
    over_groups,
    previous_scan,
    scan_groups,
    scan_slices,
    split_hot,
    sum_scan,
)

# Up to this many rows per group each map task's share of a group is trimmed
# before the shuffle. Spark would do so up to 1,000; with very many map tasks
# that is still a lot of rows for one hot group.
MAP_SIDE_LIMIT = 100


def top_per(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, limits: Limits = DEFAULT) -> DataFrame:
    """The first ``n`` rows of each group, numbered in ``row_number``.

    Small ``n``: every map task keeps at most ``n`` rows per group, so a hot
    group shuffles no more than n rows per task. Large ``n``: numbered by a
    sliced running count.
    """
    if n <= MAP_SIDE_LIMIT:
        window = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn("row_number", F.row_number().over(window)).where(F.col("row_number") <= n)
    numbered = scan_groups(df, by, order, {"row_number": sum_scan(F.lit(1))}, limits)
    return numbered.withColumn("row_number", F.col("row_number").cast("int")).where(F.col("row_number") <= n)


def ranks(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], values: Sequence[str], tiles: int, limits: Limits = DEFAULT
) -> DataFrame:
    """row_number, rank, dense_rank and ntile(``tiles``) for every row.

    ``order`` is total; rows with equal ``values`` (its leading columns) are
    ties for rank and dense_rank.
    """
    by_value = Window.partitionBy(*by).orderBy(*order[: len(values)])
    total = Window.partitionBy(*by).orderBy(*order)
    names = ["row_number", "rank", "dense_rank", "ntile"]

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                "row_number": F.row_number().over(total),
                "rank": F.rank().over(by_value),
                "dense_rank": F.dense_rank().over(by_value),
                "ntile": F.ntile(tiles).over(total),
            }
        )

    def sliced(rows: DataFrame) -> DataFrame:
        value = F.struct(*[F.col(v) for v in values])
        step = scan_slices(
            rows, by, order, {"_rn": sum_scan(F.lit(1)), "_prev": previous_scan(value)}
        )
        fresh = (F.col("_rn") == 1) | ~F.col("_prev").eqNullSafe(value)
        step = step.withColumn("_fresh", fresh)
        step = scan_slices(
            step,
            by,
            order,
            {
                "_rank": last_known_scan(F.when(F.col("_fresh"), F.col("_rn"))),
                "_dense": sum_scan(F.col("_fresh").cast("int")),
            },
        )
        # Group sizes, one row per hot group.
        sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
        step = join_small(step, sizes, by, "left")
        small = F.floor(F.col("_size") / tiles)
        bigger = F.col("_size") % tiles
        edge = bigger * (small + 1)
        tile = F.when(F.col("_rn") <= edge, F.ceil(F.col("_rn") / (small + 1))).otherwise(
            bigger + F.ceil(F.try_divide(F.col("_rn") - edge, small))
        )
        out = step.withColumns(
            {"row_number": F.col("_rn"), "rank": F.col("_rank"), "dense_rank": F.col("_dense"), "ntile": tile}
        )
        return out.select(*df.columns, *names)

    return over_groups(df, by, order, plain, sliced, limits)


def change(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], columns: Sequence[str], limits: Limits = DEFAULT
) -> DataFrame:
    """Add ``prev_<c>`` and ``first_<c>``: the row before, and the group's first."""
    scans = {f"prev_{c}": previous_scan(F.col(c)) for c in columns}
    scans |= {f"first_{c}": first_scan(F.col(c)) for c in columns}
    return scan_groups(df, by, order, scans, limits)


def following(
    df: DataFrame, by: Sequence[str], reverse_order: Sequence[Column], columns: Sequence[str], limits: Limits = DEFAULT
) -> DataFrame:
    """Add ``next_<c>``: the row after, that is, the row before in reverse."""
    return scan_groups(df, by, reverse_order, {f"next_{c}": previous_scan(F.col(c)) for c in columns}, limits)


def running(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], totals: dict[str, Column], limits: Limits = DEFAULT
) -> DataFrame:
    """Running sums from the group's first row to the current one."""
    return scan_groups(df, by, order, {name: sum_scan(value) for name, value in totals.items()}, limits)


def moving(
    df: DataFrame, by: Sequence[str], ts: str, seconds: int, sums: dict[str, Column], limits: Limits = DEFAULT
) -> DataFrame:
    """Sums over the last ``seconds`` up to each row, rows of equal time
    included; null values count as zero.

    The sum is the difference of two totals that only grow: up to now, and up
    to the last microsecond before the frame opens. Spark extends such frames
    row by row, where a frame with two moving ends is added up anew for each
    row. Values must be integers or decimals, for which the difference is exact.
    """
    names = list(sums)
    rows = df.withColumns({f"_x_{n}": F.coalesce(v, F.lit(0)) for n, v in sums.items()})
    keys = ", ".join(f"`{c}`" for c in by)
    growing = f"over (partition by {keys} order by `{ts}` range between unbounded preceding and"
    opens = f"interval '{seconds}.000001' second preceding"

    def plain(part: DataFrame) -> DataFrame:
        # Rows without a time come first and form a frame of their own.
        now = {n: F.expr(f"sum(`_x_{n}`) {growing} current row)") for n in names}
        old = {n: F.expr(f"sum(`_x_{n}`) {growing} {opens})") for n in names}
        gone = {n: F.when(F.col(ts).isNotNull(), F.coalesce(old[n], F.lit(0))).otherwise(0) for n in names}
        return part.withColumns({n: now[n] - gone[n] for n in names}).select(*df.columns, *names)

    cold, hot, slices = split_hot(rows, by, limits)
    done = plain(cold)
    if hot is None:
        return done
    points = hot.groupBy(*by, ts).agg(*[F.sum(f"_x_{n}").alias(f"_x_{n}") for n in names])
    here = points.withColumns({"_at": F.col(ts), "_side": F.lit(1)})
    opened = points.select(
        *by, (F.col(ts) - F.expr(f"interval {seconds} seconds")).alias(ts), F.col(ts).alias("_at"), F.lit(0).alias("_side")
    )
    # Of equal times the opening mark comes first: the frame includes its start.
    marks = here.unionByName(opened, allowMissingColumns=True)
    order = [F.col(ts), F.col("_side"), F.col("_at")]
    scans = {f"_c_{n}": sum_scan(F.col(f"_x_{n}")) for n in names}
    run = scan_slices(cut(marks, by, order, 2 * slices), by, order, scans)
    frames = run.groupBy(*[F.col(c).alias(f"_key_{c}") for c in by], F.col("_at")).agg(
        *[
            F.sum(F.when(F.col("_side") == 1, F.col(f"_c_{n}")).otherwise(-F.coalesce(f"_c_{n}", F.lit(0)))).alias(n)
            for n in names
        ]
    )
    on = F.col(ts).eqNullSafe(F.col("_at"))
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    # Joined on (key, time), which spreads the hot key.
    extra = hot.join(frames, on)
    return done.unionByName(
        extra.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in done.schema])
    )
