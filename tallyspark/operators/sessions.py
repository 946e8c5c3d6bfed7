"""Sessions and funnels over finished event tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.exact import micros
from tallyspark.operators.ordered import (
    DEFAULT,
    Limits,
    Scan,
    cut,
    min_scan,
    over_groups,
    previous_scan,
    scan_slices,
    split_hot,
    sum_scan,
)


def sessions(
    df: DataFrame, by: str, ts: str, gap_seconds: int, value: Column, limits: Limits = DEFAULT
) -> DataFrame:
    """(by, session_start, session_end, events, total): runs of events at most
    ``gap_seconds`` apart. ``session_end`` is the last event. As in Spark's own
    session windows, an event without a time belongs to none.

    The events of an ordinary key are chained one by one. Those of a hot key
    are first reduced to time cells one gap wide: two events of one cell are
    always in one session, so only the cells need chaining. A short gap leaves
    almost as many cells as events; they are chained in slices.
    """
    gap = gap_seconds * 1_000_000
    events = df.where(F.col(ts).isNotNull()).select(by, F.col(ts).alias("_ts"), value.alias("_v"))
    cold, hot, slices = split_hot(events, [by], limits)
    runs = cold.select(by, F.col("_ts").alias("_from"), F.col("_ts").alias("_to"), F.lit(1).cast("long").alias("_n"), "_v")
    done = _chained(runs, by, gap)
    if hot is None:
        return done
    cell = F.floor(micros("_ts") / F.lit(float(gap))).alias("_cell")
    cells = hot.groupBy(by, cell).agg(
        F.min("_ts").alias("_from"), F.max("_ts").alias("_to"), F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_v")
    )
    extra = _chained_in_slices(cells, by, gap, slices)
    return done.unionByName(extra.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in done.schema]))


def _chained(runs: DataFrame, by: str, gap: int) -> DataFrame:
    """Sessions from runs of events that do not overlap: (by, _from, _to, _n, _v)."""
    in_time = Window.partitionBy(by).orderBy("_from").rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag("_to").over(Window.partitionBy(by).orderBy("_from"))
    opened = runs.withColumn("_new", _opens(before, gap))
    return _added_up(opened.withColumn("_no", F.sum("_new").over(in_time)), by)


def _chained_in_slices(runs: DataFrame, by: str, gap: int, slices: int) -> DataFrame:
    """The same for keys with too many runs for one task."""
    order = [F.asc("_from")]
    sliced = cut(runs, [by], order, slices)
    known = scan_slices(sliced, [by], order, {"_before": previous_scan(F.col("_to"))})
    opened = known.withColumn("_new", _opens(F.col("_before"), gap)).drop("_before")
    return _added_up(scan_slices(opened, [by], order, {"_no": sum_scan(F.col("_new"))}), by)


def _opens(before: Column, gap: int) -> Column:
    """1 for a run that opens a session: the first of its key, or one after a longer silence."""
    return (F.coalesce(micros("_from") - micros(before), F.lit(gap + 1)) > gap).cast("int")


def _added_up(numbered: DataFrame, by: str) -> DataFrame:
    return (
        numbered.groupBy(by, "_no")
        .agg(
            F.min("_from").alias("session_start"),
            F.max("_to").alias("session_end"),
            F.sum("_n").alias("events"),
            F.sum("_v").alias("total"),
        )
        .drop("_no")
    )


def funnel(
    df: DataFrame, by: str, ts: str, kind: str, steps: Sequence[str], limits: Limits = DEFAULT
) -> DataFrame:
    """Per key the time each step was first reached after the one before it.

    Column ``step_<n>`` is null from the first step a key did not reach; keys
    that never took the first step are left out. One scan and one shuffle:
    along each key's events a running minimum tells when the step before was
    first reached, and an event counts for its step if it lies later.
    """
    events = df.where(F.col(kind).isin(list(steps))).select(by, ts, kind)
    names = [f"step_{n}" for n in range(1, len(steps) + 1)]
    order = [F.asc(ts)]
    in_time = Window.partitionBy(by).orderBy(*order)

    def along(rows: DataFrame, scan: Callable[[DataFrame, Scan], DataFrame]) -> DataFrame:
        rows = rows.withColumn(names[0], F.when(F.col(kind) == steps[0], F.col(ts)))
        for before, name, step in zip(names, names[1:], steps[1:]):
            # Strictly later, so the order among equal times does not matter.
            hit = (F.col(kind) == step) & (F.col(ts) > F.col("_since"))
            rows = scan(rows, min_scan(F.col(before))).withColumn(name, F.when(hit, F.col(ts))).drop("_since")
        return rows

    reached = over_groups(
        events,
        [by],
        order,
        lambda rows: along(rows, lambda part, s: part.withColumn("_since", s.within(in_time))),
        lambda rows: along(rows, lambda part, s: scan_slices(part, [by], order, {"_since": s})),
        limits,
    )
    first = reached.groupBy(by).agg(*[F.min(name).alias(name) for name in names])
    return first.where(F.col(names[0]).isNotNull())
