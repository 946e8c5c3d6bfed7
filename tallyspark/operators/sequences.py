"""Events that follow one another in a given pattern, for groups of any size.

A pattern is a list of steps, each a kind of event that comes in a row:
``[("view", 1, None), ("click", 1, 3), ("purchase", 1, 1)]`` is, as a regular
expression over a group's events in order, ``view+ click{1,3} purchase``. Events
are first reduced to runs of one kind, which needs no more than a running sum
(hot groups are cut in slices); a match is then a few neighbouring runs, found
by looking back as many rows as there are steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tallyspark.functions.exact import micros
from tallyspark.operators.frames import row_frames
from tallyspark.operators.ordered import DEFAULT, Limits, previous_scan, scan_groups, sum_scan

Step = tuple[str, int, int | None]


def runs(df: DataFrame, by: Sequence[str], order: Sequence[Column], kind: str, ts: str, limits: Limits = DEFAULT) -> DataFrame:
    """(by.., run, kind, n, first, last): each run of events of one kind, numbered from 1; null is a kind, too."""
    rows = df.select(*by, *[c for c in df.columns if c not in by])
    known = scan_groups(rows, by, order, {"_prev": previous_scan(F.struct(F.col(kind).alias("kind")))}, limits)
    fresh = F.col("_prev").isNull() | ~F.col("_prev.kind").eqNullSafe(F.col(kind))
    numbered = scan_groups(known.withColumn("_fresh", fresh.cast("int")), by, order, {"run": sum_scan(F.col("_fresh"))}, limits)
    return numbered.groupBy(*by, "run").agg(
        F.first(kind).alias("kind"), F.sum(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )


def sequences(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], kind: str, ts: str, steps: Sequence[Step], seconds: int | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """(by.., started_at, ended_at, counts) of every match of the steps.

    ``order`` is total and begins with ``ts``. A match takes all events of its
    first run, and of its last one the first event: the first step is without an
    upper bound and the last one is a single event. Neighbouring steps, and the
    first and the last, are of different kinds, so matches cannot overlap.
    ``seconds`` bounds the time from the last event of the first step to the end.
    ``counts`` are the events of each step.
    """
    kinds = [k for k, _, _ in steps]
    if len(steps) < 2 or steps[0][2] is not None or tuple(steps[-1][1:]) != (1, 1):
        raise ValueError("the first step is open above, the last is one event, and there are two steps at least")
    if kinds[0] == kinds[-1] or any(a == b for a, b in zip(kinds, kinds[1:])):
        raise ValueError("neighbouring steps, and the first and the last, are of different kinds")
    back = len(steps) - 1
    whole = F.struct("kind", "n", "first", "last")

    def make(w: WindowSpec) -> dict[str, Column]:
        return {f"_s{i}": F.lag(whole, back - i).over(w) for i in range(back)}

    found = row_frames(runs(df, by, order, kind, ts, limits), by, [F.asc("run")], back, 0, make, limits)
    found = found.withColumn(f"_s{back}", whole)
    fits = F.lit(True)
    for i, (name, least, most) in enumerate(steps):
        fits = fits & (F.col(f"_s{i}.kind") == name) & (F.col(f"_s{i}.n") >= least)
        if most is not None and i < back:
            fits = fits & (F.col(f"_s{i}.n") <= most)
    if seconds is not None:
        fits = fits & (micros("first") - micros("_s0.last") <= seconds * 1_000_000)
    counts = F.array(*[F.col(f"_s{i}.n") for i in range(back)], F.lit(1).cast("long"))
    return found.where(fits).select(*by, F.col("_s0.first").alias("started_at"), F.col("first").alias("ended_at"), counts.alias("counts"))
