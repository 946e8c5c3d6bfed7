"""Values that more than one row in so many holds, found exactly in bounded memory.

First pass: each task keeps a summary of at most ``one_in`` counters. When a
batch brings more, the largest count that does not fit is taken off all of them,
and what falls to zero goes. By that a value loses at most its task's rows
divided by the number of counters, so one with more than that share of them is
still there at the end. A value above the share of all rows is above it in some
task: no heavy hitter is missed. Second pass: only the candidates are counted,
exactly, and those at or below the share go.

Nulls are values like others. No rows give no values.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.ordered import join_small
from tallyspark.session import pinned


def trimmed(counts: dict, most: int) -> dict:
    """At most ``most`` of the counters, each less by the largest count that must go."""
    if len(counts) <= most:
        return counts
    off = sorted(counts.values(), reverse=True)[most]
    return {k: n - off for k, n in counts.items() if n > off}


def _summaries(names: Sequence[str], most: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, int] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            found = pa.table(batch).append_column("_n", pa.array([1] * batch.num_rows, pa.int64())).group_by(list(names)).aggregate([("_n", "sum")])
            columns = [found.column(c).to_pylist() for c in names]
            for n, *value in zip(found.column("_n_sum").to_pylist(), *columns):
                key = tuple(value)
                counts[key] = counts.get(key, 0) + n
            counts = trimmed(counts, most)
        if counts:
            rows = list(zip(*counts))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, schema)], names=list(names))

    return summarise


def heavy_hitters(df: DataFrame, columns: Sequence[str], one_in: int) -> DataFrame:
    """(columns.., n) of the values that more than one row in ``one_in`` holds."""
    if one_in < 1:
        raise ValueError(f"one row in {one_in} is no share")
    rows = df.select(*[f"`{c}`" for c in columns])
    found = rows.mapInArrow(_summaries(columns, one_in), rows.schema).distinct()
    candidates = pinned(found, "candidates")
    counted = join_small(rows, candidates, columns, "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1))).first()[0]
    return counted.where(F.col("n") * one_in > total)
