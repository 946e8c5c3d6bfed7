"""State of one's own per key, across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyspark.functions.udfs import batch_partials


def running_state(stream: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, version, n, total, peak) after every micro-batch that touched the
    key: count, sum and maximum of its values so far, nulls left out.

    Rows are reduced batch by batch before the shuffle. A key with a third of
    all rows so reaches its state as one short row per ten thousand of them,
    and not as the rows themselves. Values are whole numbers (cents, say), so
    sums are exact in any order.
    """
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), value.cast("long").alias("value")).where(F.col("value").isNotNull())

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        version, n, total, peak = state.get if state.exists else (0, 0, 0, None)
        for batch in batches:
            n += int(batch["n"].sum())
            total += int(batch["total"].sum())
            top = int(batch["peak"].max())
            peak = top if peak is None else max(peak, top)
        state.update((version + 1, n, total, peak))
        yield pd.DataFrame({"key": [group[0]], "version": [version + 1], "n": [n], "total": [total], "peak": [peak]})

    reduced = rows.mapInArrow(batch_partials(["key"], "value"), f"key {kind}, n bigint, total bigint, peak bigint")
    return reduced.groupBy("key").applyInPandasWithState(
        step,
        f"key {kind}, version bigint, n bigint, total bigint, peak bigint",
        "version bigint, n bigint, total bigint, peak bigint",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def latest_state(history: DataFrame) -> DataFrame:
    """(key, n, total, peak): the newest state of each key."""
    newest = history.groupBy("key").agg(F.max_by(F.struct("n", "total", "peak"), "version").alias("s"))
    return newest.select("key", "s.n", "s.total", "s.peak")
