"""Running a stream over everything that is there, then stopping."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import shared_path
from tallyspark.sources.merged import Merged


def run_available(stream: DataFrame, out: str, checkpoint: str) -> list:
    """Process all input not yet seen and append the result to ``out``.

    The trigger still works in micro-batches. Progress and state live in
    ``checkpoint``: after a failure, or when more input has come, the same
    call goes on where the last one stopped, and the file sink drops a batch
    it already holds. Returns the progress reports of the latest batches: Spark
    keeps ``spark.sql.streaming.numRecentProgressUpdates`` of them, 100 by default.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return query.recentProgress


def finished(stream: DataFrame, label: str, kept: str | None = None) -> DataFrame:
    """The whole result of a stream as a batch table in the shared folder.

    With a folder ``kept`` the result and the state stay there, and a later
    call with it goes on: windows and sessions that were open come out once
    newer input has closed them. Without it each call starts afresh.
    """
    spark = stream.sparkSession
    out = f"{kept}/out" if kept else shared_path(spark, f"{label}-out")
    run_available(stream, out, f"{kept}/state" if kept else shared_path(spark, f"{label}-state"))
    return spark.read.schema(stream.schema).parquet(out)


def run_merged(stream: DataFrame, into: Merged, checkpoint: str) -> list:
    """Process all input not yet seen and merge what changed, by key, into a table.

    For results that are brought up to date (``update`` mode): each micro-batch
    hands on the keys it touched, and the table holds the newest row of each
    key, also of windows still open. A micro-batch that is run again after a
    failure has the same number, so it is merged once.
    """
    query = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda rows, number: into.merge(rows, number) and None)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.recentProgress


def replayed(rows: DataFrame, ts: str, edges: Sequence[object], label: str, run: Callable[[DataFrame], object]) -> None:
    """Feed a table to a stream in order of time: ``run`` is called on the stream after each slice.

    ``edges`` are the times between slices, growing; rows without a time come
    first. A slice is read by a filter on the time and written to the folder
    that the stream watches, so a micro-batch holds no later row than the next
    one and the backlog is never one batch.
    """
    spark = rows.sparkSession
    folder = shared_path(spark, f"{label}-in")
    bounds = [None, *edges, None]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        some = rows if low is None else rows.where(F.col(ts) >= F.lit(low))
        if high is not None:
            some = some.where((F.col(ts) < F.lit(high)) | F.col(ts).isNull() if low is None else F.col(ts) < F.lit(high))
        some.write.parquet(f"{folder}/{i}")
        run(spark.readStream.schema(rows.schema).parquet(f"{folder}/*"))
