"""Event-time windows, sessions and repeat removal on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def watermarked(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time must carry a zone; zoneless times are read in the session zone."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def _spanned(grouped: DataFrame, span: str) -> DataFrame:
    names = [c for c in grouped.columns if c != span]
    return grouped.select(
        F.col(f"{span}.start").cast("timestamp_ntz").alias(f"{span}_start"),
        F.col(f"{span}.end").cast("timestamp_ntz").alias(f"{span}_end"),
        *names,
    )


def windowed(
    stream: DataFrame, ts: str, size: str, slide: str | None, delay: str, keys: Sequence[str], aggs: dict[str, Column]
) -> DataFrame:
    """Tumbling windows, or sliding ones if ``slide`` is given.

    A window comes out once, when the watermark passes its end. Rows are
    combined per task before they reach the state, so a hot key costs one
    update per window and task.
    """
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = watermarked(stream, ts, delay).groupBy(span.alias("window"), *keys)
    return _spanned(grouped.agg(*[a.alias(n) for n, a in aggs.items()]), "window")


def stream_sessions(
    stream: DataFrame, ts: str, gap: str, delay: str, keys: Sequence[str], aggs: dict[str, Column]
) -> DataFrame:
    """Sessions that end ``gap`` after their last event.

    Events of one micro-batch are merged into sessions inside each task first
    (a session setting), so a hot key reaches the state as a few sessions.
    """
    span = F.session_window(ts, gap).alias("session")
    grouped = watermarked(stream, ts, delay).groupBy(span, *keys)
    return _spanned(grouped.agg(*[a.alias(n) for n, a in aggs.items()]), "session")


def stream_dedupe(stream: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """One row per key among rows at most ``delay`` apart; the state forgets
    a key when the watermark has passed it."""
    return watermarked(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys))
