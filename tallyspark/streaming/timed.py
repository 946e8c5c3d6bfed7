"""Keyed state that acts when event time has passed, not only when rows come.

Baskets: a user's clicks fill a basket. It is bought in the minute of the first
purchase at most ``idle`` after the last click, or else abandoned when that time
has passed. Rows wait in the state until the watermark has passed them and are
then taken in order of time, so the baskets do not depend on how rows were dealt
over micro-batches. A timer at the next minute of interest brings the key back
even when no further row comes for it.

Time is taken in whole minutes: within one, clicks come before purchases. That
lets each task add its rows up by (user, minute) before the shuffle, whatever
their order. Rows whose minute the watermark has passed are late and dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyspark.streaming.windows import watermarked

MINUTE = 60_000  # milliseconds


def _by_minute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one batch by (key, minute)."""
    for batch in batches:
        summed = pa.table(batch).group_by(["key", "minute"]).aggregate([("clicks", "sum"), ("buys", "sum")])
        yield from summed.rename_columns(["key", "minute", "clicks", "buys"]).cast(batch.schema).to_batches()


class _Baskets(StatefulProcessor):
    """Waiting minutes as a map of minute to (clicks, buys), and the open basket."""

    def __init__(self, idle: int) -> None:
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "minute long", "clicks long, buys long")
        self.open = handle.getValueState("open", "opened long, last long, clicks long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            minutes = frame["minute"].astype("int64") // (10**6 * MINUTE if frame["minute"].dtype == "datetime64[ns]" else 1000 * MINUTE)
            for minute, clicks, buys in zip(minutes, frame["clicks"], frame["buys"]):
                at = (int(minute),)
                had = self.waiting.getValue(at) if self.waiting.containsKey(at) else (0, 0)
                self.waiting.updateValue(at, (had[0] + int(clicks), had[1] + int(buys)))
        return self._advance(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._advance(key, timerValues)

    def close(self) -> None:
        pass

    def _advance(self, key, timerValues) -> Iterator[pd.DataFrame]:
        """Take the minutes that the watermark has passed, in order, and set the next timer."""
        passed = timerValues.getCurrentWatermarkInMs() // MINUTE  # rows up to this minute are all here
        basket = self.open.get() if self.open.exists() else None
        done = []

        def abandon(now: int) -> None:
            nonlocal basket
            if basket and now > basket[1] + self.idle:
                done.append((basket[0], basket[1] + self.idle, basket[2], False))
                basket = None

        minutes = sorted((int(m[0]), int(v[0]), int(v[1])) for m, v in self.waiting.iterator())
        later = [m for m in minutes if m[0] > passed]
        for minute, clicks, buys in minutes[: len(minutes) - len(later)]:
            abandon(minute)
            if clicks:
                basket = (basket[0], minute, basket[2] + clicks) if basket else (minute, minute, clicks)
            if buys and basket:
                done.append((basket[0], minute, basket[2], True))
                basket = None
            self.waiting.removeKey((minute,))
        abandon(passed + 1)
        if basket:
            self.open.update(tuple(map(int, basket)))
        else:
            self.open.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        ahead = [m for m in (later[0][0] if later else None, basket[1] + self.idle if basket else None) if m is not None]
        if ahead:
            # A millisecond early, so that the timer is due when the watermark is the minute itself.
            self.handle.registerTimer(max(min(ahead), passed + 1) * MINUTE - 1)
        if done:
            found = pd.DataFrame(done, columns=["opened", "closed", "clicks", "bought"])
            for name in ("opened", "closed"):
                found[name] = pd.to_datetime(found[name] * MINUTE, unit="ms", utc=True)
            yield pd.DataFrame({"key": key[0], **found})


def baskets(stream: DataFrame, key: str, ts: str, kind: str, delay: str, idle_minutes: int) -> DataFrame:
    """(key, opened_at, closed_at, clicks, bought) of each basket, once it is settled.

    ``kind`` holds 'click', 'purchase' or what is left out. Rows without a key
    or time are left out.
    """
    minute = F.date_trunc("minute", F.col(ts).cast("timestamp"))
    rows = stream.where(F.col(kind).isin("click", "purchase") & F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("key"), minute.alias("minute"),
        (F.col(kind) == "click").cast("long").alias("clicks"), (F.col(kind) == "purchase").cast("long").alias("buys"),
    )
    type_of = rows.schema["key"].dataType.simpleString()
    # The watermark stands below the sums: they are made anew for each micro-batch.
    summed = watermarked(rows.mapInArrow(_by_minute, rows.schema), "minute", delay)
    found = summed.groupBy("key").transformWithStateInPandas(
        _Baskets(idle_minutes),
        outputStructType=f"key {type_of}, opened timestamp, closed timestamp, clicks long, bought boolean",
        outputMode="append",
        timeMode="eventTime",
    )
    return found.select(
        "key", F.col("opened").cast("timestamp_ntz").alias("opened_at"), F.col("closed").cast("timestamp_ntz").alias("closed_at"), "clicks", "bought"
    )
