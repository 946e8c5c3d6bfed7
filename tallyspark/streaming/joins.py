"""Joins of a stream with a table, and of two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.streaming.windows import watermarked


def enrich(stream: DataFrame, dim: DataFrame, on: tuple[str, str], how: str = "left") -> DataFrame:
    """Stateless join with a table that has one row per key.

    The table is read again for each micro-batch. Catalyst broadcasts it only
    below its size threshold; above it, adaptive execution (which Spark keeps
    on for stateless streams) splits a hot key of the stream.
    """
    return stream.join(dim, F.col(on[0]) == F.col(on[1]), how)


def match(
    left: DataFrame, right: DataFrame, on: tuple[str, str], times: tuple[str, str], seconds: int, delay: str, how: str = "inner"
) -> DataFrame:
    """Pairs of equal key with the right time 0 to ``seconds`` before the left.

    With ``how`` "left_outer" a left row without a partner comes out, too, as
    soon as the watermark of both streams has passed it: no partner can come
    any more then, and its state is dropped.

    Both watermarks and the time bound let Spark drop state that can no
    longer match. The time cells in the join key spread one hot key over many
    state partitions and keep distant rows of a key from meeting.
    """
    l_ts, r_ts = times
    l = watermarked(left, l_ts, delay)
    r = watermarked(right, r_ts, delay)
    width = F.lit(seconds * 1_000_000.0)
    l = l.withColumn("_l_cell", F.floor(F.unix_micros(F.col(l_ts)) / width))
    r_first = F.floor(F.unix_micros(F.col(r_ts)) / width)
    r = r.withColumn("_r_cell", F.explode(F.array(r_first, r_first + 1)))
    opens = F.col(l_ts) - F.expr(f"interval {seconds} seconds")
    on_time = (F.col(r_ts) <= F.col(l_ts)) & (F.col(r_ts) >= opens)
    same = (F.col(on[0]) == F.col(on[1])) & (F.col("_l_cell") == F.col("_r_cell"))
    return l.join(r, same & on_time, how).drop("_l_cell", "_r_cell")
