"""Balanced contiguous shards from global prefix sums.

Rows are put in order over range partitions. Each partition's total size and
row count give, summed over the partitions before it, where the partition
starts in the whole; sums inside it place each row. The line of all bytes is
cut at equal targets, and a row goes to the shard in which its middle lies.

Nulls: a null size counts as 0; null order keys come first. Rows alike in all
order keys are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import parts_for, pinned

ROWS_PER_PART = 100_000


def balanced(rows: DataFrame, order: Sequence[str], size: str, shards: int, per_part: int = ROWS_PER_PART) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot``, the row's place in its shard from 0.

    ``rows`` is written once; pass narrow rows where the rest isn't needed.
    """
    spark = rows.sparkSession
    # Written first, so that the numbers of equal rows stay, whatever is computed again.
    rows = rows.drop("shard", "slot")
    kept = pinned(rows.withColumn("_tie", F.monotonically_increasing_id()), "shard-rows")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, parts_for(kept.count(), per_part))
    ranged = kept.repartitionByRange(n, *order, "_tie").withColumn("_part", F.spark_partition_id())
    placed = pinned(ranged, "shard-parts")
    weight = F.coalesce(F.col(size), F.lit(0)).cast("long")

    totals = placed.groupBy("_part").agg(F.sum(weight).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy(*order, "_tie")
    local = placed.withColumns(
        {
            "_in": F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_number": F.row_number().over(inside) - 1,
        }
    ).join(starts, "_part")
    # Twice the middle of the row, so that everything stays a whole number.
    local = local.withColumns(
        {
            "_middle": 2 * (F.col("_bytes_before") + F.col("_in")) + weight,
            "_twice": 2 * F.greatest("_all", F.lit(1)),
            "_number": F.col("_rows_before") + F.col("_number"),
        }
    )
    local = local.withColumn("shard", F.least(F.expr(f"_middle * {int(shards)} div _twice"), F.lit(shards - 1)).cast("int"))
    local = local.drop("_middle", "_twice")
    local = local.drop("_in", "_bytes_before", "_rows_before", "_all")
    # No more rows than shards, so sending them to every task is safe.
    firsts = local.groupBy("shard").agg(F.min("_number").alias("_first"))
    out = local.join(F.broadcast(firsts), "shard").withColumn("slot", (F.col("_number") - F.col("_first")).cast("long"))
    return out.select(*[f"`{c}`" for c in rows.columns], "shard", "slot")


def text_size(text: Column, overhead: int = 8) -> Column:
    """UTF-8 bytes of a text, null as none, and what a stored row needs besides."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")
