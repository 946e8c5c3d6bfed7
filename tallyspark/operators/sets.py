"""Set operations on DataFrames with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A value's copies are written out by as many tasks as this needs.
COPIES_PER_TASK = 100_000


def combine(a: DataFrame, b: DataFrame, kind: str) -> DataFrame:
    """union, intersect or except, each also with ``_all`` (multiset) meaning.

    The distinct forms drop repeats on both sides first, so that the join
    Spark makes of them meets every value once.
    """
    b = b.select(*a.columns)
    if kind == "union_all":
        return a.unionByName(b)
    if kind == "union":
        return a.unionByName(b).distinct()
    if kind == "intersect":
        return a.distinct().intersect(b.distinct())
    if kind == "intersect_all":
        return _copies(a, b, lambda in_a, in_b: F.least(in_a, in_b))
    if kind == "except":
        return a.distinct().subtract(b.distinct())
    if kind == "except_all":
        return _copies(a, b, lambda in_a, in_b: in_a - in_b)
    raise ValueError(f"unknown set operation {kind!r}")


def _copies(a: DataFrame, b: DataFrame, keep, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Each value as often as ``keep(copies in a, copies in b)`` says.

    Copies are counted before the shuffle. The built-in forms do that too, but
    let one task write all copies of a value; here they are dealt out in
    chunks, so a value with very many copies is shared among tasks.
    """
    values = a.columns
    sides = a.withColumn("_in_a", F.lit(1)).unionByName(b.withColumn("_in_a", F.lit(0)))
    counts = sides.groupBy(*values).agg(F.sum("_in_a").alias("_a"), F.sum(1 - F.col("_in_a")).alias("_b"))
    kept = counts.withColumn("_n", keep(F.col("_a"), F.col("_b"))).where(F.col("_n") > 0)
    size = F.lit(copies_per_task)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / size)))
    chunks = kept.select(*values, "_n", chunk.alias("_chunk"))
    # A fixed number of partitions: the rows are few bytes here, and adaptive
    # execution would put them together again before they multiply.
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(tasks, *values, "_chunk")
    here = F.least(size, F.col("_n") - F.col("_chunk") * size).cast("int")
    return dealt.select(*values, F.explode(F.array_repeat(F.lit(True), here)).alias("_copy")).drop("_copy")
