"""Connected components by alternating stars: every node learns its smallest neighbour.

Groups are only ever reduced to a minimum and joined back, so that a node with
very many neighbours is no more than a skewed join key. Edges with a null end
and loops say nothing; repeated edges are one. No edges give no labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import pinned, released


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang a node's larger (or else its smaller) neighbours on the smallest of them and itself."""
    if large:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = sides.join(least, "u")
    hung = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return hung.union(own).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v): the smallest node that it is connected with."""
    edges = pinned(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        edges, old = pinned(_star(_star(edges, True), False), "edges"), edges
        released(old)
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    every = edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots.select("node", F.col("node").alias("label")))
    labels = pinned(every, "labels")
    released(edges)
    return labels
