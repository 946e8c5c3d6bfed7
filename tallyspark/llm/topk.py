"""Exact top-k by inner product with M-trees.

Inner products become distances by one more component: with M the longest
vector's length, x gets sqrt(M^2 - |x|^2) and a query 0, so that
d^2 = |q|^2 + M^2 - 2 q.x, and the nearest are those of the largest products.

Rows are dealt to the nearest of a bounded sample of pivots, and a pivot's rows
by a hash into blocks of bounded size. Every block gets an M-tree, stored as
pages: the entries of a node with their routing vectors, covering radii, and
distances to the parent's routing vector. A search takes nodes best first. What
the triangle inequality over stored distances rules out is never computed; the
rest of a page is computed at once. A query searches one block of its nearest
pivot first; the k-th score found there rules out pivots, and serves as the
first bound in the blocks that remain. Scores are whole numbers, computed exactly;
bounds only ever leave out what is strictly worse, so ties come out right.

Nulls: a null vector, one with a null or non-finite component, and a null id
take no part. Vectors of fewer components count as if filled up with zeros.
Candidates of the query's id are its own and left out. Repeated rows are
candidates of their own; a repeated query is answered for each row. Components
must stay below 2^24 in size, so that products are exact. No rows or no queries
give an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tallyspark.llm.common import parts_for, pinned


@dataclass(frozen=True)
class Index:
    pivots: int = 512  # at most; sampled by hash from all rows
    pivot_rows: int = 8_192  # rows for which there is a pivot, while that makes fewer
    block_rows: int = 8_192  # rows of a tree, on average at most
    page: int = 64  # entries of a node
    query_rows: int = 1_024  # queries that one task takes against a block


# Distances are square roots of whole numbers; this is more than their rounding.
_SLACK = 1e-6


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int = 1024) -> DataFrame:
    """(vec_id, vector) with components floor(scale * x), without the rows that take no part."""
    x = F.col(vector)
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    some = rows.where(F.col(key).isNotNull() & fine)
    return some.select(F.col(key).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.empty((0, 0))


class _Builder:
    """One block's pages, from its augmented vectors."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, page: int) -> None:
        self.ids, self.points, self.page = ids, points, page
        self.pages: list[dict] = []

    def build(self) -> list[dict]:
        every = np.arange(len(self.ids))
        self._node(every, self.points[0])
        return self.pages

    def _far(self, rows: np.ndarray, center: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[rows] - center) ** 2).sum(axis=1))

    def _node(self, rows: np.ndarray, parent: np.ndarray) -> int:
        number = len(self.pages)
        page: dict = {"node": number}
        self.pages.append(page)
        if len(rows) <= self.page:
            page |= {"leaf": True, "entry": self.ids[rows], "center": self.points[rows, :-1], "radius": np.zeros(len(rows)), "parent": self._far(rows, parent)}
            return number
        count = min(self.page, -(-len(rows) // self.page))
        count = max(count, 2)
        centers = rows[:: len(rows) // count][:count]
        squares = (self.points**2).sum(axis=1)
        distance = squares[rows][:, None] + squares[centers] - 2 * self.points[rows] @ self.points[centers].T
        own = distance.argmin(axis=1)
        if (own == own[0]).all():  # equal vectors: by turns
            own = np.arange(len(rows)) % count
        children, kept, radii = [], [], []
        for c in np.unique(own):
            below = rows[own == c]
            center = self.points[centers[c]]
            kept.append(centers[c])
            radii.append(self._far(below, center).max())
            children.append(self._node(below, center))
        page |= {
            "leaf": False, "entry": np.array(children), "center": self.points[kept, :-1], "radius": np.array(radii),
            "parent": self._far(np.array(kept), parent), "lift": self.points[kept, -1],
        }
        return number


_PAGES = StructType(
    [StructField("pivot", LongType()), StructField("block", LongType()), StructField("node", LongType()), StructField("leaf", LongType())]
    + [StructField("entry", ArrayType(LongType())), StructField("center", ArrayType(DoubleType())), StructField("root", ArrayType(DoubleType()))]
    + [StructField("radius", ArrayType(DoubleType())), StructField("parent", ArrayType(DoubleType()))]
)


def _tree_of(page_size: int, longest: float):
    def tree(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        vectors = _matrix(rows["vector"])
        lift = np.sqrt(np.maximum(longest - (vectors**2).sum(axis=1), 0))
        points = np.hstack([vectors, lift[:, None]])
        pages = _Builder(rows["vec_id"].to_numpy(np.int64), points, page_size).build()
        return pd.DataFrame(
            {
                "pivot": key[0], "block": key[1], "node": [p["node"] for p in pages], "leaf": [int(p["leaf"]) for p in pages],
                "entry": [p["entry"] for p in pages], "center": [p["center"].ravel() for p in pages],
                "root": [vectors[0] if p["node"] == 0 else None for p in pages],
                "radius": [p["radius"] for p in pages], "parent": [p["parent"] for p in pages],
            }
        )

    return tree


class _Tree:
    """A block's pages, read back."""

    def __init__(self, pages: pd.DataFrame, longest: float) -> None:
        self.longest = longest
        self.nodes = {}
        for p in pages.itertuples():
            count = len(p.entry)
            self.nodes[p.node] = (bool(p.leaf), np.asarray(p.entry, np.int64), np.asarray(p.center, float).reshape(count, -1), np.asarray(p.radius, float), np.asarray(p.parent, float))
            if p.node == 0:
                self.root = np.asarray(p.root, float)

    def search(self, query: np.ndarray, own: int, k: int, floor_score: float) -> list[tuple[int, int]]:
        """The k best (score, id), leaving out ``own`` and scores below the floor."""
        reach = float(query @ query) + self.longest  # d^2 = reach - 2 * score
        least = floor_score
        found: list[tuple[int, int]] = []
        heap = [(0.0, 0, np.sqrt(max(reach - 2 * float(query @ self.root), 0.0)))]
        while heap:
            bound, node, to_parent = heapq.heappop(heap)
            limit = np.sqrt(max(reach - 2 * least, 0.0)) * (1 + _SLACK) + _SLACK if least > -np.inf else np.inf
            if bound > limit:
                break
            leaf, entry, center, radius, parent = self.nodes[node]
            some = np.abs(to_parent - parent) - radius <= limit
            if not some.any():
                continue
            score = center[some] @ query
            if leaf:
                for i in np.flatnonzero(score >= least):
                    item = (int(score[i]), -int(entry[some][i]))
                    if -item[1] != own:
                        (heapq.heappush if len(found) < k else heapq.heappushpop)(found, item)
                if len(found) == k:
                    least = max(least, found[0][0])
            else:
                distance = np.sqrt(np.maximum(reach - 2 * score, 0))
                low = np.maximum(np.maximum(distance - radius[some], 0), bound)
                for i in np.flatnonzero(low <= limit):
                    heapq.heappush(heap, (float(low[i]), int(entry[some][i]), float(distance[i])))
        return [(s, -i) for s, i in found]


def _searcher(longest: float, k: int):
    def run(queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int, int, int]] = []
        if len(queries) and len(pages):
            tree = _Tree(pages, longest)
            vectors = _matrix(queries["vector"])
            for q, own, vector, least in zip(queries["_q"], queries["vec_id"], vectors, queries["least"]):
                rows += [(q, own, s, i) for s, i in tree.search(vector, own, k, -np.inf if np.isnan(least) else least)]
        return pd.DataFrame(rows, columns=["_q", "query_id", "score", "vec_id"]).astype("int64")

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 10, index: Index = Index()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is a query the k rows of the largest
    inner product, equal ones by the smaller id. ``rows`` are (vec_id, vector) of whole numbers."""
    spark = rows.sparkSession
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    filled = F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(width) - F.size("vector"), F.lit(0))))
    norm = F.aggregate("vector", F.lit(0).cast("long"), lambda s, v: s + v * v)
    kept = pinned(rows.select("vec_id", filled.alias("vector")).select("*", norm.alias("norm"), F.monotonically_increasing_id().alias("_q")), "vectors")
    count, longest = kept.agg(F.count(F.lit(1)), F.max("norm")).first()
    if not count or not width:  # no vector, or none with a component
        return _ranked(spark.createDataFrame([], "_q long, query_id long, score long, vec_id long"), k)
    longest = float(longest)

    n = min(index.pivots, parts_for(count, index.pivot_rows))
    chosen = kept.orderBy(F.xxhash64("vector"), "vec_id").limit(n).select("vector", "norm").collect()
    pivots = np.array([r["vector"] for r in chosen], float)
    lifted = np.sqrt(np.maximum(longest - np.array([r["norm"] for r in chosen], float), 0))

    def assign(batches):
        for batch in batches:
            v = _matrix(batch["vector"])
            squares = (v**2).sum(axis=1)
            lift = np.sqrt(np.maximum(longest - squares, 0))
            d2 = 2 * longest - 2 * (v @ pivots.T + lift[:, None] * lifted)  # all points have length M
            own = d2.argmin(axis=1)
            out = batch[["vec_id", "vector", "_q"]].copy()
            out["pivot"] = own
            # From the differences, which lose less than the squares do.
            out["far"] = np.sqrt(((v - pivots[own]) ** 2).sum(axis=1) + (lift - lifted[own]) ** 2)
            yield out

    dealt = pinned(kept.mapInPandas(assign, "vec_id long, vector array<long>, _q long, pivot long, far double"), "dealt")
    facts = {r["pivot"]: r for r in dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect()}
    blocks = spark.createDataFrame([(p, parts_for(r["n"], index.block_rows)) for p, r in facts.items()], "pivot long, blocks long")
    own_block = F.pmod(F.xxhash64("vec_id", "_q"), F.col("blocks"))
    placed = dealt.join(F.broadcast(blocks), "pivot").withColumn("block", own_block)  # a row per pivot at most
    pages = pinned(placed.groupBy("pivot", "block").applyInPandas(_tree_of(index.page, longest), _PAGES), "pages")

    queries = dealt.where(is_query).select("_q", "vec_id", "vector")
    chunks = parts_for(queries.count(), index.query_rows)
    queries = queries.withColumn("chunk", F.pmod(F.xxhash64("_q"), F.lit(chunks)))
    copies = pages.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    search = _searcher(longest, k)
    out = "_q long, query_id long, score long, vec_id long"
    key = ["pivot", "block", "chunk"]

    radius = np.array([facts[p]["radius"] if p in facts else -np.inf for p in range(n)])

    def reachable(batches):
        """The pivots that may hold one of the k best: the nearest first, then those within the bound."""
        for batch in batches:
            v = _matrix(batch["vector"])
            reach = (v**2).sum(axis=1) + longest
            d = np.sqrt(np.maximum(reach[:, None] - 2 * v @ pivots.T, 0)) - radius
            least = batch["least"].to_numpy(float)
            limit = np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(reach - 2 * np.nan_to_num(least), 0)) * (1 + _SLACK) + _SLACK)
            first = batch["first"].to_numpy(bool)
            d[:, radius < 0] = np.inf
            pick = np.where(first[:, None], np.arange(n) == d.argmin(axis=1)[:, None], (d <= limit[:, None]) & (radius >= 0))
            i, p = np.nonzero(pick)
            got = batch[["_q", "vec_id", "vector", "chunk", "least"]].iloc[i].copy()
            got["pivot"] = p
            yield got

    near = "_q long, vec_id long, vector array<long>, chunk long, least double, pivot long"
    # One block of the pivot that reaches nearest gives a first bound.
    asked = queries.withColumns({"least": F.lit(None).cast("double"), "first": F.lit(True)})
    first = asked.mapInPandas(reachable, near).withColumn("block", F.lit(0).cast("long"))
    begun = first.groupBy(*key).cogroup(copies.where("block = 0").groupBy(*key)).applyInPandas(search, out)
    bound = begun.groupBy("_q").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("low"))
    bound = pinned(bound.select("_q", F.when(F.col("n") == k, F.col("low")).alias("least")), "bounds")
    again = queries.join(bound, "_q", "left").withColumn("first", F.lit(False))
    rest = again.mapInPandas(reachable, near).join(F.broadcast(blocks), "pivot")
    rest = rest.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    found = rest.groupBy(*key).cogroup(copies.groupBy(*key)).applyInPandas(search, out)
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
