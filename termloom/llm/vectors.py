"""Exact top-k inner products with a KD-tree per shard.

Candidate vectors are dealt out to shards of bounded size.  Each shard is cut at medians into a
tree whose nodes know their tight bounding box.  Queries travel in blocks of bounded size, first
to one shard, whose k-th best score becomes a bound, then to all others together with it.  In a
shard a query visits nodes in the order of the highest inner product that their box allows and
stops at the first that cannot reach its k-th score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.session import settle

SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LEAF_ROWS = 256

_FOUND = "query_id bigint, vec_id bigint, score bigint"


class KdTree:
    """Median splits along the widest side of each node's bounding box."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.arange(len(ids))
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[tuple[int, int]] = []
        low, high = [], []
        waiting = [(0, len(ids), -1, 0)]
        while waiting:
            start, end, parent, side = waiting.pop()
            own = points[order[start:end]]
            node = len(self.rows)
            self.rows.append((start, end))
            self.children.append(None)
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            if parent >= 0:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            widest = int(np.argmax(high[-1].astype(float) - low[-1].astype(float)))
            if end - start > leaf_rows and high[-1][widest] > low[-1][widest]:
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(own[:, widest], middle)]
                waiting += [(start, start + middle, node, 0), (start + middle, end, node, 1)]
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The highest inner product that each node's box allows, per query."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, least: int | None):
        """Best ``k`` (score, id) of other rows, best first, none below ``least``."""
        best: list[tuple] = []  # a heap with the worst on top: (score, -id)
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            floor = best[0][0] if len(best) == k else least
            if floor is not None and -bound < floor:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], child))
                continue
            start, end = self.rows[node]
            scores = self.points[start:end] @ query
            enough = np.flatnonzero(scores >= floor) if floor is not None else range(end - start)
            for at in enough:
                entry = (int(scores[at]), -int(self.ids[start + at]))
                if -entry[1] == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(score, -id_) for score, id_ in sorted(best, reverse=True)]


def quantised(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of every component; unusable vectors are left out."""
    x = F.col(vector_column)
    usable = x.isNotNull() & F.col(id_column).isNotNull() & (F.size(x) > 0)
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != F.lit(float("inf")))
    )
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("bigint"))
    return vectors.filter(usable & F.coalesce(finite, F.lit(False))).select(
        F.col(id_column).cast("bigint").alias("vec_id"), whole.alias("vector")
    )


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` rows with the highest inner product for each row whose id ``every`` divides.

    Components are floor(scale * x).  A row is no candidate for itself or for a row of the same
    id; a repeated row is a candidate once for each occurrence, and of query rows of one id the
    smallest vector asks.  Ties go to the smaller id.
    Vectors that are null, empty or hold a null or non-finite component, rows without an id, and
    queries of another length than the candidates take no part: vectors of each width meet their
    own.  Other columns, whatever their names, are left behind.  An empty table gives no rows.
    Scores must fit 63 bits.

    Returns query_id, rank (int, from 1), vec_id, score.
    """
    points = settle(quantised(vectors, id_column, vector_column, scale), "vectors")
    n = points.count()
    n_shards = max(1, -(-n // shard_rows))
    n_blocks = max(1, -(-n // (every * block_rows)))
    width = F.size("vector").alias("width")
    spread = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n_shards)).cast("int")
    shards = settle(points.select("vec_id", "vector", width, spread.alias("shard")), "shards")
    queries = points.filter(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id"))
    queries = queries.agg(F.min("vector").alias("vector")).select("query_id", "vector", width)
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int").alias("block")
    queries = settle(queries.withColumn("block", block), "queries")

    # Each block first goes to one shard, for a bound on the k-th scores, then to the others.
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
    met = F.col("shard") == F.pmod(F.col("block"), F.lit(n_shards))
    sides = shards.select("*", every_block)
    unbounded = queries.select("*", F.lit(None).cast("bigint").alias("least"), every_shard)
    near = settle(_in_shards(sides.filter(met), unbounded.filter(met), k), "near")
    floors = near.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    floors = floors.select("query_id", F.when(F.col("n") >= k, F.col("least")).alias("least"))
    bounded = queries.join(floors, "query_id", "left").select(*queries.columns, "least", every_shard)
    found = near.unionByName(_in_shards(sides.filter(~met), bounded.filter(~met), k))

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _in_shards(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of each shard for each query of the blocks that are sent there."""
    by = ["shard", "block", "width"]
    pairs = points.groupBy(*by).cogroup(queries.groupBy(*by))
    return pairs.applyInPandas(partial(_search_shard, k=k), _FOUND)


def _search_shard(points: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Search one shard for one block of queries."""
    found: list[tuple[int, int, int]] = []
    if len(points) and len(queries):
        matrix = np.stack(points["vector"].to_numpy()).astype(np.int64)
        wanted = np.stack(queries["vector"].to_numpy()).astype(np.int64)
        largest = float(np.abs(matrix).max()) * float(np.abs(wanted).max()) * matrix.shape[1]
        if largest < 2**53:  # then sums of doubles are exact, and faster
            matrix, wanted = matrix.astype(float), wanted.astype(float)
        tree = KdTree(points["vec_id"].to_numpy(), matrix)
        for query_id, query, bounds, least in zip(
            queries["query_id"].tolist(), wanted, tree.bounds(wanted), queries["least"], strict=True
        ):
            best = tree.search(query_id, query, bounds, k, None if pd.isna(least) else int(least))
            found += [(query_id, vec_id, score) for score, vec_id in best]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")
