"""Exact top-k by inner product: a KD-tree in every shard, searched best first.

Vectors become integers (floor of ``scale`` times each component). A shard's points are split
at the median of their widest dimension down to leaves; every node keeps its tight bounding
box. The highest inner product a box allows, sum(max(q * lo, q * hi)), orders a best-first
traversal that ends when no open box can beat the kth score so far.

Each query is first searched in its own shard; the kth score found there goes with it to all
other shards, which drop what cannot reach it. Queries and shards meet as blocks of bounded
size, one task a pair of blocks, so no task holds all queries or all vectors. Every query meets
every shard; the boxes decide how much of it is read.

Cases: null vectors, and vectors with a null or non-finite component or without any, take no
part as query or candidate, nor does a row without id; vectors of another length than the
query's are no candidates; rows that share the query's id are its own; a query row that repeats
asks once, and a repeated query id with other vectors asks once with each; repeated candidates each
count; ties go to the smaller id; fewer candidates than k are all returned; an empty table gives no
rows. Scores are exact: vectors so large that doubles could round are multiplied as Python integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamra.llm.order import stored

SHARD_ROWS = 8_192  # vectors of a shard, about
QUERY_ROWS = 4_096  # queries of a block, about
LEAF_ROWS = 128
BOUND_BLOCK = 256  # queries whose bounds for all boxes are computed at once


@dataclass
class Tree:
    points: np.ndarray
    ids: np.ndarray
    lo: np.ndarray  # box of each node
    hi: np.ndarray
    left: list[int]  # child nodes; -1 for a leaf
    right: list[int]
    begin: list[int]  # rows of a leaf
    end: list[int]


def build(points: np.ndarray, ids: np.ndarray) -> Tree:
    order = np.arange(len(points))
    lo, hi, left, right, begin, end = [], [], [], [], [], []
    waiting = [(0, len(points), -1, False)]
    while waiting:
        a, b, parent, is_left = waiting.pop()
        node, rows = len(begin), order[a:b]
        here = points[rows]
        lo.append(here.min(0))
        hi.append(here.max(0))
        left.append(-1)
        right.append(-1)
        begin.append(a)
        end.append(b)
        if parent >= 0:
            (left if is_left else right)[parent] = node
        widest = int(np.argmax(hi[-1] - lo[-1]))
        if b - a > LEAF_ROWS and hi[-1][widest] > lo[-1][widest]:
            mid = (b - a) // 2
            order[a:b] = rows[np.argpartition(here[:, widest], mid)]
            waiting += [(a, a + mid, node, True), (a + mid, b, node, False)]
    return Tree(points[order], ids[order], np.array(lo), np.array(hi), left, right, begin, end)


def search(tree: Tree, queries: np.ndarray, query_ids: np.ndarray, kth: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(number of the query, id, score) of at most k candidates a query; only scores of ``kth`` or more."""
    found = []
    for block in range(0, len(queries), BOUND_BLOCK):
        q = queries[block:block + BOUND_BLOCK]
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        bounds = up @ tree.hi.T + down @ tree.lo.T
        for i, (query, own) in enumerate(zip(q, query_ids[block:block + BOUND_BLOCK].tolist())):
            bound, least, best = bounds[i], kth[block + i], []  # best: heap of (score, -id)
            open_nodes = [(-bound[0], 0)]
            while open_nodes:
                top, node = heapq.heappop(open_nodes)
                if -top < least:
                    break
                if tree.left[node] >= 0:
                    for child in (tree.left[node], tree.right[node]):
                        if bound[child] >= least:
                            heapq.heappush(open_nodes, (-bound[child], child))
                    continue
                a, b = tree.begin[node], tree.end[node]
                scores = tree.points[a:b] @ query
                for j in np.flatnonzero(scores >= least).tolist():
                    if tree.ids[a + j] == own or scores[j] < least:
                        continue
                    entry = (scores[j], -int(tree.ids[a + j]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    else:
                        heapq.heappushpop(best, entry)
                    if len(best) == k:
                        least = max(least, best[0][0])
            found += [(block + i, -other, int(s)) for s, other in best]
    return found


def _matrix(frame: pd.DataFrame) -> np.ndarray:
    """Exact integers as doubles where all products stay below 2 ** 53, else as Python integers."""
    whole = np.floor(np.stack(frame["v"].to_numpy()))
    most = float(np.abs(whole).max())
    if most * most * whole.shape[1] < 2.0 ** 52:
        return whole
    return np.array([[int(x) for x in row] for row in whole.tolist()], object)


def _usable(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score): the k highest inner products of every query."""
    v = F.col(vector)
    rows = vectors.where(F.col(key).isNotNull() & _usable(v)).select(
        F.col(key).cast("long").alias("id"), is_query.alias("q"), F.xxhash64(key).alias("h"),
        F.transform(v, lambda x: x.cast("double") * scale).alias("v"))
    rows = stored(rows.withColumn("dim", F.size("v")), "vectors")
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1))).first()
    shards, groups = max(1, -(-counts[0] // SHARD_ROWS)), max(1, -(-counts[1] // QUERY_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.col("h"), F.lit(shards)).cast("int"))
    # the high bits deal queries to blocks, so blocks and shards are independent
    queries = rows.where("q").dropDuplicates(["id", "v"]).select(F.xxhash64("id", "v").alias("ask"), "id", "v", "dim", "shard", F.pmod(F.shiftrightunsigned("h", 32), F.lit(groups)).cast("int").alias("block"))
    queries = queries.toDF(*queries.columns)
    columns = "ask bigint, query_id bigint, id bigint, score bigint"

    def within(_key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"ask": [], "query_id": [], "id": [], "score": []}, dtype="int64")
        left, right = left.sort_values("id", kind="stable"), right.sort_values("id", kind="stable")
        points, asked = _matrix(left), _matrix(right)
        if object in (points.dtype, asked.dtype):
            points, asked = (np.array([[int(x) for x in r] for r in m.tolist()], object) for m in (points, asked))
        kth = right["kth"].to_numpy() if "kth" in right else np.full(len(right), -np.inf)
        found = search(build(points, left["id"].to_numpy()), asked, right["id"].to_numpy(), kth, k)
        ask, own = right["ask"].to_numpy(), right["id"].to_numpy()
        return pd.DataFrame([(ask[i], own[i], j, s) for i, j, s in found], columns=["ask", "query_id", "id", "score"], dtype="int64")

    keys = ["dim", "shard", "block"]
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    candidates = rows.select("id", "v", "dim", "shard", all_blocks.alias("block"))
    home = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(within, columns)
    home = stored(home, "home-hits")
    kth = home.groupBy("ask").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    kth = kth.select("ask", F.when(F.col("n") >= k, F.col("least").cast("double")).alias("kth"))
    asked = queries.join(kth, "ask", "left").fillna(float("-inf"), ["kth"])
    elsewhere = asked.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("to <> shard")
    elsewhere = elsewhere.select("ask", "id", "v", "dim", F.col("to").alias("shard"), "block", "kth")
    elsewhere = elsewhere.toDF(*elsewhere.columns)  # names of their own, apart from the candidates'
    away = candidates.groupBy(*keys).cogroup(elsewhere.groupBy(*keys)).applyInPandas(within, columns)
    ranked = Window.partitionBy("ask").orderBy(F.desc("score"), "id")
    hits = home.unionByName(away).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return hits.select("query_id", "rank", F.col("id").alias(key), "score")
