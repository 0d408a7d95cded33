"""Nearest vectors: blocks of queries meet shards of items inside their cell, as rows of a shuffle.

Neither side passes through the driver. A group is one (cell, shard, block), so its size hangs on
the parameters and not on the table or on a hot cell. Every block first meets one shard of each of
its cells; the kth score found there is the bound that rows of the other shards must reach.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamra.session import cut

BLOCK, SHARD = 4_096, 32_768
SLICE = 1_024  # items scored at once: a block times a slice is the largest array of a task, 32 MB, and a few such lie side by side


def top(scored: DataFrame, k: int, by: str = "query_id", item: str = "chunk_id") -> DataFrame:
    """The ``k`` best items per query, ties by item. Spark keeps ``k`` per task before the shuffle."""
    best = W.partitionBy(by).orderBy(F.desc("score"), item)
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def nearest(queries: DataFrame, items: DataFrame, k: int, metric: str = "cosine", places: int = 6,
            block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``query_id, item, score, rank``: the ``k`` items of the highest score for each query.

    ``queries`` has ``query_id, embedding``, ``items`` has ``item, embedding``, both with ids of their
    own and vectors of one length; rows without id or vector take no part. With a column ``cell`` on
    both sides a query meets only the items of its cells. ``metric`` is ``cosine`` (zero vectors
    score 0) or ``distance`` (minus the squared distance). Scores are rounded to ``places``, ties go
    to the smaller item. A query that meets nothing has no rows.
    """
    asked = queries.filter("query_id IS NOT NULL AND embedding IS NOT NULL")
    given = items.filter("item IS NOT NULL AND embedding IS NOT NULL")
    if "cell" not in asked.columns:
        asked, given = asked.withColumn("cell", F.lit(0)), given.withColumn("cell", F.lit(0))

    def pieces(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    sizes = cut(pieces(asked, block, "blocks").join(pieces(given, shard, "shards"), "cell"))  # a row a cell
    most = sizes.agg(F.max("shards")).first()[0] or 0
    asked = asked.join(sizes, "cell").withColumn("_b", F.pmod(F.xxhash64("query_id"), "blocks").cast("int"))
    given = given.join(sizes, "cell").withColumn("_s", F.pmod(F.xxhash64("item"), "shards").cast("int"))
    home = F.pmod(F.col("_b"), F.col("shards"))
    all_blocks, all_shards = F.sequence(F.lit(0), F.col("blocks") - 1), F.sequence(F.lit(0), F.col("shards") - 1)

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, item {items.schema['item'].dataType.simpleString()}, score double"
        keys = ["cell", "_b", "_s"]
        theirs = [f"{c}_of_item" for c in keys]  # names of their own: both sides may come from one table
        dealt = right.select(*(F.col(c).alias(t) for c, t in zip(keys, theirs)), "item", F.col("embedding").alias("vector"))
        return left.select(*keys, "query_id", "embedding", "least").groupBy(*keys).cogroup(
            dealt.groupBy(*theirs)).applyInPandas(_best(k, metric, places), schema)

    first = meet(asked.withColumn("_s", home).withColumn("least", F.lit(None).cast("double")),
                 given.withColumn("_b", F.explode(F.filter(all_blocks, lambda b: b % F.col("shards") == F.col("_s")))))
    if most < 2:
        return top(first, k, item="item")
    first = cut(top(first, k, item="item"))
    bound = first.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    rest = meet(
        asked.join(bound, "query_id", "left").withColumn("_s", F.explode(F.filter(all_shards, lambda s: s != home))),
        given.withColumn("_b", F.explode(F.filter(all_blocks, lambda b: b % F.col("shards") != F.col("_s")))))
    return top(first.drop("rank").unionByName(rest), k, item="item")


def _best(k: int, metric: str, places: int) -> Callable:
    """The kernel of a group: slices of items, each above the kth score of those before."""
    import numpy as np
    import pandas as pd

    def matrix(vectors) -> np.ndarray:
        rows = np.stack(vectors.to_numpy()).astype("float64")
        if metric == "cosine":
            norms = np.linalg.norm(rows, axis=1, keepdims=True)
            rows = np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)
        return rows

    def run(asked, items):
        if asked.empty or items.empty:
            return pd.DataFrame({"query_id": asked["query_id"][:0], "item": items["item"][:0], "score": np.zeros(0)})
        items = items.sort_values("item")
        q, v = matrix(asked["embedding"]), matrix(items["vector"])
        q_size, v_size = (q * q).sum(1), (v * v).sum(1)
        least = asked["least"].to_numpy(dtype="float64", na_value=-np.inf)
        row, place, score = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
        for at in range(0, len(v), SLICE):
            part = q @ v[at:at + SLICE].T
            if metric == "distance":
                part *= 2
                part -= q_size[:, None]
                part -= v_size[None, at:at + SLICE]
            np.round(part, places, out=part)
            n = part.shape[1]
            if n > k:
                least = np.maximum(least, np.partition(part, n - k, axis=1)[:, n - k])
            r, c = np.nonzero(part >= least[:, None])
            row, place, score = (np.concatenate(x) for x in ((row, r), (place, c + at), (score, part[r, c])))
            order = np.lexsort((place, -score, row))
            row, place, score = row[order], place[order], score[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, place, score = row[keep], place[keep], score[keep]
        return pd.DataFrame({"query_id": asked["query_id"].to_numpy()[row], "item": items["item"].to_numpy()[place], "score": score + 0.0})

    return run
