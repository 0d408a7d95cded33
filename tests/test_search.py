"""Blocked vector search against numpy, with many blocks and shards, ties, hot cells and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamra.operators import index, retrieve
from tamra.operators.search import nearest


def tables(spark, n_queries, n_items, dims=6, seed=3):
    rng = np.random.default_rng(seed)
    q = rng.integers(-3, 4, (n_queries, dims)).astype("float64")  # small integers: many ties
    v = rng.integers(-3, 4, (n_items, dims)).astype("float64")
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "query_id bigint, embedding array<double>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "item int, embedding array<double>")
    return q, v, queries, items


def brute(q, v, k, metric, places, allowed=lambda i, j: True):
    out = set()
    for i, a in enumerate(q):
        scored = []
        for j, b in enumerate(v):
            if allowed(i, j):
                size = np.linalg.norm(a) * np.linalg.norm(b)
                score = -((a - b) ** 2).sum() if metric == "distance" else (a @ b / size if size else 0.0)
                scored.append((-round(float(score), places), j))
        out |= {(i, j, round(-s, places) + 0.0, r) for r, (s, j) in enumerate(sorted(scored)[:k], 1)}
    return out


def rows_of(df, places):
    return {(r.query_id, r.item, round(r.score, places) + 0.0, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("metric", ["cosine", "distance"])
@pytest.mark.parametrize("block, shard", [(1000, 1000), (9, 25), (40, 7)])
def test_nearest_is_exact_for_any_cut(spark, metric, block, shard):
    q, v, queries, items = tables(spark, 30, 90)
    got = nearest(queries, items, 4, metric, 6, block, shard)
    assert rows_of(got, 6) == brute(q, v, 4, metric, 6)


def test_cells_hot_and_absent(spark):
    q, v, queries, items = tables(spark, 24, 120)
    cell = lambda n: 0 if n % 3 else n % 7  # noqa: E731  cell 0 holds most rows
    named = F.udf(cell, "int")
    asked = queries.withColumn("cell", named("query_id"))
    given = items.withColumn("cell", named("item")).filter("cell <> 3")
    got = nearest(asked, given, 5, block=4, shard=11)
    assert rows_of(got, 6) == brute(q, v, 5, "cosine", 6, lambda i, j: cell(i) == cell(j) != 3)


def test_odd_rows_and_empty_tables(spark):
    _, _, queries, items = tables(spark, 4, 6)
    odd = queries.unionByName(spark.createDataFrame([(None, [0.0] * 6), (9, None)], queries.schema))
    assert {r.query_id for r in nearest(odd, items.unionByName(spark.createDataFrame([(None, [1.0] * 6)], items.schema)), 9).collect()} == {0, 1, 2, 3}
    assert nearest(queries, items.filter("item < 0"), 3).collect() == []
    assert nearest(queries.filter("query_id < 0"), items, 3).collect() == []


def test_index_finds_most_of_the_exact_neighbours(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    points = centres[rng.integers(0, 12, 600)] + 0.4 * rng.normal(size=(600, 16))
    vectors = spark.createDataFrame([(str(i), p.tolist()) for i, p in enumerate(points)], "chunk_id string, embedding array<double>")
    queries = vectors.select(F.col("chunk_id").cast("bigint").alias("query_id"), "embedding").filter("query_id % 10 = 0")
    placed, cells = index.build_ivf(vectors)
    assert cells.count() == 24 and placed.count() == 600
    pair = lambda df: {(r.query_id, r.chunk_id) for r in df.collect()}
    exact = pair(retrieve.dense_topk(queries, vectors, 10))
    found = pair(retrieve.ann_topk(queries, placed, cells, 10, 8, block=16, shard=20))
    assert len(exact & found) >= 0.9 * len(exact)
    assert pair(retrieve.ann_topk(queries, placed, cells, 10, 24, block=16, shard=20)) == exact
