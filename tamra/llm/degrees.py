"""Links of each set: all pairs inside a component, compared on whole sets.

Sets whose similarity reaches the threshold share a component, so components hold every link. The
sets of one are dealt over blocks bounded in members and shingles, and a task sees two blocks at a
time. Its pairs are counted in one array and never become rows: a row a set and pair of blocks leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamra.llm.order import stored
from tamra.llm.sets import sets_of

MEMBERS = 1_024  # sets of a block
SHINGLES = 500_000  # of a block, about
FEW = 64  # sets that share a shingle are paired one by one up to here, else by a product of matrices
WIDTH = 4_096  # shingles of a product


def overlaps(sets: list[np.ndarray], first: int) -> np.ndarray:
    """Number of shared elements of each of the ``first`` sets with each of the others, or of all with all if ``first`` is all."""
    across = first < len(sets)
    rows, columns = (first, len(sets) - first) if across else (first, first)
    shared = np.zeros((rows, columns), np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    few = (seen[code] > 1) & (seen[code] <= FEW)
    order = np.lexsort((owner[few], code[few]))
    token, at = code[few][order], owner[few][order]
    for apart in range(1, FEW):
        same = np.flatnonzero(token[apart:] == token[:-apart])
        if not len(same):
            break
        a, b = at[same], at[same + apart]
        if across:
            kept = (a < first) & (b >= first)
            np.add.at(shared, (a[kept], b[kept] - first), 1)
        else:
            np.add.at(shared, (a, b), 1)
            np.add.at(shared, (b, a), 1)
    many = seen[code] > FEW
    number = np.cumsum(seen > FEW) - 1
    token, at = number[code[many]], owner[many]
    order = np.argsort(token, kind="stable")
    token, at = token[order], at[order]
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, WIDTH):
        a, b = np.searchsorted(token, (low, low + WIDTH))
        holds = np.zeros((len(sets), min(WIDTH, int(token[-1]) + 1 - low)), np.float32)
        holds[at[a:b], token[a:b] - low] = 1
        shared += holds[:first] @ (holds[first:] if across else holds).T
    return shared


def _counted(key: tuple[int, int, int], held: dict[int, tuple[int, bytes]], percent: int) -> pa.RecordBatch:
    """(class, links) of a task's two blocks, given block and set of each class; a block with itself if they are one."""
    _, i, j = key
    name = np.array(sorted(held, key=lambda c: held[c][0]), np.int64)
    sets = [np.frombuffer(held[c][1], np.uint64) for c in name.tolist()]
    across = i != j
    first = sum(block == i for block, _ in held.values())
    links = np.zeros(len(sets), np.int64)
    if 0 < first and (not across or first < len(sets)):
        n = np.array([len(s) for s in sets])
        shared = overlaps(sets, first).astype(np.int64)
        others = n[first:] if across else n
        alike = 100 * shared >= percent * (n[:first, None] + others[None, :] - shared)
        if across:
            links[:first], links[first:] = alike.sum(1), alike.sum(0)
        else:
            np.fill_diagonal(alike, False)
            links = alike.sum(1)
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(links, pa.int64())], names=["class", "links"])


def degrees(groups: DataFrame, sizes: DataFrame, docs: DataFrame, firsts: DataFrame, words: int, percent: int) -> DataFrame:
    """(class, n_verified): links of each class of ``groups`` (class, part) that has company; ``sizes`` holds class and n.

    The one link of a component of two sets is known; larger components are compared.
    """
    totals = groups.join(sizes.select("class", "n"), "class").groupBy("part").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("members") / MEMBERS), F.ceil(F.col("shingles") / SHINGLES)).cast("int")
    company = stored(groups.join(totals.where("members > 1").select("part", "members", blocks.alias("blocks")), "part"), "company")
    wanted = company.where("members > 2").withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int")).join(firsts, "class")
    wanted = stored(wanted.select(F.col("first").alias("key"), "class", "part", "block", "blocks"), "wanted")
    met = sets_of(wanted, docs, words).join(wanted, ["key", "class"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "class", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            part, i, j, block, name = (batch.column(c).to_pylist() for c in range(5))
            for at in range(batch.num_rows):
                if key != (part[at], i[at], j[at]):
                    if key is not None:
                        yield _counted(key, held, percent)
                    key, held = (part[at], i[at], j[at]), {}
                held[name[at]] = block[at], batch.column(5)[at].as_py()  # a row of a key may come twice
        if key is not None:
            yield _counted(key, held, percent)

    counted = met.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j").mapInArrow(run, "class bigint, links bigint")
    pairs = company.where("members = 2").select("class", F.lit(1).cast("long").alias("links"))
    return counted.unionByName(pairs).groupBy("class").agg(F.sum("links").alias("n_verified"))
