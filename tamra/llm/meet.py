"""Members of a bucket meet in blocks: every pair of different components that may be similar enough.

A bucket is a hash table's entry or a shingle's list. Its members are dealt over blocks of bounded
size by hash, and a task sees two blocks at a time, so no bucket is held by one task. Inside a
task pairs are compared by size and parity bitmap, which bound the similarity from above; only
what passes leaves the task. Many small buckets share a task and its batches.

Crowded buckets, which groups of near copies make, give each member's most similar partner first
(``nearest``): a row a member, which joins most of such a group before all that is left of its
pairs may leave.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamra.llm.sets import bitmaps

BLOCK = 1_024  # members of a bucket that meet as many others at once
CROWD = 32  # members of a bucket whose nearest partners are joined first

# Given the columns of a task's bucket by name, a row and the rows it might pair with: which of those it may.
Admit = Callable[[dict[str, np.ndarray], int, np.ndarray], np.ndarray]


def over_parts(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` of those values of ``by`` that hold more than one ``part``, with the number of rows of each as ``size``."""
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("size"), F.min("part").alias("_low"), F.max("part").alias("_high"))
    return rows.join(sizes.where("_low <> _high").select(by, "size"), by)


def _buckets(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of one (bucket, i, j) after another; a bucket may lie in several batches."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {c: bitmaps(batch.column(at)) if pa.types.is_binary(batch.column(at).type) or pa.types.is_large_binary(batch.column(at).type)
                   else batch.column(at).to_numpy(zero_copy_only=False) for at, c in enumerate(names)}
        keys = np.stack([columns[c] for c in ("bucket", "i", "j")])
        ends = np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, batch.num_rows)
        begin = 0
        for end in ends.tolist():
            if held and begin == 0 and any(held[-1][c][0] != columns[c][0] for c in ("bucket", "i", "j")):
                yield {c: np.concatenate([h[c] for h in held]) for c in names}
                held = []
            held.append({c: columns[c][begin:end] for c in names})
            if end < batch.num_rows:
                yield held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in names}
                held = []
            begin = end
    if held:
        yield {c: np.concatenate([h[c] for h in held]) for c in names}


def _close(x: dict[str, np.ndarray], percent: int, admit: Admit | None, nearest: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows): partners of other parts, none smaller, whose similarity may reach ``percent``; with ``nearest`` the likeliest."""
    order = np.argsort(x["n"], kind="stable")
    x = {c: v[order] for c, v in x.items()}
    n, part, bits, block = x["n"].astype(np.int64), x["part"], x["bits"], x["block"]
    stops = np.searchsorted(n, n * 100 // percent, "right")
    name, across = x["class"], x["i"][0] != x["j"][0]
    for a in range(len(n) - 1):
        if stops[a] <= a + 1:
            continue
        ok = part[a + 1:stops[a]] != part[a]
        if across:
            ok &= block[a + 1:stops[a]] != block[a]
        at = np.flatnonzero(ok) + a + 1
        if len(at):
            apart = np.bitwise_count(bits[at] ^ bits[a]).sum(1, dtype=np.int64)
            most = np.minimum((n[at] + n[a] - apart) // 2, n[a])
            fits = most * (100 + percent) >= percent * (n[at] + n[a])
            at, most = at[fits], most[fits]
            if nearest and len(at):
                best = int(np.argmax(most / (n[at] + n[a] - most)))
                at = at[best:best + 1]
        if len(at) and admit is not None:
            at = at[admit(x, a, at)]
        if len(at):
            yield name[a], name[at]


def pairs(rows: DataFrame, payload: DataFrame, percent: int, admit: Admit | None = None, nearest: bool = False) -> DataFrame:
    """(a, b, bucket): classes of different parts that share a bucket and may reach the similarity.

    ``rows`` holds bucket, class, part, size (of the bucket) and what ``admit`` asks for; ``payload``
    holds class, n, bits and more of that. A pair is given once for each bucket that admits it;
    with ``nearest`` a member gives one pair a task at most.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    met = rows.join(payload, "class").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class", "bucket"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks", "size")
    names = met.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate([f[c] for f in found]).astype(np.int64) for c in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(columns[0], columns[1])), pa.array(np.maximum(columns[0], columns[1])), pa.array(columns[2])],
                                              names=["a", "b", "bucket"])

        for x in _buckets(batches, names):
            for a, others in _close(x, percent, admit, nearest):
                found.append((np.full(len(others), a), others, np.full(len(others), x["bucket"][0])))
                held += len(others)
                if held >= 100_000:
                    yield flush()
                    found, held = [], 0
        if found:
            yield flush()

    dealt = met.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.mapInArrow(run, "a bigint, b bigint, bucket bigint")
