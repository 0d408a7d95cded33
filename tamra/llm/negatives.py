"""Hard-negative mining by Kronecker-packed products.

Vectors become integers (floor of ``scale`` times each component). Within a task several
candidates share one wide integer for each component: every component is biased to be
non-negative and takes a field of its own, wide enough for a whole biased product, so no field
ever carries into the next. One multiplication with the anchor's biased component then advances
the products of all candidates of the word; after the last component the fields are cut apart
and the biases taken off, which leaves exact scores. Words are 64-bit integers of numpy where
two fields fit, else Python integers of any width.

Anchors and candidates meet as blocks of bounded size, one task a pair of blocks, twice: first
for the positives of each anchor (its highest scores among rows of its own label), then, with
the positives' scores, for the highest rows of other labels inside each positive's window. A
task gives at most ``positives`` rows an anchor, then ``negatives`` rows a positive. Every anchor
meets every candidate, which is the work asked for; no block of a task grows with the table.

Cases: rows with a null id, a null label, a null or empty vector, or a null or non-finite
component take no part; vectors of another length than the anchor's are no candidates; rows that
share the anchor's id are its own, and an anchor id that repeats asks once for every distinct
(label, vector); repeated candidates each count; ties go to the smaller id; fewer rows than asked
for are all returned; an empty table gives no rows; other columns are left out. A score is given
as a 64-bit integer; one beyond that is held at its end, also where it bounds a window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamra.llm.order import stored

CANDIDATE_ROWS = 8_192  # of a block, about
ANCHOR_ROWS = 4_096
WORDS_AT_ONCE = 1 << 21  # products of a step, which bounds a task's memory
WIDE_BITS = 1_024  # of a Python integer
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def floors(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of floors: 64-bit integers where they are small, else Python integers."""
    rows = np.floor(np.stack(vectors))
    if float(np.abs(rows).max()) < 2.0 ** 31:
        return rows.astype(np.int64)
    return np.array([[int(x) for x in row] for row in rows.tolist()], object)


class Packed:
    """Candidates packed into wide integers, several to a word."""

    def __init__(self, candidates: np.ndarray, most_anchor: int) -> None:
        """``most_anchor`` bounds the anchors' components from above in size."""
        n, self.dim = candidates.shape
        self.n, self.low, self.bias = n, most_anchor, max(0, -int(candidates.min()))
        top = self.dim * (2 * most_anchor) * (int(candidates.max()) + self.bias)  # of a biased product
        self.width = max(1, top.bit_length())
        self.wide = 2 * self.width > 64
        self.fields = max(1, WIDE_BITS // self.width) if self.wide else 64 // self.width
        kind = object if self.wide else np.uint64
        words = -(-n // self.fields)
        biased = (candidates.astype(object) if self.wide else candidates) + self.bias
        self.words = np.zeros((words, self.dim), kind)
        for f in range(self.fields):
            part = biased[f * words:(f + 1) * words].astype(kind)  # field f of word w is candidate f * words + w
            self.words[:len(part)] += part << (f * self.width if self.wide else np.uint64(f * self.width))
        self.total = candidates.sum(1)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, one row an anchor."""
        kind = object if self.wide else np.uint64
        biased = ((anchors.astype(object) if self.wide else anchors) + self.low).astype(kind)
        product = np.zeros((len(anchors), len(self.words)), kind)
        for d in range(self.dim):  # one product for all candidates of a word
            product += np.multiply.outer(biased[:, d], self.words[:, d])
        mask = (1 << self.width) - 1
        mask = mask if self.wide else np.uint64(mask)
        out = np.empty((len(anchors), self.fields, len(self.words)), object if self.wide else np.int64)
        for f in range(self.fields):
            out[:, f] = (product >> (f * self.width if self.wide else np.uint64(f * self.width))) & mask
        out = out.reshape(len(anchors), -1)[:, :self.n]
        # sum (a + low)(c + bias) less what the biases brought
        mine = anchors.astype(object).sum(1) if self.wide else anchors.sum(1)
        all_of = self.total.astype(object) if self.wide else self.total
        return out - (self.bias * mine)[:, None] - (self.low * all_of)[None, :] - self.low * self.bias * self.dim


def _blocks(anchors: np.ndarray, candidates: np.ndarray):
    """(first anchor, scores of some anchors against all candidates)."""
    if object in (anchors.dtype, candidates.dtype):
        anchors, candidates = anchors.astype(object), candidates.astype(object)
    packed = Packed(candidates, max(1, int(np.abs(anchors).max())))
    step = max(1, WORDS_AT_ONCE // max(packed.n, 1))
    for first in range(0, len(anchors), step):
        yield first, packed.scores(anchors[first:first + step])


def _highest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k and scores.dtype != object:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


def _long(score) -> int:
    return min(max(int(score), LEAST), MOST)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def mine(vectors: DataFrame, is_anchor: Column, label: Column | str = "label", positives: int = 5, negatives: int = 3,
         least_percent: int = 50, most_percent: int = 95, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor and each of its positives the first ``negatives`` rows of other labels, by
    score, for which ``least_percent * positive <= 100 * score <= most_percent * positive``.
    """
    label = F.col(label) if isinstance(label, str) else label
    v = F.col(vector)
    rows = vectors.where(F.col(key).isNotNull() & label.isNotNull() & _usable(v)).select(
        F.col(key).cast("long").alias("id"), label.cast("string").alias("label"), is_anchor.alias("asks"), F.xxhash64(key).alias("h"),
        F.transform(v, lambda x: x.cast("double") * scale).alias("v"))
    rows = stored(rows.withColumn("dim", F.size("v")), "vectors")
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asks"), 1))).first()
    shards, groups = max(1, -(-counts[0] // CANDIDATE_ROWS)), max(1, -(-counts[1] // ANCHOR_ROWS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    keys = ["dim", "shard", "block"]
    candidates = rows.select("id", "label", "v", "dim", F.pmod("h", F.lit(shards)).cast("int").alias("shard"), every(groups).alias("block"))
    # the high bits of the hash deal anchors to blocks, the low ones candidates to shards; ask numbers tell repeats of an id apart
    anchors = rows.where("asks").dropDuplicates(["id", "label", "v"]).withColumn("ask", F.xxhash64("id", "label", "v"))
    anchors = stored(anchors.select("ask", "id", "label", "v", "dim", F.pmod(F.shiftrightunsigned("h", 32), F.lit(groups)).cast("int").alias("block")), "anchors")

    def first(_key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids, labels = left["id"].to_numpy(), left["label"].to_numpy(object)
            asked = list(zip(right["ask"].to_numpy(), right["id"].to_numpy(), right["label"]))
            places = {x: np.flatnonzero(labels == x) for x in set(right["label"])}
            for begin, scores in _blocks(floors(right["v"].tolist()), floors(left["v"].tolist())):
                for (ask, own, kind), line in zip(asked[begin:], scores):
                    at = places[kind]
                    at = at[ids[at] != own]
                    at = at[_highest(line[at], ids[at], positives)]
                    found += [(ask, own, int(ids[i]), _long(line[i])) for i in at.tolist()]
        return pd.DataFrame(found, columns=["ask", "anchor_id", "id", "score"]).astype("int64")

    asked = anchors.select("*", every(shards).alias("shard"))
    near = asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(
        lambda k, a, c: first(k, c, a), "ask bigint, anchor_id bigint, id bigint, score bigint")
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "id")
    near = stored(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives), "positives")
    # a list of at most ``positives`` entries goes with its anchor
    known = near.groupBy("ask").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("p"))
    known = known.select("ask", F.transform("p", lambda x: x.place).alias("places"), F.transform("p", lambda x: x.score).alias("scores"))

    def second(_key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids, labels = left["id"].to_numpy(), left["label"].to_numpy(object)
            asked = list(zip(right["ask"].to_numpy(), right["id"].to_numpy(), right["label"], right["places"], right["scores"]))
            others = {x: np.flatnonzero(labels != x) for x in set(right["label"])}
            for begin, scores in _blocks(floors(right["v"].tolist()), floors(left["v"].tolist())):
                for (ask, own, kind, places, known_scores), line in zip(asked[begin:], scores):
                    at = others[kind]
                    at = at[ids[at] != own]
                    hundred = line[at].astype(object) * 100 if line.dtype == object else line[at] * 100
                    for place, score in zip(places.tolist(), known_scores.tolist()):
                        fits = at[(hundred >= least_percent * score) & (hundred <= most_percent * score)]
                        fits = fits[_highest(line[fits], ids[fits], negatives)]
                        found += [(ask, own, place, int(ids[i]), _long(line[i])) for i in fits.tolist()]
        return pd.DataFrame(found, columns=["ask", "anchor_id", "place", "id", "score"]).astype("int64")

    asked = anchors.join(known, "ask").select("*", every(shards).alias("shard"))
    asked = asked.toDF(*asked.columns)
    hard = asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(
        lambda k, a, c: second(k, c, a), "ask bigint, anchor_id bigint, place int, id bigint, score bigint")
    of_pair = Window.partitionBy("ask", "place").orderBy(F.desc("score"), "id")
    hard = hard.withColumn("rank", F.row_number().over(of_pair)).where(F.col("rank") <= negatives)
    pair = near.select("ask", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(pair, ["ask", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
