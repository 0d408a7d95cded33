"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds the distinct hashes of its word shingles; equal sets are one class from
the start, so copies cost one row each. Sets are put in one order for all documents (rare
shingles first, the frequent ones, found by counting in every task, last). Two sets of Jaccard
t or more that take the first ``n - ceil(t n) + l`` shingles share at least l of them. Every
document picks its own l where the estimated cost is least: a longer prefix costs more, but asks
for l shared shingles before a pair's sets are compared; a pair needs the smaller l of the two.

Any l asks for one shared shingle of the plain prefix (level 1), so pairs meet in the lists of
those alone, and only then are their whole prefixes counted and, where enough is shared, their
sets compared. Lists grow with groups of near copies, so no list is paired with itself: a few
lists of each class are first compared with the smallest class in them, and in crowded lists each
member with its nearest partner, which joins most of a group in linear work; what then lies in different components meets in blocks (``meet``), where
size and parity bitmaps bound the similarity from above before a pair leaves its task, and it
leaves the first list that it shares as far as a class's smallest shingles tell. Every link
between different components is found and checked on whole sets. ``join`` then compares all sets
inside each component (``degrees``), so that it counts every link, also those that no component needs.

Cases: a null text, or one without words, has an empty set and is linked with nothing (its
component is its own id); fewer words than a shingle make one shingle; rows that share an id are
judged by text and share their component's smallest id; a null id is left out; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamra.llm import meet
from tamra.llm.degrees import degrees
from tamra.llm.order import bounded, stored
from tamra.llm.sets import class_of, classes_of, linked, near_size, parity, parts, possible, sets, whole_sets

FREQUENT = 200_000  # shingles whose estimated frequency is sent to all tasks, most frequent first
COUNTED = 3_000_000  # shingles counted at once in a task
POSTING_COST = 4.0  # of one more prefix row, in units of one compared shingle
LONGEST = 32  # most shared shingles asked for
STARS = 4  # lists of a class in which it is compared with the smallest class
KNOWN = 8  # smallest shingles of a class that travel with it, to tell where a pair met before


def _profiles(docs: DataFrame, words: int) -> DataFrame:
    """One row a document (key, n, class, bits), and rows (token, seen) of shingles that a task met twice."""
    kind = docs.schema["key"].dataType.simpleString()
    names = ["key", "n", "class", "bits", "token", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, met = [], 0, set()

        def counted() -> pa.RecordBatch:
            token, seen = np.unique(np.concatenate(held), return_counts=True)
            token, seen = token[seen > 1].astype(np.int64), seen[seen > 1]
            none = [pa.nulls(len(token), t) for t in (kinds, pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([*none, pa.array(token), pa.array(seen, pa.int64())], names=names)

        last, keys, n, classes, bits, kinds = None, [], [], [], [], None

        def profiled() -> pa.RecordBatch:
            nulls = pa.nulls(len(n), pa.int64())
            return pa.RecordBatch.from_arrays([last.column(0).take(pa.array(keys, pa.int64())), pa.array(n, pa.int64()),
                                               pa.array(classes, pa.int64()), pa.array(bits, pa.binary()), nulls, nulls], names=names)

        for batch, i, s in sets(batches, words):
            if last is not batch:
                if last is not None:
                    yield profiled()
                last, keys, n, classes, bits, kinds = batch, [], [], [], [], batch.column(0).type
            name = class_of(s) if len(s) else None
            keys.append(i)
            n.append(len(s))
            classes.append(name)
            bits.append(parity(s).tobytes() if len(s) else None)
            if len(s) and name not in met:
                met.add(name)
                held.append(s)
                size += len(s)
                if size >= COUNTED:
                    yield counted()
                    held, size, met = [], 0, set()
        if last is not None:
            yield profiled()
        if held:
            yield counted()

    return docs.mapInArrow(run, f"key {kind}, n bigint, class bigint, bits binary, token bigint, seen bigint")


class Prefixes:
    """The common order of shingles and the prefix each set takes in it."""

    def __init__(self, tokens: np.ndarray, seen: np.ndarray, partners: float, percent: int) -> None:
        self.tokens, self.seen, self.partners, self.percent = tokens, seen, partners, percent

    def of(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(tokens of the prefix, match level at which each enters, asked matches l)."""
        n = len(s)
        signed = s.astype(np.int64)
        seen = np.zeros(n, np.int64)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, signed), len(self.tokens) - 1)
            known = self.tokens[at] == signed
            seen[known] = self.seen[at[known]]
        order = np.lexsort((signed, seen))
        overlap = -(-self.percent * n // 100)
        first = n - overlap + 1
        most = min(overlap, LONGEST)
        met = np.cumsum(np.where(seen[order] > 0, seen[order] - 1.0, self.partners))
        matches = np.arange(1, most + 1)
        cost = POSTING_COST * (first + matches - 1) + n * met[first + matches - 2] / matches
        asked = int(np.argmin(cost)) + 1
        taken = order[:first + asked - 1]
        level = np.maximum(np.arange(len(taken)) - first + 2, 1)
        return signed[taken], level, asked


def _postings(docs: DataFrame, prefixes: Prefixes, words: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(prefixes)  # at most FREQUENT shingles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, met = [], 0, set()

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate([h[c] for h in held]) for c in range(5)]
            return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), *(pa.array(c, pa.int32()) for c in columns[2:])],
                                              names=["token", "class", "n", "level", "asked"])

        for _, _, s in sets(batches, words):
            name = class_of(s) if len(s) else None
            if name is None or name in met:
                continue
            met = met if len(met) < COUNTED else set()
            met.add(name)
            tokens, level, asked = sent.value.of(s)
            full = np.full(len(tokens), 1, np.int64)
            held.append((tokens, full * name, full * len(s), level, full * asked))
            size += len(tokens)
            if size >= 200_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(run, "token bigint, class bigint, n int, level int, asked int")


def _matched(pairs: DataFrame, prefix: DataFrame) -> DataFrame:
    """The pairs (a, b) that share as many shingles of their prefixes as the smaller l asks for."""
    both = pairs
    for side in ("a", "b"):
        both = both.join(prefix.select(F.col("class").alias(side), F.col("asked").alias(f"asked_{side}"), F.col("taken").alias(f"taken_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = np.minimum(batch.column(2).to_numpy(), batch.column(4).to_numpy())
            keep = np.zeros(batch.num_rows, bool)
            for i, l in enumerate(asked.tolist()):
                taken = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64).reshape(2, -1) for c in (3, 5))
                mine, others = (t[0][t[1] <= l] for t in taken)
                keep[i] = len(np.intersect1d(mine, others, assume_unique=True)) >= l
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return both.select("a", "b", "asked_a", "taken_a", "asked_b", "taken_b").mapInArrow(run, "a bigint, b bigint")


def _prefix_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, asked, taken): shingles of a prefix and the level at which each enters, one after the other."""
    for batch in batches:
        token, level = (batch.column(2).flatten().field(f).to_numpy().astype(np.int64) for f in ("token", "level"))
        ends = np.concatenate([[0], np.cumsum(batch.column(2).value_lengths().to_numpy())])
        packed = [token[a:b].tobytes() + level[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["class", "asked", "taken"])


def _unseen(x: dict[str, np.ndarray], a: int, at: np.ndarray) -> np.ndarray:
    """Pairs that no smaller list of both is known to hold."""
    known = x["known"].view(np.int64)
    earlier = known[a][known[a] < x["order"][a]]
    return ~np.isin(known[at], earlier).any(1)


def join(docs: DataFrame, words: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, n_verified): components of the links between different sets.

    ``n_verified`` counts the links from the document's set to other sets, all of them verified on
    whole sets. Copies count none.
    """
    rows = judged(docs, words, percent, key, text, count_links=True)
    return rows.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified"))


def one_of_each(docs: DataFrame, words: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies, all columns as they are: of each component one row of its smallest id.

    Rows are told apart by id and set, so a row whose id also names a near copy stays if its own
    text is none. Rows without an id, and texts without words, are near copies of nothing.
    """
    found = judged(docs, words, percent, key, text).where("class is not null")
    marked = found.select(F.col("key").alias("_near_key"), F.col("class").alias("_near_class"), F.col("part").alias("_near_part"),
                          (F.col("component_id") != F.col("key")).alias("_near_copy"))
    several = marked.where("not _near_copy").groupBy("_near_part").agg((F.count(F.lit(1)) > 1).alias("_near_again")).where("_near_again")
    marked = marked.distinct().join(several, "_near_part", "left")

    @F.arrow_udf("bigint")
    def named(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        return pa.array([class_of(s) if len(s) else None for _, _, s in sets([batch], words, 0)], pa.int64())

    rows = docs.withColumn("_near_class", named(F.col(text))).withColumn("_near_key", F.col(key))
    rows = rows.join(marked, ["_near_key", "_near_class"], "left").where(~F.coalesce("_near_copy", F.lit(False)))
    once = rows.where(F.coalesce("_near_again", F.lit(False)))  # the smallest id stands in several rows of its component
    order = Window.partitionBy("_near_part").orderBy("_near_class", F.sha2(F.col(text), 256))
    once = once.withColumn("_near_rank", F.row_number().over(order)).where("_near_rank = 1")
    alone = rows.where(~F.coalesce("_near_again", F.lit(False)))
    return alone.select(*docs.columns).unionByName(once.select(*docs.columns))


def judged(docs: DataFrame, words: int, percent: int, key: str, text: str, count_links: bool = False) -> DataFrame:
    """(key, n, class, part, component_id) of every row with an id; an empty set has no class. With ``count_links`` also ``n_verified``."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col(key).isNotNull())
    bounded(docs.sparkSession)
    profiles = stored(_profiles(docs, words), "profiles")
    rows = profiles.where("n is not null").select("key", "n", "class")
    seen = profiles.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).where("seen >= 4")
    most = seen.orderBy(F.desc("seen"), "token").limit(FREQUENT).toPandas().sort_values("token")
    repeats = profiles.agg(F.sum("seen"), F.sum("n")).first()
    partners = (repeats[0] or 0) / max(repeats[1] or 1, 1) + 0.05
    prefixes = Prefixes(most["token"].to_numpy(np.int64), most["seen"].to_numpy(np.int64), partners, percent)

    list_of = Window.partitionBy("token")
    postings = _postings(docs, prefixes, words).repartition("token").dropDuplicates(["token", "class"])
    postings = postings.withColumn("members", F.count(F.lit(1)).over(list_of)).where("members > 1")
    postings = postings.withColumn("head", F.min(F.when(F.col("level") == 1, F.struct("class", "n"))).over(list_of)).drop("members")
    postings = stored(postings, "postings")
    prefix = postings.groupBy("class").agg(F.max("asked").alias("asked"), F.collect_list(F.struct("token", "level")).alias("taken"))
    prefix = stored(prefix.select("class", "asked", "taken").mapInArrow(_prefix_bytes, "class bigint, asked int, taken binary"), "prefixes")
    firsts = rows.where("class is not null").groupBy("class").agg(F.min("key").alias("first"))
    classes = profiles.where("class is not null").select("class", "n", "bits").dropDuplicates(["class"])
    classes = stored(classes.join(prefix.select("class"), "class", "left_semi"), "classes")

    # a few lists of each class, the same ones for like classes, against the smallest class of the list
    order = F.xxhash64("token")
    plain = postings.where("level = 1").withColumn("order", order)
    few = plain.withColumn("_pick", F.row_number().over(Window.partitionBy("class").orderBy("order", "token"))).where(F.col("_pick") <= STARS)
    stars = few.where((F.col("head.class") < F.col("class")) & near_size("n", "head.n", percent)).select(F.col("head.class").alias("a"), F.col("class").alias("b"))
    stars = stored(_matched(possible(stars.distinct(), classes, percent), prefix), "stars")
    links = linked(stars, whole_sets(classes_of(stars), docs, firsts, words), percent)

    # lists that different components share
    lists = stored(meet.over_parts(parts(plain.select("token", "class", "order"), links), "token"), "lists")
    known = lists.groupBy("class").agg(F.slice(F.array_sort(F.collect_set("order")), 1, KNOWN).alias("known"))  # of one prefix
    payload = classes.join(known, "class").mapInArrow(_known_bytes, "class bigint, n bigint, bits binary, known binary")
    lists = lists.withColumnRenamed("token", "bucket")
    crowded = lists.where(F.col("size") >= meet.CROWD)
    if not crowded.isEmpty():  # groups of near copies: each member's nearest partner first
        near = stored(_matched(meet.pairs(crowded, payload, percent, nearest=True).select("a", "b").distinct(), prefix), "nearest")
        links = links.unionByName(linked(near, whole_sets(classes_of(near), docs, firsts, words), percent))
        lists = stored(meet.over_parts(parts(lists.drop("part", "size"), links), "bucket"), "lists")
    pairs = meet.pairs(lists, payload, percent, _unseen)
    pairs = stored(_matched(pairs.select("a", "b").distinct(), prefix), "candidates")
    links = links.unionByName(linked(pairs, whole_sets(classes_of(pairs), docs, firsts, words), percent))

    groups = stored(parts(firsts, links), "groups")
    smallest = groups.groupBy("part").agg(F.min("first").alias("component_id"))
    found = groups.join(smallest, "part").select("class", "part", "component_id")
    if count_links:
        found = found.join(degrees(groups.select("class", "part"), classes, docs, firsts, words, percent), "class", "left")
    return rows.join(found, "class", "left").withColumn("component_id", F.coalesce("component_id", "key"))


def _known_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``known`` as bytes of one width, the last value repeated."""
    for batch in batches:
        lists = batch.column(3).to_pylist()
        packed = [np.array(x + [x[-1]] * (KNOWN - len(x)), np.int64).tobytes() for x in lists]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(packed, pa.binary())], names=["class", "n", "bits", "known"])
