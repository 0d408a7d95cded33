"""MinHash near-dedup with tensored banding.

A document's set holds the distinct hashes of its word shingles. Two small collections of hashes,
``halves`` each and each of ``rows`` minimum hashes, give the keys of ``halves ** 2`` tables: table
(i, j) is keyed by the i-th of the first and the j-th of the second collection, so the number of
minimum hashes grows with the square root of the tables. A pair of Jaccard t shares a table
unless it misses a whole collection: at most 2 (1 - t ** rows) ** halves, 5.4e-6 at 0.85 as set here
(``missed``). Candidates are verified on whole sets.

Equal sets are one class from the start. Hashes nobody shares make no keys, so a document without
likeness costs its 2 * halves hashes only, not a row a table. Classes are first checked against
the smallest class of each shared hash, which joins most of a group in linear work; tables are then
keyed for hashes shared across components alone, and their entries meet in blocks (``meet``), each
pair leaving the first table that it shares. Every candidate pair of different components is checked.

Cases: a null text, or one without words, has an empty set and is linked with nothing (its
component is its own id); fewer words than a shingle make one shingle; rows that share an id are
judged by text and share their component's smallest id; a null id is left out; other columns are
left out; an empty table gives no rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamra.llm import meet
from tamra.llm.order import bounded, stored
from tamra.llm.sets import class_of, classes_of, linked, near_size, parity, parts, possible, sets, whole_sets
from tamra.llm.words import mix

HALVES = 10  # hashes of a collection; their square is the number of tables
ROWS = 2  # minimum hashes in each
AT_ONCE = 4_096  # shingles hashed at once


def missed(similarity: float, halves: int = HALVES, rows: int = ROWS) -> float:
    """Bound on the chance that a pair of this similarity shares no table."""
    return 2 * (1 - similarity ** rows) ** halves


class Signer:
    """The two collections of hashes of a set."""

    def __init__(self, halves: int, rows: int, seed: int) -> None:
        count = 2 * halves * rows
        drawn = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) + mix(np.array([seed], np.uint64)))
        self.flip, self.by = drawn[:count], drawn[count:] | np.uint64(1)
        self.halves, self.rows = halves, rows
        self.place = mix(np.arange(1, 2 * halves + 1, dtype=np.uint64))

    def of(self, s: np.ndarray) -> np.ndarray:
        low = np.full(len(self.flip), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(s), AT_ONCE):
            low = np.minimum(low, ((s[at:at + AT_ONCE, None] ^ self.flip) * self.by).min(0))
        key = self.place
        for column in low.reshape(2 * self.halves, self.rows).T:
            key = mix(key + column)
        return key.astype(np.int64)


def _profiles(docs: DataFrame, words: int, signer: Signer) -> DataFrame:
    """(key, n, class, halves, bits) of every document; nulls but for n where the set is empty."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []

        def flush() -> pa.RecordBatch:
            at, n, name, halves, bits = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [last.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int32()), pa.array(name, pa.int64()),
                 pa.array(halves, pa.list_(pa.int64())), pa.array(bits, pa.binary())], names=["key", "n", "class", "halves", "bits"])

        for batch, i, s in sets(batches, words):
            if rows and (last is not batch or len(rows) >= 5_000):
                yield flush()
                rows = []
            last = batch
            rows.append((i, len(s), class_of(s), signer.of(s), parity(s).tobytes()) if len(s) else (i, 0, None, None, None))
        if rows:
            yield flush()

    return docs.mapInArrow(run, f"key {kind}, n int, class bigint, halves array<bigint>, bits binary")


def near_copies(docs: DataFrame, words: int = 5, percent: int = 85, halves: int = HALVES, rows: int = ROWS, seed: int = 1,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept): components of the verified links; one document of each is kept."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col(key).isNotNull())
    bounded(docs.sparkSession)
    profiles = stored(_profiles(docs, words, Signer(halves, rows, seed)), "profiles")
    classes = stored(profiles.where("class is not null").groupBy("class").agg(
        F.min("key").alias("first"), *(F.first(c).alias(c) for c in ("n", "halves", "bits"))), "classes")
    firsts = classes.select("class", "first")

    # hashes that several classes share, with the smallest of those
    keys = classes.select("class", "n", F.posexplode("halves").alias("place", "half"))
    heads = keys.groupBy("half").agg(F.min(F.struct("class", "n")).alias("head"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = stored(keys.join(heads.select("half", F.col("head.class").alias("head"), F.col("head.n").alias("head_n")), "half"), "shared")
    stars = shared.where((F.col("head") < F.col("class")) & near_size("n", "head_n", percent)).select(F.col("head").alias("a"), F.col("class").alias("b"))
    stars = stored(possible(stars.distinct(), classes, percent), "stars")
    links = linked(stars, whole_sets(classes_of(stars), docs, firsts, words), percent)

    # tables of hashes that different components share
    split = stored(meet.over_parts(parts(shared.select("half", "place", "class"), links), "half").drop("size"), "split")
    mine = split.groupBy("class", "part").agg(F.collect_list(F.struct("place", "half")).alias("h"))  # 2 * halves at most
    of = lambda side: F.filter("h", lambda x: (x.place < halves) == F.lit(side))
    mine = mine.select("class", "part", F.explode(of(True)).alias("one"), of(False).alias("others"))
    mine = mine.select("class", "part", "one", F.explode("others").alias("other"))
    tables = mine.select("class", "part", F.xxhash64("one.half", "other.half").alias("bucket"),
                         (F.col("one.place") * halves + F.col("other.place") - halves).alias("table"))
    tables = stored(meet.over_parts(stored(tables, "tables"), "bucket"), "table-entries")

    def first_shared(x: dict[str, np.ndarray], a: int, at: np.ndarray) -> np.ndarray:
        same = x["halves"][at] == x["halves"][a]
        one, other = same[:, :halves], same[:, halves:]
        table = x["table"][0]
        return (one.argmax(1) == table // halves) & (other.argmax(1) == table % halves) & one.any(1) & other.any(1)

    as_bytes = classes.select("class", "n", "bits", "halves").mapInArrow(_flat, "class bigint, n int, bits binary, halves binary")
    crowded = tables.where(F.col("size") >= meet.CROWD)
    if not crowded.isEmpty():  # groups of near copies: each member's nearest partner first
        near = stored(meet.pairs(crowded, as_bytes, percent, nearest=True).select("a", "b").distinct(), "nearest")
        links = links.unionByName(linked(near, whole_sets(classes_of(near), docs, firsts, words), percent))
        tables = stored(meet.over_parts(parts(tables.drop("part", "size"), links), "bucket"), "table-entries")
    pairs = stored(meet.pairs(tables, as_bytes, percent, first_shared).select("a", "b").distinct(), "candidates")
    links = links.unionByName(linked(pairs, whole_sets(classes_of(pairs), docs, firsts, words), percent))

    groups = stored(parts(firsts, links), "groups")
    smallest = groups.groupBy("part").agg(F.min("first").alias("component_id"))
    known = groups.join(smallest, "part").select("class", "component_id")
    found = profiles.select("key", "n", "class").join(known, "class", "left").withColumn("component_id", F.coalesce("component_id", "key"))
    return found.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id",
                        (F.col("key") == F.col("component_id")).alias("kept"))


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of hashes as bytes."""
    for batch in batches:
        flat = batch.column(3).flatten().to_numpy().astype(np.int64)
        width = len(flat) // max(batch.num_rows, 1)
        packed = [row.tobytes() for row in flat.reshape(batch.num_rows, width)] if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(packed, pa.binary())], names=["class", "n", "bits", "halves"])
