"""Shingle sets of whole texts: names of sets, the sets of chosen classes, checks of pairs on them.

Equal sets share a class, a 64-bit name. Sets never travel with all rows: those a check needs
are made again from the texts of the classes' first documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamra.llm.order import stored
from tamra.llm.words import mix, shingles, slices, word_hashes

WANTED_BITS = 1 << 23  # of the bitmap of wanted ids
PARITY_WORDS = 32  # 64-bit words of a set's parity bitmap


def sets(batches: Iterator[pa.RecordBatch], words: int, text: int = 1) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """(batch, row, sorted shingle hashes) of every row."""
    for batch in batches:
        for first, raw, offsets in slices(batch.column(text)):
            hashes, before = word_hashes(raw, offsets)
            for i in range(len(offsets) - 1):
                yield batch, first + i, shingles(hashes[before[i]:before[i + 1]], words)


def class_of(s: np.ndarray) -> int:
    """A 64-bit name of a set."""
    total = mix(s).sum(keepdims=True) + mix(s ^ np.uint64(0x5555555555555555)).sum(keepdims=True) * np.uint64(3)
    return int(mix(total + np.uint64(len(s))).astype(np.int64)[0])


def parity(s: np.ndarray) -> np.ndarray:
    """A bitmap in which each element of the set turns one bit over.

    Bits in which two bitmaps differ bound the sets' difference from below, so their overlap from above.
    """
    bits = np.bincount((s % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def bitmaps(column: pa.Array) -> np.ndarray:
    """The bitmaps of an Arrow column of binary values, one row each."""
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(np.uint64).reshape(len(column), -1) if len(column) else np.zeros((0, PARITY_WORDS), np.uint64)


def near_size(a: str, b: str, percent: int) -> Column:
    return F.greatest(a, b) * percent <= F.least(a, b) * 100


def whole_sets(classes: DataFrame, docs: DataFrame, firsts: DataFrame, words: int) -> DataFrame:
    """(class, set) of the given classes, made from the text of each class's ``first`` document in (key, text)."""
    wanted = stored(classes.join(firsts, "class").select("class", F.col("first").alias("key")), "wanted")
    return stored(sets_of(wanted, docs, words).join(wanted, ["key", "class"], "left_semi").select("class", "set"), "sets")


def sets_of(wanted: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(key, class, set) of the rows of ``docs`` with a key of the stored ``wanted``, and of a few others.

    A bitmap of fixed size lets tasks pass over most other texts; a join with ``wanted`` makes it exact.
    """
    spark = docs.sparkSession
    kind = docs.schema["key"].dataType.simpleString()
    bit = F.pmod(F.xxhash64("key"), F.lit(WANTED_BITS))
    shifted = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int"))
    masks = (wanted.select(F.shiftright(bit, 5).alias("word"), shifted.alias("mask"))
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas())  # WANTED_BITS / 32 rows at most
    bitmap = np.zeros(WANTED_BITS // 32, np.int64)
    bitmap[masks["word"].to_numpy(np.int64)] = masks["mask"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast(bitmap)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def picked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.column(2).to_numpy()
                rows = np.flatnonzero((sent.value[at >> 5] >> (at & 31)) & 1)
                if len(rows):
                    yield batch.take(pa.array(rows))
        for batch, i, s in sets(picked(), words):
            if len(s):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([class_of(s)]), pa.array([s.tobytes()], pa.binary())],
                                                 names=["key", "class", "set"])

    return docs.withColumn("bit", bit).mapInArrow(made, f"key {kind}, class bigint, set binary")


def classes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()


def linked(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets reach the similarity."""
    both = (pairs.join(whole.select(F.col("class").alias("b"), F.col("set").alias("set_b")), "b")
            .join(whole.select(F.col("class").alias("a"), F.col("set").alias("set_a")), "a"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                joined = np.sort(np.concatenate([a, b]), kind="stable")
                shared = int((joined[1:] == joined[:-1]).sum())
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return stored(both.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a bigint, b bigint").distinct(), "links")


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow the similarity."""
    both = pairs
    for side in ("a", "b"):
        both = both.join(classes.select(F.col("class").alias(side), F.col("n").cast("long").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            apart = np.bitwise_count(bitmaps(batch.column(4)) ^ bitmaps(batch.column(5))).sum(1, dtype=np.int64)
            most = np.minimum((n + m - apart) // 2, np.minimum(n, m))
            at = pa.array(np.flatnonzero(most * (100 + percent) >= percent * (n + m)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(class, part): the smallest class that ``links`` (a, b) reach from each of their classes.

    Every round each class takes the smallest of its neighbours for its root, and the links move
    on to the roots: links inside a root are gone, equal ones fold, so the rounds shrink. Classes
    are hashes, so chains in their order are short; a star of any size around its smallest class
    takes one round.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = stored(both.groupBy(F.col("a").alias("class")).agg(F.least(F.col("class"), F.min("b")).alias("root")), "roots")
        if labels is None:
            labels = roots.select("class", F.col("root").alias("part"))
        else:
            moved = roots.select(F.col("class").alias("part"), "root")
            labels = labels.join(moved, "part", "left").select("class", F.coalesce("root", "part").alias("part"))
        labels = stored(labels, "labels")
        for side in ("a", "b"):
            links = links.join(roots.select(F.col("class").alias(side), F.col("root").alias(f"{side}_root")), side)
        links = links.where("a_root <> b_root").select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct()
        links = stored(links, "edges")
        if links.isEmpty():
            return labels


def parts(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with ``part``, the component of their class."""
    return rows.join(components(links), "class", "left").withColumn("part", F.coalesce("part", "class"))
