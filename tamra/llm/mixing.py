"""Mixing sources to target weights by a low-discrepancy schedule.

A slot is a place for one block of a source. Each source's words are cut into blocks of equal
size, ``block_words`` at most, and its target asks for so many of them, rounded: a source is off
its target by half a block of its own, however small it is. The sources' slots, laid end to end,
cut the first of 2 ** k points; slot t asks the van der Corput point of t (its k bits reversed)
for a source, so any run of slots follows the targets closely and every source gets exactly its
number of slots. The slots of a source are ranked; rank r takes the source's block ``r mod
blocks`` in its pass ``r div blocks``. Blocks cut the source's documents in a keyed hash order,
so a document may lie in several and one block may hold several.

Targets share ``share`` times all words by weight; none may pass ``cap`` times its source's
words, and what lies above is shared again by weight. Passes beyond ``cap`` stay empty, so no
document is taken more often. The same rows and seed give the same mix.

Cases: a null or empty text has no words and is taken 0 times; a null source is one source,
the last; repeated rows count each for itself; an empty table gives no rows; other columns
are left out. No source is held by one task: order, ranks and sums go by ranges of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamra.llm.order import running, stored

WORD = "[^\\x20\\x09-\\x0D]+"
CELL_POINTS = 64  # least points of a cell, in which points and sources meet by equality
MOST_CELLS = 65_536


@dataclass(frozen=True)
class Mix:
    rows: DataFrame  # _row, key, source, size, hash
    sources: DataFrame  # source, no, source_size, target, slots, base, blocks
    taken: DataFrame  # slot, no, rank, pass, block, _row, key, first_word, n_words


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(key: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key), F.crc32(F.coalesce(text, F.lit(""))))


def _named(source: str) -> list[Column]:
    """A null-safe sort and join form of a source."""
    return [F.col(source).isNull().alias("_none"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_name")]


def targets(sources: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """Add ``target`` to (source, no, source_size): weights repeat over the sources' numbers."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("no") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("_weight", weight)
    size, level, full = F.col("source_size"), 0.0, -1
    while True:
        stopped = (cap * size <= F.col("_weight") * level) if full >= 0 else F.lit(False)
        row = sources.agg(F.sum(size).alias("all"), F.sum(F.when(stopped, cap * size)).alias("stopped"),
                          F.sum(F.when(~stopped, F.col("_weight"))).alias("free"), F.count(F.when(stopped, 1)).alias("full")).first()
        if not row["free"] or row["full"] == full:
            break
        full = row["full"]
        level = (share * row["all"] - (row["stopped"] or 0.0)) / row["free"]
    return sources.withColumn("target", F.least(cap * size, F.col("_weight") * level)).drop("_weight")


def _slot(point: Column, bits: int) -> Column:
    """The slot whose point this is: its bits reversed."""
    return F.conv(F.reverse(F.lpad(F.bin(point), bits, "0")), 2, 10).cast("long")


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, cap: int = 2, block_words: int = 128, seed: int = 1,
        key: str = "doc_id", text: str = "text", source: str = "source") -> Mix:
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), *_named(source), F.col(source).alias("source"), word_count(text).alias("size"),
                       _hash(key, text, seed).alias("hash"))
    rows = stored(running(rows, ["_none", "_name", "hash", "key", "size"], "size").withColumnRenamed("row_number", "_row"), "mix-rows")
    found = rows.groupBy("_none", "_name").agg(F.sum("size").alias("source_size"), F.max("source").alias("source"))
    found = running(found, ["_none", "_name"], "source_size").withColumnRenamed("row_number", "no").withColumnRenamed("before", "base")
    sources = targets(stored(found, "mix-sources"), weights, share, cap)
    div = lambda a, b: F.call_function("div", a, b)
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block_words))
    wanted = F.coalesce(F.round(F.col("target") * F.col("blocks") / F.col("source_size")), F.lit(0)).cast("long")
    sources = sources.withColumn("slots", F.least(wanted, F.col("blocks") * cap))
    sources = running(sources, ["no"], "slots").drop("row_number").withColumnRenamed("before", "from")
    sources = stored(sources.withColumn("short", div(F.col("source_size"), F.col("blocks"))).withColumn("longer", F.col("source_size") % F.col("blocks")), "mix-targets")
    total = sources.agg(F.sum("slots")).first()[0] or 0

    # points, the source whose part of [0, total) holds each, and the slot that asks for it
    width = max(CELL_POINTS, -(-total // MOST_CELLS))
    points = spark.range(total).withColumnRenamed("id", "point").withColumn("cell", div(F.col("point"), F.lit(width)))
    cells = F.sequence(div(F.col("from"), F.lit(width)), div(F.col("from") + F.col("slots") - 1, F.lit(width)))
    held = sources.where("slots > 0").select("no", "blocks", F.col("from").alias("lo"), (F.col("from") + F.col("slots")).alias("hi"), F.explode(cells).alias("cell"))
    slots = points.join(held, "cell").where("point >= lo and point < hi").select(_slot(F.col("point"), max(1, (total - 1).bit_length())).alias("slot"), "no", "blocks", "lo")
    # slots are numbered source after source, so a source's first number is where its part begins
    slots = stored(running(slots, ["no", "slot"]).withColumn("rank", F.col("row_number") - F.col("lo")), "mix-slots")
    slots = slots.select("slot", "no", "rank", div(F.col("rank"), F.col("blocks")).alias("pass"), (F.col("rank") % F.col("blocks")).alias("block"))

    # documents as spans of their source's blocks; the first ``longer`` blocks hold a word more than the others
    at, short, longer = F.col("before") - F.col("base"), F.col("short"), F.col("longer")
    block_of = lambda x: F.when(x < longer * (short + 1), div(x, short + 1)).otherwise(longer + div(x - longer * (short + 1), short))
    start = lambda k: k * short + F.least(k, longer)
    spans = (rows.where("size > 0").join(sources.select("_none", "_name", "no", "base", "short", "longer"), ["_none", "_name"])
             .select("_row", "key", "no", "size", "short", "longer", at.alias("at")))
    spans = spans.withColumn("block", F.explode(F.sequence(block_of(F.col("at")), block_of(F.col("at") + F.col("size") - 1))))
    begin = F.greatest(F.col("at"), start(F.col("block")))
    end = F.least(F.col("at") + F.col("size"), start(F.col("block") + 1))
    spans = spans.select("_row", "key", "no", "block", (begin - F.col("at")).alias("first_word"), (end - begin).alias("n_words"))
    return Mix(rows, sources, slots.join(spans, ["no", "block"]))


def totals(mixed: Mix, key: str = "doc_id") -> DataFrame:
    """(key, size, source_size, target, taken, _row): what the mix takes of every document."""
    taken = mixed.taken.groupBy("_row").agg(F.sum("n_words").alias("taken"))
    rows = mixed.rows.join(mixed.sources.select("_none", "_name", "source_size", "target"), ["_none", "_name"])
    return rows.join(taken, "_row", "left").select(
        F.col("key").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "_row")


def repeated(docs: DataFrame, mixed: Mix, seed: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, each once for every pass that takes half of its words or more.

    ``seed`` is that of the mix. Equal rows are repeated alike, as often as the one taken most.
    """
    passes = mixed.taken.groupBy("_row", "pass").agg(F.sum("n_words").alias("n"))
    copies = mixed.rows.join(passes, "_row").where("2 * n >= size").groupBy("_row", "key", "hash").agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.groupBy(F.col("key").alias("_mix_key"), F.col("hash").alias("_mix_hash")).agg(F.max("copies").alias("_mix_copies"))
    taken = docs.withColumn("_mix_hash", _hash(key, text, seed))
    taken = taken.join(copies, (taken["_mix_hash"] == copies["_mix_hash"]) & taken[key].eqNullSafe(copies["_mix_key"]))
    taken = taken.withColumn("_mix_pass", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return taken.select(*(taken[c] for c in docs.columns))
