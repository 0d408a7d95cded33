"""Projection, union, limit, interleave, shuffle and split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamra.functions.text import non_blank as is_not_blank
from tamra.operators.ordering import rank_by_hash, rank_by_value

REPLAY_STEP = 10_000


def normalise(df: DataFrame, field: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Rename ``field`` to ``text`` and drop everything but it and ``keep``."""
    if field != "text" and field in df.columns:
        df = df.drop("text").withColumnRenamed(field, "text")
    if "text" not in df.columns:
        raise ValueError(f"expected a column {field!r} or 'text', found {df.columns}")
    return df.select("text", *[c for c in keep if c in df.columns])


def non_blank(df: DataFrame) -> DataFrame:
    return df.filter(is_not_blank(F.col("text")))


def tag(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


def concat(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bag union; ``source_ord`` keeps the order of the inputs."""
    return reduce(DataFrame.unionByName, [df.withColumn("source_ord", F.lit(i)) for i, df in enumerate(dfs)])


def cap(df: DataFrame, n: int | None, order: Sequence[str] = ("source_ord", "doc_id")) -> DataFrame:
    """The first ``n`` documents in corpus order (a top-k, no full sort); all for ``None``."""
    return df if n is None else df.orderBy(*order).limit(n)


def head_sample(df: DataFrame, n: int = 256, order: str = "block_id") -> DataFrame:
    """The first ``min(n, count)`` rows, for scoring."""
    return df.orderBy(order).limit(n)


def interleave(df: DataFrame, source_ord: str = "source_ord", order: str = "doc_id") -> DataFrame:
    """Alternate the sources, restarting short ones, until each was used in full.

    ``pos`` is the place in the result. With ``k`` sources of which the longest
    has ``M`` rows the result has ``k * M`` rows. A row's replays are made in two
    steps with a shuffle between, so a one-row source next to a long one does not
    produce all its copies in one task.
    """
    ranked = rank_by_value(df, order, by=[source_ord])
    sizes = df.groupBy(source_ord).agg(F.count(F.lit(1)).alias("_n"))
    whole = sizes.agg(F.max("_n").alias("_m"), F.count(F.lit(1)).alias("_k")).first()  # two numbers
    longest, k = whole["_m"] or 0, whole["_k"]
    ordinals = sizes.select(source_ord, "_n")
    placed = (
        ranked.join(ordinals, source_ord)
        .withColumn("_copies", F.floor((F.lit(longest) - F.col("rn")) / F.col("_n")) + 1)
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / REPLAY_STEP))))
        .repartition(source_ord, "rn", "_step")
    )
    first = F.col("_step") * REPLAY_STEP
    last = F.least(first + REPLAY_STEP, F.col("_copies")) - 1
    return (
        placed.withColumn("_copy", F.explode(F.sequence(first, last)))
        .withColumn("pos", ((F.col("rn") - 1 + F.col("_copy") * F.col("_n")) * F.lit(k) + F.col(source_ord)).cast("bigint"))
        .drop("rn", "_n", "_copies", "_step", "_copy")
    )


def shuffle(df: DataFrame, seed: int, key: str = "doc_id") -> DataFrame:
    """A full, repeatable shuffle: ``shuffle_pos`` is the place by the hash of seed and id."""
    return rank_by_hash(df, F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")), key, out="shuffle_pos")


def take_skip(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` rows are ``eval``, the rest ``train``."""
    ranked = rank_by_value(df, order, out="_place")
    return ranked.withColumn("split", F.when(F.col("_place") <= n, "eval").otherwise("train")).drop("_place")


def split(df: DataFrame, fraction: float, seed: int, key: str = "doc_id") -> DataFrame:
    """Exact seeded split: ``ceil(fraction * rows)`` rows go to ``validation``.

    Unsplit (no ``split`` column) for a fraction of 0 or at most one row.
    """
    total = df.count()
    if fraction <= 0 or total <= 1:
        return df
    ranked = shuffle(df, seed, key)
    wanted = F.ceil(F.lit(fraction) * F.lit(total))
    return ranked.withColumn(
        "split", F.when(F.col("shuffle_pos") <= wanted, "validation").otherwise("train")).drop("shuffle_pos")


def split_by_hash(df: DataFrame, fraction: float, seed: int, key: str = "doc_id") -> DataFrame:
    """Split of expected size, row by row: fit for a stream, no shuffle, no count."""
    value = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10)
    draw = value.cast("bigint") / F.lit(float(2**32))
    return df.withColumn("split", F.when(draw < fraction, "validation").otherwise("train"))
