"""A reproducible shuffle into shards: a Feistel permutation over global row numbers.

Row numbers 0 to n-1 are written as (left, right) on a grid of a x b >= n cells with a and b
next to the root of n. Each round adds a keyed hash of one half to the other, modulo its side,
so the network permutes the grid; a row that lands on one of the fewer than a cells beyond n
walks on until it is back (cycle walking), which permutes 0 to n-1. The permuted number gives
shard and slot by division, so any row's place can be computed from its number and the seed,
and shard sizes differ by one row at most. Only column expressions are used.

Cases: rows are numbered by key, then crc32 and size of the text, so repeated keys and equal
rows keep places of their own; a null text counts as empty, a null key is numbered first; an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamra.llm.order import running, stored

ROUNDS = 6
WALKS = 64  # grids of n <= 4096 need fewer; beyond, a longer walk has odds below 2**-384 and raises


def _network(x: Column, a: int, b: int, seed: int) -> Column:
    halves = F.struct(F.call_function("div", x, F.lit(b)).alias("l"), (x % b).alias("r"))

    def turn(h: Column, i: Column) -> Column:
        left = F.pmod(h["l"] + F.pmod(F.xxhash64(h["r"], i, F.lit(seed)), F.lit(a)), F.lit(a))
        right = F.pmod(h["r"] + F.pmod(F.xxhash64(h["l"], i, F.lit(seed)), F.lit(b)), F.lit(b))
        return F.when(i % 2 == 0, F.struct(left.alias("l"), h["r"].alias("r"))).otherwise(
            F.struct(h["l"].alias("l"), right.alias("r")))

    rounds = F.array(*(F.lit(i) for i in range(ROUNDS)))
    return F.aggregate(rounds, halves, turn, lambda h: h["l"] * F.lit(b) + h["r"])


def permuted(df: DataFrame, number: str, n: int, seed: int, to: str = "permuted") -> DataFrame:
    """Add ``to``: the place of row ``number`` under the permutation of 0 to n-1 that ``seed`` keys."""
    a = isqrt(max(n, 1) - 1) + 1
    b = -(-max(n, 1) // a)
    df = df.withColumn("_once", _network(F.col(number).cast("long"), a, b, seed))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), F.col("_once"),
                       lambda y, _: F.when(y < n, y).otherwise(_network(y, a, b, seed)))
    df = df.withColumn(to, F.when(F.col("_once") < n, F.col("_once")).otherwise(walk)).drop("_once")
    unfinished = F.raise_error(F.lit("a cycle walk did not come back")).cast("long")
    return df.withColumn(to, F.when(F.col(to) < n, F.col(to)).otherwise(unfinished))


def shard(docs: DataFrame, shards: int, seed: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot): every row's shard and its gapless place there."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(key, (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    numbered = stored(running(narrow, [key, "text_crc32", "size"]), "numbered")
    places = permuted(numbered, "row_number", numbered.count(), seed)
    return places.select(key, "size", "text_crc32", (F.col("permuted") % shards).cast("int").alias("shard"),
                         F.call_function("div", F.col("permuted"), F.lit(shards)).alias("slot"))


def write_shards(docs: DataFrame, out: str, shards: int, seed: int = 1, key: str = "doc_id", text: str = "text") -> None:
    """Write whole rows as ``shard=k`` folders, in slot order inside each file; keys must be unique."""
    placed = docs.join(shard(docs, shards, seed, key, text).select(key, "shard", "slot"), key)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(out)
