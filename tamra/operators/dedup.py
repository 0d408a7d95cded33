"""Exact and near duplicates, clusters, deltas and benchmark overlap."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamra.functions.text import collapse, hash32, let, ngrams, words
from tamra.session import cut, scratch

HASH_PRIME = 4_294_967_311  # the first prime above 2 ** 32


def content_sha(text: Column) -> Column:
    return F.sha1(collapse(text))


def exact_dedup(df: DataFrame) -> DataFrame:
    """Keep the first document (smallest ``doc_id``) of each normalised text; add ``n_copies``.

    A null id comes last, rows of one id and text are told apart by their hash, null texts are one
    text. The winning row is an aggregate, combined before the shuffle: a text that fills a third
    of the corpus reaches its reducer as one row per task, and nothing is joined.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(*df.columns).alias("tie"))
    first = df.groupBy(content_sha(F.col("text")).alias("_sha")).agg(
        F.min_by(F.struct(*(F.col(c) for c in df.columns)), order).alias("_row"), F.count(F.lit(1)).alias("n_copies"))
    return first.select("_row.*", "n_copies")


def shingle_set(text: Column, n: int = 3) -> Column:
    """Distinct word ``n``-grams; the whole text for a shorter one."""
    def build(tokens: Column) -> Column:
        short = F.when(F.size(tokens) > 0, F.array(F.concat_ws(" ", tokens))).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.when(F.size(tokens) < n, short).otherwise(ngrams(tokens, n)))

    return let(words(text), build)


def affine(i: int) -> tuple[int, int]:
    """Coefficients of the ``i``-th hash function, by rule."""
    digest = hashlib.md5(f"minhash-{i}".encode()).hexdigest()
    return int(digest[:8], 16) % (2**31 - 1) + 1, int(digest[8:16], 16) % (2**31 - 1)


def minhash_bands(shingles: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, bucket``: one bucket key per band, from ``doc_id, h`` (32-bit shingle hashes)."""
    mins = []
    for i in range(bands * rows):
        a, b = affine(i)
        mins.append(F.min((F.col("h") * F.lit(a) + F.lit(b)) % F.lit(HASH_PRIME)).alias(f"m{i}"))
    signature = shingles.groupBy("doc_id").agg(*mins)
    keys = [
        F.concat_ws("-", F.lit(str(band)), *[F.col(f"m{band * rows + r}").cast("string") for r in range(rows)])
        for band in range(bands)
    ]
    return signature.select("doc_id", F.explode(F.array(*[F.md5(key) for key in keys])).alias("bucket"))


def bucket_components(members: DataFrame, verify: Callable[[DataFrame], DataFrame], accept: Column) -> DataFrame:
    """``doc_id, cluster_id``: components over all pairs of a bucket that ``accept`` holds for.

    First every member meets its bucket's smallest id, which joins a group of near copies,
    however large, in linear time. Then the pairs that still lie in different components meet:
    each bucket's largest component against the rest, so no component is paired with itself and
    no accepted pair is missed. ``members`` holds ``bucket, doc_id``; ``verify`` adds to
    ``leader, member`` the columns ``accept`` reads.
    """
    firsts = members.groupBy("bucket").agg(F.min("doc_id").alias("leader"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    rows = cut(members.join(firsts.select("bucket", "leader"), "bucket"))
    met = rows.filter("leader < doc_id").select("leader", F.col("doc_id").alias("member")).distinct()
    found = cut(verify(met).filter(accept).select("leader", "member"))

    parts = rows.select("bucket", "doc_id").join(components(found), "doc_id", "left").select(
        "bucket", "doc_id", F.coalesce("cluster_id", "doc_id").alias("part"))
    sizes = parts.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("_n"))
    split = sizes.groupBy("bucket").agg(F.max(F.struct("_n", "part")).alias("_top"), F.count(F.lit(1)).alias("_parts")).filter("_parts > 1")
    parts = cut(parts.join(split.select("bucket", F.col("_top.part").alias("top")), "bucket"))
    rest = parts.filter("part <> top").select("bucket", F.col("doc_id").alias("_a"), F.col("part").alias("_pa"))
    crossed = rest.join(parts, "bucket").filter((F.col("part") != F.col("_pa")) & ((F.col("part") == F.col("top")) | (F.col("_a") < F.col("doc_id"))))
    crossed = crossed.select(F.least("_a", "doc_id").alias("leader"), F.greatest("_a", "doc_id").alias("member")).distinct()
    return components(found.unionByName(verify(crossed).filter(accept).select("leader", "member")))


def _canonical(groups: DataFrame, clusters: DataFrame) -> DataFrame:
    """``leader, member``: every document (``doc_id``, in the group of ``head``) against the smallest id of its component."""
    placed = groups.join(clusters.select(F.col("doc_id").alias("head"), "cluster_id"), "head", "left")
    return placed.select(F.coalesce("cluster_id", "head").alias("leader"), F.col("doc_id").alias("member")).filter("leader < member")


def minhash_pairs(df: DataFrame, n: int = 3, bands: int = 16, rows: int = 4, threshold: float = 0.7) -> DataFrame:
    """Near duplicates ``leader, member, jaccard``: each document against the smallest id of its component.

    Components are those of all pairs that share a MinHash bucket and reach ``threshold``, each
    verified by its exact Jaccard index; equal sets are folded first. ``jaccard`` is that of the
    row's two documents, which may be lower if others connect them.
    """
    sets = df.select("doc_id", F.transform(shingle_set(F.col("text"), n), hash32).alias("hashes"))
    sets = cut(sets.select("doc_id", F.array_sort(F.array_distinct("hashes")).alias("hashes")).filter(F.size("hashes") > 0))
    keyed = sets.select("doc_id", F.sha1(F.array_join("hashes", ",")).alias("_same"))
    heads = keyed.groupBy("_same").agg(F.min("doc_id").alias("head"))
    groups = cut(keyed.join(heads, "_same").select("doc_id", "head"))
    distinct = sets.join(heads.select(F.col("head").alias("doc_id")), "doc_id", "left_semi")
    members = minhash_bands(distinct.select("doc_id", F.explode("hashes").alias("h")), bands, rows)

    def verify(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("doc_id").alias("leader"), F.col("hashes").alias("_a"))
        right = sets.select(F.col("doc_id").alias("member"), F.col("hashes").alias("_b"))
        both = pairs.join(left, "leader").join(right, "member")
        common = F.size(F.array_intersect("_a", "_b"))
        return both.select("leader", "member",
                           F.round(common / (F.size("_a") + F.size("_b") - common), 6).alias("jaccard"))

    return verify(_canonical(groups, bucket_components(members, verify, F.col("jaccard") >= threshold)))


def simhash(df: DataFrame) -> DataFrame:
    """``doc_id, hi, lo``: 64-bit SimHash of the words, as two 32-bit halves."""
    tokens = df.select("doc_id", F.explode_outer(words(F.col("text"))).alias("w")).filter("w IS NOT NULL")
    digest = F.md5("w")
    halves = tokens.select(
        "doc_id",
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint").alias("hi"),
        F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint").alias("lo"))
    votes = halves.groupBy("doc_id").agg(*[
        F.sum(F.shiftright(half, i).bitwiseAND(F.lit(1)) * 2 - 1).alias(f"{half}{i}")
        for half in ("hi", "lo") for i in range(32)])

    def pack(half: str) -> Column:
        bits = [F.when(F.col(f"{half}{i}") > 0, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i in range(32)]
        return reduce(lambda a, b: a + b, bits).alias(half)

    return votes.select("doc_id", pack("hi"), pack("lo"))


# 64 bits as six blocks of (half, first bit, width).
SIM_BLOCKS = (("hi", 0, 11), ("hi", 11, 11), ("hi", 22, 10), ("lo", 0, 11), ("lo", 11, 11), ("lo", 22, 10))


def simhash_pairs(df: DataFrame, most: int = 3) -> DataFrame:
    """Near duplicates ``leader, member, distance``: each document against the smallest id of its component.

    Components are those of all pairs at Hamming distance up to ``most`` (at most 3). Two values
    that differ in up to three bits agree in at least three of six blocks, so every choice of
    three blocks (20 keys of about 32 bits) is a bucket key. Equal values are folded first.
    ``distance`` is that of the row's two documents, which may be larger if others connect them.
    """
    if most > 3:
        raise ValueError("three of six blocks are sure to agree only up to distance 3")
    hashes = cut(simhash(df))
    heads = hashes.groupBy("hi", "lo").agg(F.min("doc_id").alias("head"))
    groups = hashes.join(heads, ["hi", "lo"]).select("doc_id", "head")
    blocks = [F.shiftright(half, start).bitwiseAND(F.lit((1 << width) - 1)).cast("string")
              for half, start, width in SIM_BLOCKS]
    keys = F.array(*[
        F.concat_ws("-", F.lit("".join(map(str, chosen))), *[blocks[i] for i in chosen])
        for chosen in combinations(range(len(SIM_BLOCKS)), 3)])
    members = heads.select(F.col("head").alias("doc_id"), F.explode(keys).alias("bucket"))

    def verify(pairs: DataFrame) -> DataFrame:
        left = hashes.select(F.col("doc_id").alias("leader"), F.col("hi").alias("_h1"), F.col("lo").alias("_l1"))
        right = hashes.select(F.col("doc_id").alias("member"), F.col("hi").alias("_h2"), F.col("lo").alias("_l2"))
        distance = (F.bit_count(F.col("_h1").bitwiseXOR(F.col("_h2")))
                    + F.bit_count(F.col("_l1").bitwiseXOR(F.col("_l2"))))
        return pairs.join(left, "leader").join(right, "member").select("leader", "member", distance.alias("distance"))

    return verify(_canonical(groups, bucket_components(members, verify, F.col("distance") <= most)))


def components(pairs: DataFrame) -> DataFrame:
    """``doc_id, cluster_id``: the smallest id reachable over ``leader, member`` pairs.

    Ids are ordered by their hash. Each round every id takes the least of its neighbours for its
    root and the pairs move on to the roots: pairs inside a root are gone and equal ones fold, so
    the rounds shrink, also on chains in the order of the ids. A hub's neighbours are combined
    before the shuffle. Rounds are stored as files: a checkpoint would keep the estimated size, which a join
    multiplies, so its digits doubled in every round and filled the driver.
    """
    spark = pairs.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = scratch(spark, "components")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def node(c: str) -> Column:
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))

    ends = stored(pairs.select(node("leader").alias("a"), node("member").alias("b")).distinct())
    labels = ends.select("a").unionByName(ends.select(F.col("b").alias("a"))).distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    links = ends.filter("a <> b")
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = stored(both.groupBy(F.col("a").alias("root")).agg(F.min("b").alias("_low")).select("root", F.least("root", "_low").alias("_to")))
        labels = stored(labels.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root")))
        for side in ("a", "b"):
            links = links.join(moved.select(F.col("root").alias(side), F.col("_to").alias(f"_{side}")), side)
        links = stored(links.filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
    smallest = labels.groupBy("root").agg(F.min("node.id").alias("cluster_id"))
    return stored(labels.join(smallest, "root").select(F.col("node.id").alias("doc_id"), "cluster_id"))


def dedup_clusters(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Add ``cluster_id`` and ``is_representative`` to every document; the smallest id represents a cluster."""
    clusters = components(pairs)
    return (
        docs.join(clusters, "doc_id", "left")
        .withColumn("cluster_id", F.coalesce("cluster_id", "doc_id"))
        .withColumn("is_representative", F.col("cluster_id") == F.col("doc_id"))
    )


def delta(new: DataFrame, old: DataFrame) -> DataFrame:
    """``doc_id, content_sha, change`` with change ``new``, ``changed`` or ``deleted``; unchanged rows are left out."""
    a = new.select("doc_id", content_sha(F.col("text")).alias("content_sha"))
    b = old.select("doc_id", content_sha(F.col("text")).alias("_old_sha"))
    change = (F.when(F.col("_old_sha").isNull(), "new").when(F.col("content_sha").isNull(), "deleted")
              .when(F.col("content_sha") != F.col("_old_sha"), "changed"))
    return (
        a.join(b, "doc_id", "full").withColumn("change", change).filter(F.col("change").isNotNull())
        .select("doc_id", F.coalesce("content_sha", "_old_sha").alias("content_sha"), "change")
    )


def gram_keys(df: DataFrame, key: str, n: int, text: str = "text") -> DataFrame:
    """``key, g, g2``: distinct word ``n``-grams as a 96-bit key."""
    grams = df.select(key, F.explode_outer(F.array_distinct(ngrams(words(F.col(text)), n))).alias("_g")).filter("_g IS NOT NULL")
    return grams.select(key, F.xxhash64("_g").alias("g"), F.hash("_g").alias("g2"))


def decontaminate(df: DataFrame, bench: DataFrame, n: int = 8, most: float = 0.0) -> DataFrame:
    """Add ``n_grams``, ``n_shared`` and ``contaminated``: overlap of each document with held-out items."""
    held_out = gram_keys(bench.withColumn("_one", F.lit(1)), "_one", n).select("g", "g2").distinct()
    shared = gram_keys(df, "doc_id", n).join(held_out, ["g", "g2"], "left_semi").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_shared"))
    total = F.size(F.array_distinct(ngrams(words(F.col("text")), n))).cast("bigint")
    return (
        df.withColumn("n_grams", total).join(shared, "doc_id", "left")
        .withColumn("n_shared", F.coalesce("n_shared", F.lit(0)))
        .withColumn("contaminated", (F.col("n_grams") > 0) & (F.col("n_shared") > F.col("n_grams") * most))
    )


def date_contamination(scores: DataFrame, bench: DataFrame, models: DataFrame) -> DataFrame:
    """Flag every score whose benchmark was released before the training cutoff of the model.

    ``scores`` holds ``bench_id, model_id``; only pairs that were scored are looked at.
    """
    return (
        scores.join(bench.select("bench_id", "released"), "bench_id")
        .join(models.select("model_id", "cutoff"), "model_id")
        .withColumn("contaminated", F.col("released") <= F.col("cutoff"))
    )
