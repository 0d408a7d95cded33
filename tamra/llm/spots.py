"""Document fingerprints by SpotSigs: chains of content words that follow common words.

A text is cut at its anchors (common words of four languages, lower case, between marks that
are no letters or digits). Every anchor gives one signature: the anchor and the next ``CHAIN``
content words, going on past at most ``SKIPPED`` further anchors. The fingerprint is the set of
the signatures' 32-bit hashes, written in ascending order as eight hex digits each, so that
likeness (Jaccard) can be computed from fingerprints alone. A text whose anchors give no
signature takes every word as an anchor, so texts in other scripts have fingerprints too.

Sets are partitioned by length: two sets of Jaccard >= t lie in the same or neighbouring
classes of ``length_class(n, t)``, and ``likeness`` compares only sets whose sizes allow the
asked Jaccard (``at_least``; at 0 every pair with two signatures or more is compared).
Column expressions only.

Cases: a null text counts as empty; an empty text, or one without words, has the empty
fingerprint, of likeness 1 to another empty one and 0 to all others; equal texts have equal
fingerprints; repeated keys are neighbours in the order of their texts' crc32; a null key comes
first; in a table of one row the next document is the row itself; other columns are left out.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamra.functions.text import let

# Common words used as anchors (English, German, French, Spanish).
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was were which with "
    "auf das dem den der des die ein eine für ist im mit nicht sich und von zu "
    "au aux ce dans de du elle en est et il la le les ne par pas pour que qui sur un une "
    "al como con del el es las lo los más no para por se su una y"
).split()
CHAIN = 3
SKIPPED = 2
SAMPLED = 40  # keys looked at for each range border


def _segments(text: Column) -> Column:
    """Words in lower case between single blanks, cut before each anchor."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    names = "|".join(dict.fromkeys(ANCHORS))
    return F.split(F.regexp_replace(F.concat(F.lit(" "), words), f" (?=(?:{names})(?: |$))", "\u0001"), "\u0001")


def _chains(segments: Column) -> Column:
    """``segments[0]`` precedes the first anchor; every later one begins with its anchor."""
    def content(s: Column) -> Column:
        return F.when(F.instr(s, " ") > 0, F.concat(F.substr(s, F.instr(s, " ")), F.lit(""))).otherwise(F.lit(""))

    def all_chains(after: Column) -> Column:
        def chain(k: Column) -> Column:
            more = [F.coalesce(F.get(after, k + j), F.lit("")) for j in range(1, SKIPPED + 1)]
            return F.substring_index(F.concat(F.get(segments, k), *more), " ", CHAIN + 1)
        return F.transform(F.sequence(F.lit(1), F.size(segments) - 1), chain)

    none = F.array().cast("array<string>")
    return F.when(F.size(segments) < 2, none).otherwise(let(F.transform(segments, content), all_chains))


def _shingles(segments: Column) -> Column:
    """A chain from every word, for a text without signatures."""
    def all_chains(words: Column) -> Column:
        return F.when(F.size(words) < 1, F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, k, CHAIN + 1), " ")))
    return let(F.filter(F.split(F.array_join(segments, " "), " "), lambda w: w != ""), all_chains)


def signatures(text: Column) -> Column:
    """The sorted distinct signature hashes of a text, as unsigned 32-bit numbers."""
    def hashed(chains: Column) -> Column:
        return F.array_sort(F.array_distinct(F.transform(chains, lambda c: F.hash(c).cast("long").bitwiseAND(0xFFFFFFFF))))

    def of(segments: Column) -> Column:
        spotted = F.filter(_chains(segments), lambda c: F.instr(c, " ") > 0)
        return let(spotted, lambda c: hashed(F.when(F.size(c) > 0, c).otherwise(_shingles(segments))))

    return let(_segments(F.coalesce(text, F.lit(""))), of)


def fingerprint(signatures: Column) -> Column:
    return F.lower(F.array_join(F.transform(signatures, lambda s: F.lpad(F.hex(s), 8, "0")), ""))


def length_class(n: Column, t: float) -> Column:
    """Classes whose borders grow by 1/t, so that Jaccard >= t spans at most two neighbours."""
    return F.when(n < 1, -1).otherwise(F.floor(F.log(F.greatest(n, F.lit(1))) / -log(t))).cast("int")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard of two signature sets; 0, uncompared, if their sizes rule ``at_least`` out."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return (F.when(large == 0, 1.0).when((small == 0) | (small < large * at_least), 0.0)
            .otherwise(let(shared, lambda s: s / (small + large - s))))


def _range(key: Column, borders: list) -> Column:
    """Number of borders at or below the key, by a balanced tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(borders[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return F.coalesce(F.when(key.isNotNull(), tree(0, len(borders))), F.lit(0))


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, tie, part, next_text): each row with its successor's text, the last with the first's.

    Texts are shuffled once, by ranges of the key; the first text of each range, one row a
    range, is looked up by its key and joined to the range before.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sample = docs.where(F.col(key).isNotNull()).select(key).orderBy(F.xxhash64(key)).limit(SAMPLED * parts)
    borders = sorted({row[0] for row in sample.collect()})[SAMPLED::SAMPLED]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.crc32("text")).withColumn("part", _range(F.col("key"), borders))
    order = ["key", "tie", "text"]
    window = Window.partitionBy("part").orderBy(*order)

    firsts = rows.groupBy("part").agg(F.min(F.struct("key", "tie")).alias("first"))
    same = F.col("r.key").eqNullSafe(F.col("f.first.key")) & (F.col("r.tie") == F.col("f.first.tie")) & (F.col("r.part") == F.col("f.part"))
    heads = rows.alias("r").join(firsts.alias("f"), same).groupBy("r.part").agg(F.min("r.text").alias("text"))
    around = Window.orderBy("part")  # one row a range
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("text").over(around), F.first("text").over(whole)).alias("_head"))
    return (rows.withColumn("_next", F.lead("text").over(window)).join(heads, "part", "left")
            .select("key", "text", "tie", "part", F.coalesce("_next", "_head").alias("next_text"),
                    F.col("_next").isNull().alias("_last")))


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", t: float = 0.8) -> DataFrame:
    """Fingerprints of every text and of the text with its second half taken from the next document.

    (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_signatures, length_class)
    """
    rows = with_next(docs, key, text).withColumn("sig", signatures(F.col("text")))
    window = Window.partitionBy("part").orderBy("key", "tie", "text")
    rows = rows.withColumn("next_sig", F.lead("sig").over(window))
    rows = rows.withColumn("next_sig", F.when(F.col("_last"), signatures(F.col("next_text"))).otherwise(F.col("next_sig")))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)))
    rows = rows.withColumn("edited_sig", signatures(F.col("edited")))
    size = F.size("sig")
    return rows.select(
        F.col("key").alias(key), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sig")).alias("fingerprint"), fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
        size.alias("n_signatures"), length_class(size, t).alias("length_class"))
