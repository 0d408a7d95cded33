"""Personal data: detection, offsets, redaction, reports and scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamra.functions.personal import KINDS, RULES, SPARK_PATTERNS, Redaction, holds_word, plain_digits, valid
from tamra.functions.text import let, ngrams, surface_tokens
from tamra.operators.dedup import gram_keys
from tamra.session import cut

# Words that lead a person's name.
HONORIFIC = r"(?:(?<![A-Za-z0-9_])(?:Mr|Mrs|Ms|Dr|Prof)\. ?|(?:นางสาว|นาย|นาง|คุณ) ?)(\p{L}[\p{L}\p{M}]+(?: (?:\p{Lu}|[ก-๏])[\p{L}\p{M}]+)?)"


def detect(df: DataFrame, kind: str) -> DataFrame:
    """``doc_id, pii_type, value``: every valid value of one kind, in the order found."""
    found = F.filter(F.regexp_extract_all("text", F.lit(SPARK_PATTERNS[kind]), F.lit(0)), lambda v: valid(kind, v))
    return df.select("doc_id", F.lit(kind).alias("pii_type"), F.explode_outer(found).alias("value")).filter("value IS NOT NULL").withColumn(
        "value", plain_digits(F.col("value")))


def found_values(kind: str, text: Column) -> Column:
    """All matches of a kind in order, by one pass over the text; empty without a pass where a needed word is missing."""
    return F.when(holds_word(kind, text), F.regexp_extract_all(text, F.lit(SPARK_PATTERNS[kind]), F.lit(0))).when(
        text.isNotNull(), F.array().cast("array<string>"))


def _with_gaps(kind: str) -> Callable[[Column], Column]:
    """Kind, matches and lengths of the pieces between them; null without a match, so that only texts with one are cut."""
    def build(found: Column) -> Column:
        gaps = F.transform(F.split("text", SPARK_PATTERNS[kind], -1), F.length)
        return F.when(F.size(found) > 0, F.struct(F.lit(kind).alias("pii_type"), found.alias("m"), gaps.alias("g")))

    return build


def raw_spans(df: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """``doc_id, pii_type, start, end, value`` of valid matches; 0-based, end exclusive.

    Offsets are the lengths of the pieces before a match. One pass over the text for all kinds;
    only the matches and the lengths of the pieces are shuffled.
    """
    per_kind = [let(found_values(kind, F.col("text")), _with_gaps(kind)) for kind in kinds]
    kept = df.select("doc_id", F.inline(F.array_compact(F.array(*per_kind))))
    rows = kept.select("doc_id", "pii_type", F.posexplode(F.arrays_zip("m", F.slice("g", F.lit(1), F.size("m")).alias("g"))))
    order = W.partitionBy("doc_id", "pii_type").orderBy("pos")
    value = F.col("col.m")
    gap_sum = F.sum(F.col("col.g")).over(order.rowsBetween(W.unboundedPreceding, 0))
    taken = F.coalesce(F.sum(F.length(value)).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = rows.select("doc_id", "pii_type", (gap_sum + taken).cast("int").alias("start"), value.alias("value"))
    check = F.lit(False)
    for kind in kinds:
        check = check | ((F.col("pii_type") == kind) & valid(kind, F.col("value")))
    return placed.filter(check).withColumn("end", F.col("start") + F.length("value")).withColumn("value", plain_digits(F.col("value")))


def pii_hits(df: DataFrame, kinds: Sequence[str] = KINDS, salt: str = "") -> DataFrame:
    """``doc_id, pii_type, start, end, value_hash``: overlapping matches merged into one hit.

    The hit spans all of them, so nothing that any detector found is left open; its kind is that
    of the longest match, the earlier one of two that tie.
    """
    spans = raw_spans(df, kinds)
    order = W.partitionBy("doc_id").orderBy("start", F.desc("end"), "pii_type")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opened = spans.withColumn("_new", F.when(reach.isNull() | (F.col("start") >= reach), 1).otherwise(0))
    island = opened.withColumn("_island", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    longest = F.struct(F.length("value"), -F.col("start"), F.col("pii_type"))
    return island.groupBy("doc_id", "_island").agg(
        F.max_by("pii_type", longest).alias("pii_type"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.sha2(F.concat(F.lit(salt), F.max_by("value", longest)), 256).alias("value_hash")).drop("_island")


def redact_column(text: Column, kinds: Sequence[str] = KINDS, how: Redaction = Redaction()) -> Column:
    """Replace every valid value, kind after kind. Row by row and linear, so it also runs on a stream."""
    for kind in kinds:
        text = let(text, _replace(kind, how))
    return text


def _replace(kind: str, how: Redaction) -> Callable[[Column], Column]:
    pattern = SPARK_PATTERNS[kind]

    def build(text: Column) -> Column:
        if kind not in RULES and how.mode == "redact":  # every match is valid and becomes the same mark
            return F.when(holds_word(kind, text), F.regexp_replace(text, pattern, f"<{kind}>")).otherwise(text)

        def put_back(found: Column) -> Column:
            marked = F.transform(found, lambda v: F.when(valid(kind, v), how.mark(kind, v)).otherwise(v))
            joined = F.zip_with(F.split(text, pattern, -1), marked, lambda gap, mark: F.concat(gap, F.coalesce(mark, F.lit(""))))
            return F.when(F.size(found) > 0, F.array_join(joined, "")).otherwise(text)

        return let(found_values(kind, text), put_back)

    return build


def redact(df: DataFrame, mode: str = "redact", salt: str = "", kinds: Sequence[str] = KINDS,
           columns: Sequence[str] = ("text",)) -> DataFrame:
    """Redact the given text columns; the same function serves corpora and query tables."""
    how = Redaction(mode, salt)
    for column in columns:
        df = df.withColumn(column, redact_column(F.col(column), kinds, how))
    return df


def redaction_report(hits: DataFrame) -> DataFrame:
    """Counts per type and source with all totals (null marks a total)."""
    return hits.cube("pii_type", "source").agg(F.count(F.lit(1)).alias("n_hits"), F.count_distinct("doc_id").alias("n_docs"))


def redaction_pivot(hits: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """One row per source, one column per type."""
    return hits.groupBy("source").agg(*[F.count_if(F.col("pii_type") == kind).alias(kind.lower()) for kind in kinds])


def detect_names(df: DataFrame, gazetteer: DataFrame, longest: int | None = None) -> DataFrame:
    """``doc_id, name, how``: names led by an honorific, and names of the ``gazetteer`` (column ``name``).

    Phrases of up to ``longest`` tokens are looked up; by default as many as the longest name has.
    """
    if longest is None:
        longest = gazetteer.agg(F.max(F.size(surface_tokens(F.col("name"))))).first()[0] or 1
    led = df.select("doc_id", F.explode_outer(F.regexp_extract_all("text", F.lit(HONORIFIC), F.lit(1))).alias("name")).filter(
        "name IS NOT NULL").withColumn("how", F.lit("honorific"))
    phrases = let(surface_tokens(F.col("text")), lambda t: F.flatten(F.array(*[ngrams(t, n) for n in range(1, longest + 1)])))
    listed = (
        df.select("doc_id", F.explode_outer(phrases).alias("_phrase")).filter("_phrase IS NOT NULL").withColumn("_key", F.lower("_phrase"))
        .join(gazetteer.select(F.lower("name").alias("_key")).distinct(), "_key")
        .select("doc_id", F.col("_phrase").alias("name"), F.lit("gazetteer").alias("how"))
    )
    return led.unionByName(listed)


def pii_score(hits: DataFrame, truth: DataFrame, min_recall: float) -> DataFrame:
    """Recall, precision and a ship flag per type; a hit counts if it overlaps a true span of its type.

    Spans meet only inside their document, so the join key is the document and the type. The hits are
    stored without their values, since each figure reads them again.
    """
    h = cut(hits.select(F.col("doc_id").alias("_doc"), F.col("pii_type").alias("_type"), F.col("start").alias("_hs"), F.col("end").alias("_he")))
    t = truth.select("doc_id", "pii_type", F.col("start").alias("_ts"), F.col("end").alias("_te"))
    overlap = (F.col("_hs") < F.col("_te")) & (F.col("_ts") < F.col("_he"))
    same = (F.col("_doc") == F.col("doc_id")) & (F.col("_type") == F.col("pii_type")) & overlap
    found = t.join(h, same, "left_semi").groupBy("pii_type").agg(F.count(F.lit(1)).alias("n_found"))
    right = h.join(t, same, "left_semi").groupBy(F.col("_type").alias("pii_type")).agg(F.count(F.lit(1)).alias("n_right"))
    n_true = t.groupBy("pii_type").agg(F.count(F.lit(1)).alias("n_true"))
    n_hits = h.groupBy(F.col("_type").alias("pii_type")).agg(F.count(F.lit(1)).alias("n_hits"))
    table = n_true.join(n_hits, "pii_type", "full").join(found, "pii_type", "left").join(right, "pii_type", "left").na.fill(0)
    return (
        table.withColumn("recall", F.when(F.col("n_true") > 0, F.col("n_found") / F.col("n_true")))
        .withColumn("precision", F.when(F.col("n_hits") > 0, F.col("n_right") / F.col("n_hits")))
        .withColumn("ship", F.coalesce(F.col("recall") >= min_recall, F.lit(False)))
        .select("pii_type", "n_true", "n_hits", "recall", "precision", "ship")
    )


def leak_check(df: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """``pii_type, n_leaks`` for every type: all zero on a redacted table."""
    counts = F.array(*[
        F.struct(F.lit(kind).alias("pii_type"), F.size(F.filter(found_values(kind, F.col("text")), _is_valid(kind))).alias("n"))
        for kind in kinds])
    return df.select(F.inline(counts)).groupBy("pii_type").agg(F.sum("n").alias("n_leaks"))


def _is_valid(kind: str) -> Callable[[Column], Column]:
    return lambda value: valid(kind, value)


def memorised(outputs: DataFrame, corpus: DataFrame, n: int = 8, key: str = "out_id") -> DataFrame:
    """``n_grams, n_repeated`` per output: word ``n``-grams that also stand in the corpus.

    The corpus is filtered by the outputs' n-grams before anything of it is shuffled.
    """
    grams = gram_keys(outputs, key, n)
    wanted = grams.select("g", "g2").distinct()
    seen = gram_keys(corpus, "doc_id", n).select("g", "g2").join(wanted, ["g", "g2"], "left_semi").distinct()
    return (
        grams.join(seen.withColumn("_hit", F.lit(1)), ["g", "g2"], "left")
        .groupBy(key).agg(F.count(F.lit(1)).alias("n_grams"), F.count("_hit").alias("n_repeated"))
    )
