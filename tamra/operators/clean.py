"""Cleaning: markup, boilerplate, encoding, language, length, symbols, repetition, blocklist."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamra.functions.text import let, ngrams, ratio, words
from tamra.session import cut

# Markup rules, applied in this order.
MARKUP_RULES = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script>", ""),
    (r"(?is)<style\b.*?</style>", ""),
    (r"(?is)<nav\b.*?</nav>", ""),
    (r"(?is)<head\b.*?</head>", ""),
    (r"(?i)<br[^>]*>|</(?:p|div|li|tr|h[1-6]|article|section)>", "\n"),
    (r"<[^>]*>", ""),
)
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
SPACE_RULES = ((r"[ \t]+", " "), (r" ?\n[ \n]*", "\n"))
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
BROKEN = r"[\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F\x7F]|Ã[\x{80}-\x{BF}]|â€"
SYMBOL = r"[^\p{L}\p{M}\p{N}\s]"
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "with", "was"),
    "fr": ("le", "la", "les", "de", "des", "et", "un", "une", "que", "pour"),
    "de": ("der", "die", "das", "und", "ist", "von", "zu", "mit", "nicht", "ein"),
    "es": ("el", "los", "las", "de", "y", "que", "en", "un", "una", "para"),
}


def min_length(df: DataFrame, n: int) -> DataFrame:
    """Drop empty and near-empty documents."""
    return df.filter(F.length("text") >= n)


def length_bounds(df: DataFrame, lo: int, hi: int) -> DataFrame:
    return df.filter(F.length("text").between(lo, hi))


def _named() -> Column:
    """The named entities of HTML 4 (standard library table), a hard blank as a plain one."""
    pairs = sorted({**name2codepoint, "apos": 39}.items())
    return F.create_map(*[F.lit(x) for name, code in pairs for x in (name, " " if name == "nbsp" else chr(code))])


def _decode(text: Column) -> Column:
    """Named, decimal and hexadecimal entities as their characters, in one pass; unknown ones stay."""
    names = _named()

    def char(entity: Column) -> Column:
        body = F.substring(entity, 2, 9)
        number = F.when(F.lower(F.substring(body, 2, 1)) == "x", F.conv(F.regexp_replace(body, "^#[xX]|;$", ""), 16, 10)).otherwise(
            F.regexp_replace(body, "[#;]", "")).try_cast("int")
        sound = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
        written = F.decode(F.unhex(F.lpad(F.hex(F.when(sound, number).otherwise(F.lit(0x20))), 8, "0")), "UTF-32")
        numeric = F.when(number == 160, " ").when(sound, written)
        return F.coalesce(F.when(F.substring(body, 1, 1) == "#", numeric).otherwise(F.try_element_at(names, F.replace(body, F.lit(";"), F.lit("")))), entity)

    found = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), char)
    joined = F.array_join(F.zip_with(F.split(text, ENTITY, -1), found, lambda gap, c: F.concat(gap, F.coalesce(c, F.lit("")))), "")
    return F.when(F.regexp_like(text, F.lit(ENTITY)), joined).otherwise(text)


def html_to_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``title`` and ``text``: no script, style, navigation, comments or tags; entities decoded."""
    body = F.col(html)
    for pattern, replacement in MARKUP_RULES:
        body = F.regexp_replace(body, pattern, replacement)
    body = let(body, _decode)
    for pattern, replacement in SPACE_RULES:
        body = F.regexp_replace(body, pattern, replacement)
    title = F.trim(let(F.regexp_extract(F.col(html), TITLE, 1), _decode))
    return pages.withColumn("title", title).withColumn("text", F.trim(body))


def line_frequencies(df: DataFrame) -> DataFrame:
    """``line_key, n_docs``: in how many documents a non-blank line occurs."""
    lines = df.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    keyed = lines.select("doc_id", F.trim("line").alias("line")).filter("line <> ''")
    # one distinct aggregate: combined per (line, document) first, so a line found everywhere stays spread
    return keyed.groupBy(F.md5("line").alias("line_key")).agg(F.count_distinct("doc_id").alias("n_docs"))


def drop_boilerplate(df: DataFrame, min_docs: int) -> DataFrame:
    """Remove the lines that occur in at least ``min_docs`` documents; the order of the rest is kept.

    Only the positions of repeated lines are shuffled; each document is rebuilt in its own row.
    """
    repeated = line_frequencies(df).filter(F.col("n_docs") >= min_docs).select("line_key")
    lines = df.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    hits = (
        lines.select("doc_id", "pos", F.md5(F.trim("line")).alias("line_key"))
        .join(repeated, "line_key")
        .groupBy("doc_id").agg(F.collect_set("pos").alias("_drop"))
    )
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col("_drop"), i))
    return (
        df.join(hits, "doc_id", "left")
        .withColumn("n_dropped", F.coalesce(F.size("_drop"), F.lit(0)))
        .withColumn("text", F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
        .drop("_drop")
    )


def broken_ratio(text: Column) -> Column:
    """Share of replacement characters, control characters and wrongly decoded pairs."""
    return ratio(F.regexp_count(text, F.lit(BROKEN)), F.length(text))


def encoding_gate(df: DataFrame, most: float = 0.001) -> DataFrame:
    return df.withColumn("broken_ratio", broken_ratio(F.col("text"))).filter(F.col("broken_ratio") <= most)


def _stop_words(text: Column) -> Column:
    """All stop words of a text, of every listed language, in one pass."""
    return F.filter(words(text), _one_of(sorted({w for stops in STOP_WORDS.values() for w in stops})))


def _best_language(found: Column) -> Column:
    scores = F.array(*[
        F.struct(F.size(F.filter(found, _one_of(stops))).alias("n"), F.lit(-i).alias("ord"), F.lit(lang).alias("lang"))
        for i, (lang, stops) in enumerate(STOP_WORDS.items())])
    return let(F.array_max(scores), lambda best: F.when(best["n"] == 0, "und").otherwise(best["lang"]))


def _one_of(terms: Sequence[str]) -> Callable[[Column], Column]:
    return lambda word: word.isin(*terms)


def detect_language(df: DataFrame) -> DataFrame:
    """Add ``thai_ratio`` and ``detected``.

    ``th`` from half of the letters, ``th-en`` from a tenth; otherwise the Latin
    language with the most stop words (the earlier one of two that tie), or ``und``.
    """
    letters = F.length(F.regexp_replace("text", r"\P{L}+", ""))
    thai = F.length(F.regexp_replace("text", r"[^\x{0E00}-\x{0E2F}\x{0E40}-\x{0E46}]+", ""))
    latin = let(_stop_words(F.col("text")), _best_language)
    share = ratio(thai, letters)
    return df.withColumn("thai_ratio", share).withColumn("detected", let(
        share, lambda t: F.when(t >= 0.5, "th").when(t >= 0.1, "th-en").otherwise(latin)))


def language_gate(df: DataFrame, keep: Sequence[str] = ("th", "th-en")) -> DataFrame:
    return detect_language(df).filter(F.col("detected").isin(*keep))


def symbol_ratio(text: Column) -> Column:
    """Symbols per word."""
    return ratio(F.regexp_count(text, F.lit(SYMBOL)), F.size(words(text)))


def symbol_gate(df: DataFrame, most: float = 0.5) -> DataFrame:
    return df.withColumn("symbol_ratio", symbol_ratio(F.col("text"))).filter(F.col("symbol_ratio") <= most)


def repetition(df: DataFrame, n: int = 3) -> DataFrame:
    """Add ``dup_line_ratio``, ``dup_ngram_ratio`` and ``top_ngram_ratio``; all in the document's own row."""
    lines = F.filter(F.transform(F.split("text", "\n"), F.trim), lambda line: line != "")
    frame = df.withColumn("_lines", lines).withColumn("_grams", ngrams(words(F.col("text")), n))
    sorted_grams = F.array_sort("_grams")
    # in a sorted array equal items touch: the longest run of equal neighbours is the top count
    run = F.aggregate(
        sorted_grams,
        F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best")),
        lambda acc, g: F.struct(
            g.alias("last"),
            F.when(g == acc["last"], acc["run"] + 1).otherwise(1).alias("run"),
            F.greatest(acc["best"], F.when(g == acc["last"], acc["run"] + 1).otherwise(1)).alias("best")),
        lambda acc: acc["best"],
    )
    return (
        frame
        .withColumn("dup_line_ratio", ratio(F.size("_lines") - F.size(F.array_distinct("_lines")), F.size("_lines")))
        .withColumn("dup_ngram_ratio", ratio(F.size("_grams") - F.size(F.array_distinct("_grams")), F.size("_grams")))
        .withColumn("top_ngram_ratio", ratio(run, F.size("_grams")))
        .drop("_lines", "_grams")
    )


def blocklist_score(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Add ``n_blocked`` and ``blocked_ratio``: words found in a short term list."""
    tokens = words(F.col("text"))
    hits = F.size(F.filter(tokens, lambda w: w.isin(*terms)))
    return df.withColumn("n_blocked", hits).withColumn("blocked_ratio", ratio(F.col("n_blocked"), F.size(tokens)))


def train_quality(df: DataFrame, labels: DataFrame, label: str = "quality", features: int = 1 << 12) -> DataFrame:
    """Score every document with a logistic regression over hashed words, fitted on the labelled ones."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    hasher = HashingTF(inputCol="_words", outputCol="_features", numFeatures=features)
    hashed = hasher.transform(df.withColumn("_words", words(F.col("text"))))
    train = hashed.join(labels.select("doc_id", F.col(label).cast("double").alias("_label")), "doc_id")
    model = LogisticRegression(featuresCol="_features", labelCol="_label", maxIter=20, regParam=0.1).fit(
        train.select("_features", "_label"))
    scored = model.transform(hashed)
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*df.columns, "score")


def word_odds(df: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[DataFrame, float]:
    """``term, odds`` and the odds of the classes: naive Bayes over word counts, one added to each.

    Learnt from the rows of ``df`` with a label of 0 or 1. A class without words or rows counts one.
    """
    known = df.select("doc_id", "text").join(
        labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("_y")), "doc_id")
    found = known.select("_y", F.explode(words(F.col("text"))).alias("term"))
    counts = cut(found.groupBy("term").agg(F.count_if(F.col("_y") == 1).alias("good"), F.count_if(F.col("_y") == 0).alias("bad")))
    total = counts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).first()  # three numbers
    docs = known.agg(F.count_if(F.col("_y") == 1).alias("good"), F.count_if(F.col("_y") == 0).alias("bad")).first()
    size = float((total["bad"] or 0) + total["n"]) / max((total["good"] or 0) + total["n"], 1)
    odds = counts.select("term", F.log((F.col("good") + 1) / (F.col("bad") + 1) * F.lit(size)).alias("odds"))
    return odds, math.log((docs["good"] + 1) / (docs["bad"] + 1))


def bayes_quality(df: DataFrame, odds: DataFrame, prior: float) -> DataFrame:
    """Add ``log_odds``: prior and the odds of all words of the document, per word; words not learnt count nothing.

    Words are counted per document before the join, and only (id, word, count) is shuffled.
    """
    found = df.select("doc_id", F.explode(words(F.col("text"))).alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("_n"))
    sums = found.join(odds, "term", "left").groupBy("doc_id").agg(
        ((F.lit(prior) + F.coalesce(F.sum(F.col("_n") * F.col("odds")), F.lit(0.0))) / F.sum("_n")).alias("_s"))
    return df.join(sums, "doc_id", "left").withColumn("log_odds", F.coalesce("_s", F.lit(prior))).drop("_s")


def with_provenance(df: DataFrame, path: Column, sanitized: Column) -> DataFrame:
    """Add ``original_path``, ``sanitized`` and a document key that no rerun changes."""
    return (
        df.withColumn("original_path", path).withColumn("sanitized", sanitized)
        .withColumn("doc_key", F.sha1(F.concat_ws("\u0001", F.col("original_path"), F.col("doc_id").cast("string"))))
    )


def quarantine(df: DataFrame, path: str) -> None:
    """Write sanitized and unsanitized documents to partitions of their own."""
    df.write.partitionBy("sanitized").parquet(path)


def funnel(df: DataFrame, stages: Sequence[tuple[str, Column]], tokens: Column | None = None) -> DataFrame:
    """Documents, characters and tokens left after each stage, per source and in total (``source`` null).

    One pass over the text: a document is left after a stage if it passed it and all earlier ones.
    """
    n_tokens = F.size(words(F.col("text"))) if tokens is None else tokens
    alive = F.lit(True)
    flags = [("0_input", alive)]
    for i, (name, condition) in enumerate(stages, 1):
        alive = alive & F.coalesce(condition, F.lit(False))
        flags.append((f"{i}_{name}", alive))
    marked = df.select(
        "source", F.length("text").cast("bigint").alias("_chars"), n_tokens.cast("bigint").alias("_tokens"),
        *[flag.alias(f"_f{i}") for i, (_, flag) in enumerate(flags)])
    sums = []
    for i in range(len(flags)):
        sums += [F.count_if(F.col(f"_f{i}")).alias(f"_d{i}"),
                 F.sum(F.when(F.col(f"_f{i}"), F.col("_chars")).otherwise(0)).alias(f"_c{i}"),
                 F.sum(F.when(F.col(f"_f{i}"), F.col("_tokens")).otherwise(0)).alias(f"_t{i}")]
    wide = marked.rollup("source").agg(*sums)
    rows = F.array(*[
        F.struct(F.lit(name).alias("stage"), F.col(f"_d{i}").alias("n_docs"), F.col(f"_c{i}").alias("n_chars"),
                 F.col(f"_t{i}").alias("n_tokens")) for i, (name, _) in enumerate(flags)])
    return wide.select("source", F.inline(rows))
