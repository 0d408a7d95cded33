"""Scores: retrieval, answers, citations, refusals, attacks, cost, comparison, golden sets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamra.functions.calendar import arabic_digits, parse_date
from tamra.functions.text import collapse, let, ngrams, words
from tamra.operators.ordering import with_value_bucket

SATURATED = 0.9


def retrieval_at_k(ranked: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """``query_id, n_truth, hits, recall, precision, rr, ndcg`` of the first ``k`` ranks.

    ``truth`` holds distinct ``query_id, chunk_id``. Queries without truth are left out: their
    recall has no meaning.
    """
    sizes = truth.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_truth"))
    hits = ranked.filter(F.col("rank") <= k).join(truth, ["query_id", "chunk_id"], "left_semi").groupBy("query_id").agg(
        F.count(F.lit(1)).alias("hits"), F.min("rank").alias("first"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"))
    gains = [0.0]
    for i in range(1, k + 1):  # the best possible gain for 0..k relevant items

        gains.append(gains[-1] + 1 / math.log2(i + 1))
    ideal = F.element_at(F.array(*[F.lit(g) for g in gains]), F.least(F.col("n_truth"), F.lit(k)).cast("int") + 1)
    joined = sizes.join(hits, "query_id", "left").na.fill(0, ["hits"])
    return joined.select(
        "query_id", "n_truth", "hits", (F.col("hits") / F.col("n_truth")).alias("recall"), (F.col("hits") / k).alias("precision"),
        F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("rr"), F.coalesce(F.col("dcg") / ideal, F.lit(0.0)).alias("ndcg"))


def normalise_answer(text: Column) -> Column:
    """Dates as ISO days, other text in lower case with Arabic digits, without symbols at the ends or articles."""
    day = parse_date(text)
    plain = F.regexp_replace(collapse(arabic_digits(text)), r"\b(?:a|an|the)\b ?|(?<=\d),(?=\d{3})", "")
    plain = F.trim(F.regexp_replace(plain, r"^[^\p{L}\p{N}]+|[^\p{L}\p{M}\p{N}]+$", ""))
    return F.when(day["precision"] == "day", day["ce_date"].cast("string")).otherwise(plain)


def answer_match(runs: DataFrame, golden: DataFrame) -> DataFrame:
    """``run_id, item_id, exact, normalised``."""
    both = runs.join(golden.select("item_id", "expected_answer"), "item_id")
    same = normalise_answer(F.col("answer")) == normalise_answer(F.col("expected_answer"))
    return both.select("run_id", "item_id", (F.col("answer") == F.col("expected_answer")).alias("exact"), same.alias("normalised"))


def overlap_metrics(pairs: DataFrame, n: int = 1) -> DataFrame:
    """``pair_id, n_common, precision, recall, f1`` of the word ``n``-grams of ``answer`` and ``expected``.

    ``n = 1`` is token F1; recall for ``n`` is ROUGE-N, precision is BLEU's clipped precision.
    """
    texts = pairs.select("pair_id", F.explode(F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("text")) for i, c in enumerate(("answer", "expected"))])).alias("t"))
    dealt = texts.select("pair_id", "t.*").repartition("pair_id")  # texts travel once, n-grams stay in their task
    grams = dealt.select("pair_id", "side", F.explode_outer(ngrams(words(F.col("text")), n)).alias("g")).filter("g IS NOT NULL")
    counts = grams.groupBy("pair_id", "g").agg(F.count_if(F.col("side") == 0).alias("na"), F.count_if(F.col("side") == 1).alias("nb"))
    common = F.when(F.col("pair_id").isNotNull(), F.least("na", "nb")).otherwise(0)  # texts without a pair have nothing in common
    merged = counts.groupBy("pair_id").agg(F.sum(common).alias("n_common"), F.sum("na").alias("ta"), F.sum("nb").alias("tb"))
    p = F.when(F.col("ta") > 0, F.col("n_common") / F.col("ta")).otherwise(0.0)
    r = F.when(F.col("tb") > 0, F.col("n_common") / F.col("tb")).otherwise(0.0)
    scored = merged.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("n_common") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return scored.withColumn("f1", f1).drop("ta", "tb")


def pass_at_k(attempts: DataFrame, k: int) -> DataFrame:
    """``item_id, n, c, pass_at_k``: ``1 - C(n - c, k) / C(n, k)`` from boolean ``passed``."""
    counts = attempts.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("c"))
    missing = F.aggregate(
        F.sequence(F.lit(0), F.lit(k - 1)), F.lit(1.0),
        lambda acc, i: acc * (F.col("n") - F.col("c") - i) / F.greatest(F.col("n") - i, F.lit(1)))
    value = F.when(F.col("n") < k, None).when(F.col("n") - F.col("c") < k, 1.0).otherwise(1 - missing)
    return counts.withColumn("pass_at_k", value)


def _sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"[.!?\n]+"), lambda s: F.length(F.trim(s)) > 0)


def support(runs: DataFrame, retrieved: DataFrame, n: int = 3, least: float = 0.5) -> DataFrame:
    """``run_id, n_sentences, n_supported, groundedness``: sentences whose word ``n``-grams stand in the retrieved text.

    ``retrieved`` holds ``run_id, text``. A sentence is supported if a share of ``least`` of its
    n-grams is found; one shorter than ``n`` words is taken as a whole. Only n-grams that a sentence
    of the same run holds are kept of the retrieved text.
    """
    sentences = runs.select("run_id", F.posexplode_outer(_sentences(F.col("answer"))).alias("s", "sentence")).filter("s IS NOT NULL")
    phrase = F.when(F.size(words(F.col("sentence"))) >= n, ngrams(words(F.col("sentence")), n)).otherwise(
        F.array(F.concat_ws(" ", words(F.col("sentence")))))
    claims = sentences.select("run_id", "s", F.explode_outer(F.array_distinct(phrase)).alias("g"))
    grams = let(words(F.col("text")), lambda w: F.array_distinct(F.flatten(F.array(*[ngrams(w, i) for i in range(1, n + 1)]))))
    given = (retrieved.select("run_id", F.explode_outer(grams).alias("g")).filter("g IS NOT NULL")
             .join(claims.select("run_id", "g").distinct(), ["run_id", "g"], "left_semi").distinct().withColumn("hit", F.lit(1)))
    per_sentence = claims.join(given, ["run_id", "g"], "left").groupBy("run_id", "s").agg(
        (F.count("hit") / F.count(F.lit(1)) >= least).alias("ok"))
    return per_sentence.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.count_if("ok").alias("n_supported")).withColumn(
        "groundedness", F.col("n_supported") / F.col("n_sentences"))


def citation_check(runs: DataFrame, chunks: DataFrame, n: int = 3) -> DataFrame:
    """``run_id, chunk_id, exists, was_retrieved, holds_claim`` for every citation."""
    cited = runs.select("run_id", "answer", "retrieved", F.explode_outer("cited").alias("chunk_id")).filter("chunk_id IS NOT NULL")
    joined = cited.join(chunks.select("chunk_id", F.col("text").alias("_t")), "chunk_id", "left")
    holds = F.arrays_overlap(ngrams(words(F.col("answer")), n), ngrams(words(F.col("_t")), n))
    return joined.select(
        "run_id", "chunk_id", F.col("_t").isNotNull().alias("exists"),
        F.coalesce(F.array_contains("retrieved", F.col("chunk_id")), F.lit(False)).alias("was_retrieved"),
        F.coalesce(holds, F.lit(False)).alias("holds_claim"))


def refusal_scores(runs: DataFrame, golden: DataFrame) -> DataFrame:
    """``config_id, refusal_accuracy, over_refusal``: refused where nothing can be answered, and where it could."""
    both = runs.join(golden.select("item_id", "answerable"), "item_id")
    refused = F.col("refused").cast("double")
    return both.groupBy("config_id").agg(
        F.avg(F.when(~F.col("answerable"), refused)).alias("refusal_accuracy"),
        F.avg(F.when(F.col("answerable"), refused)).alias("over_refusal"))


def attack_rate(runs: DataFrame, attacks: DataFrame) -> DataFrame:
    """``attack_type, n, n_success, rate`` with a total row (``attack_type`` null)."""
    both = runs.join(attacks.select("item_id", "attack_type"), "item_id")
    return both.rollup("attack_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("attack_success").alias("n_success")).withColumn("rate", F.col("n_success") / F.col("n"))


def cost_report(runs: DataFrame, exact: bool = True) -> DataFrame:
    """Tokens, tool calls, cost per query, median and 95th percentile latency per configuration.

    ``exact=False`` uses a sketch instead of all latencies of a configuration.
    """
    def percentile(p: float) -> Column:
        return F.percentile("latency_ms", p) if exact else F.percentile_approx("latency_ms", p, 10_000)

    return runs.groupBy("config_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        F.sum("n_tool_calls").alias("tool_calls"), F.avg("cost").alias("cost_per_query"),
        percentile(0.5).alias("p50"), percentile(0.95).alias("p95"))


def run_stats(scores: DataFrame) -> DataFrame:
    """``config_id, n_runs, mean, spread, ci95`` over the means of repeated runs; spread is null below three runs."""
    per_run = scores.groupBy("config_id", "run_id").agg(F.avg("score").alias("m"))
    enough = F.count(F.lit(1)) >= 3
    return per_run.groupBy("config_id").agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("m").alias("mean"), F.when(enough, F.stddev_samp("m")).alias("spread"),
        F.when(enough, 1.96 * F.stddev_samp("m") / F.sqrt(F.count(F.lit(1)))).alias("ci95"))


VERSIONS = ("harness", "golden_version", "attack_version")


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """``n, mean_a, mean_b, gap, ci95, verdict`` of two configurations on the same items.

    The verdict is ``noise`` for a gap inside its confidence interval, and ``refused`` where the
    two were not run with the same harness, golden set and attack set.
    """
    left = a.select("item_id", F.col("score").alias("sa"), *[F.col(v).alias(f"{v}_a") for v in VERSIONS])
    right = b.select("item_id", F.col("score").alias("sb"), *[F.col(v).alias(f"{v}_b") for v in VERSIONS])
    same = F.lit(True)
    for v in VERSIONS:
        same = same & F.col(f"{v}_a").eqNullSafe(F.col(f"{v}_b"))
    d = F.col("sb") - F.col("sa")
    joined = left.join(right, "item_id").select("sa", "sb", d.alias("d"), same.alias("same"))
    row = joined.agg(F.count(F.lit(1)).alias("n"), F.avg("sa").alias("mean_a"), F.avg("sb").alias("mean_b"), F.avg("d").alias("gap"),
                     (1.96 * F.stddev_samp("d") / F.sqrt(F.count(F.lit(1)))).alias("ci95"), F.bool_and("same").alias("_same"))
    verdict = F.when(~F.col("_same"), "refused").when(F.abs("gap") <= F.col("ci95"), "noise").when(F.col("gap") > 0, "b").otherwise("a")
    return row.withColumn("verdict", verdict).drop("_same")


def poisson_limits(bits: int = 32) -> list[int]:
    """Draws of ``bits`` bits at or above the k-th limit stand for k + 1 copies or more (mean one)."""
    limits, share, total = [], math.exp(-1), 0.0
    while True:
        total += share
        limit = round(total * 2**bits)
        if limit >= 2**bits:
            return limits
        limits.append(limit)
        share /= len(limits)


def bootstrap(scores: DataFrame, replicas: int, seed: int) -> DataFrame:
    """``config_id, replica, mean``: each item gets a seeded number of copies in each replica (Poisson draws).

    Counts follow a Poisson law with mean one, to the 32 bits of the draw, so no item list is gathered.
    """
    rows = scores.select("config_id", "item_id", "score", F.explode(F.sequence(F.lit(1), F.lit(replicas))).alias("replica"))
    text = F.concat_ws("-", F.lit(str(seed)), F.col("replica").cast("string"), F.col("item_id").cast("string"))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    times = F.lit(0)
    for limit in poisson_limits():
        times = times + F.when(draw >= limit, 1).otherwise(0)
    weighted = rows.withColumn("_w", times)
    return weighted.groupBy("config_id", "replica").agg((F.sum(F.col("score") * F.col("_w")) / F.sum("_w")).alias("mean"))


def frontier(scores: DataFrame) -> DataFrame:
    """Configurations that no other beats in accuracy at the same or lower cost.

    The best accuracy of all cheaper ones is a running maximum over cost buckets. A configuration
    without a cost counts as dearer than all others.
    """
    scores = scores.withColumn("_cost", F.coalesce(F.col("cost").cast("double"), F.lit(float("inf"))))
    best = scores.groupBy("_cost").agg(F.max("accuracy").alias("_best"))
    marked = with_value_bucket(best, "_cost")
    inside = W.partitionBy("_bucket").orderBy("_cost").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # over the few bucket rows only
    heads = marked.groupBy("_bucket").agg(F.max("_best").alias("_m")).select("_bucket", F.max("_m").over(earlier).alias("_off"))
    reach = marked.withColumn("_in", F.max("_best").over(inside)).join(heads, "_bucket").select(
        "_cost", "_best", F.greatest("_in", "_off").alias("_cheaper"))
    return scores.join(reach, "_cost").filter(
        (F.col("accuracy") == F.col("_best")) & (F.col("_cheaper").isNull() | (F.col("accuracy") > F.col("_cheaper")))).drop("_best", "_cheaper", "_cost")


def scorecard(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """``config_id, metric, value, limit_value, direction, passed, qualified``; one failed hard limit disqualifies.

    ``limits``: ``metric, direction`` (``min`` or ``max``), ``limit_value, hard``. ``metrics``: one column per metric.
    """
    names = [c for c in metrics.columns if c != "config_id"]
    long = metrics.unpivot(["config_id"], names, "metric", "value").join(limits, "metric")
    ok = F.when(F.col("direction") == "min", F.col("value") >= F.col("limit_value")).otherwise(F.col("value") <= F.col("limit_value"))
    judged = long.withColumn("passed", F.coalesce(ok, F.lit(False)))
    verdict = judged.groupBy("config_id").agg(F.bool_and(F.col("passed") | ~F.col("hard")).alias("qualified"))
    return judged.join(verdict, "config_id").select("config_id", "metric", "value", "limit_value", "direction", "passed", "qualified")


def regressions(base: DataFrame, current: DataFrame) -> DataFrame:
    """``category, n, fixed, broken``: items that changed from fail to pass and from pass to fail."""
    both = base.select("item_id", "category", F.col("passed").alias("p0")).join(
        current.select("item_id", F.col("passed").alias("p1")), "item_id")
    return both.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("p0") & F.col("p1")).alias("fixed"), F.count_if(F.col("p0") & ~F.col("p1")).alias("broken"))


def breakdown(scores: DataFrame) -> DataFrame:
    """Mean score by category and difficulty with all totals; ``level`` is the grouping id (0 detail, 3 grand total)."""
    return scores.cube("category", "difficulty").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"))


def golden_sample(df: DataFrame, per_stratum: int, seed: int, stratum: str = "category", key: str = "item_id") -> DataFrame:
    """The first ``per_stratum`` items of each stratum by seeded hash: the same items on every run."""
    hashed = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    best = W.partitionBy(stratum).orderBy("_h", key)
    return df.withColumn("_h", hashed).withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= per_stratum).drop("_h", "_r")


def held_out(golden: DataFrame, tuning: DataFrame, key: str = "item_id") -> DataFrame:
    """Golden items that were used for tuning; must be empty."""
    return golden.join(tuning.select(key), key, "left_semi")


def trajectory(runs: DataFrame, golden: DataFrame) -> DataFrame:
    """``run_id, item_id, missing, extra, in_order`` of the tool calls against the required ones.

    In order: each required call is found after the one before it.
    """
    both = runs.join(golden.select("item_id", "required_tool_calls"), "item_id")

    def ordered(t: Column) -> Column:
        def step(place: Column, name: Column) -> Column:
            # the first call with this name after the one before it
            later = F.filter(F.sequence(F.lit(1), F.greatest(F.size(t["calls"]), F.lit(1))),
                             lambda i: (i > place) & (F.get(t["calls"], i - 1) == name))
            return F.when(place < 0, F.lit(-1)).otherwise(F.coalesce(F.get(later, F.lit(0)), F.lit(-1)))
        return F.aggregate(t["required"], F.lit(0), step) >= 0

    pair = F.struct(F.col("tool_calls").alias("calls"), F.col("required_tool_calls").alias("required"))
    return both.select("run_id", "item_id", F.size(F.array_except("required_tool_calls", "tool_calls")).alias("missing"),
                       F.size(F.array_except("tool_calls", "required_tool_calls")).alias("extra"), let(pair, ordered).alias("in_order"))


def judge_agreement(judged: DataFrame, human: DataFrame) -> DataFrame:
    """One row: ``n, agreement, kappa, length_corr, first_share``.

    ``length_corr`` shows verbosity bias, ``first_share`` position bias (share of wins of the answer shown first).
    """
    both = judged.join(human.select("item_id", F.col("label").alias("truth")), "item_id")
    agree = F.col("label") == F.col("truth")
    cells = both.groupBy("label", "truth").agg(F.count(F.lit(1)).alias("n"))
    margins = cells.select(F.col("label").alias("v"), F.col("n").alias("a"), F.lit(0).alias("b")).unionByName(
        cells.select(F.col("truth").alias("v"), F.lit(0).alias("a"), F.col("n").alias("b"))).groupBy("v").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))
    chance = margins.agg(F.sum(F.col("a") * F.col("b")) / (F.sum("a") * F.sum("b"))).first()[0]  # one number
    base = both.agg(F.count(F.lit(1)).alias("n"), F.avg(agree.cast("double")).alias("agreement"),
                    F.corr("score", "length").alias("length_corr"), F.avg(F.col("first_won").cast("double")).alias("first_share"))
    kappa = F.lit(None).cast("double") if chance is None or chance >= 1 else (F.col("agreement") - chance) / (1 - chance)
    return base.withColumn("kappa", kappa).select("n", "agreement", "kappa", "length_corr", "first_share")


def saturated(scores: DataFrame, least: float = SATURATED) -> DataFrame:
    """Benchmarks on which every candidate is above ``least``."""
    return scores.groupBy("bench_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("lowest")).filter(F.col("lowest") > least)


def group_gap(scores: DataFrame, attribute: str) -> DataFrame:
    """One row: ``n_groups, best, worst, gap`` of the group means."""
    means = scores.groupBy(attribute).agg(F.avg("score").alias("m"))
    return means.agg(F.count(F.lit(1)).alias("n_groups"), F.max("m").alias("best"), F.min("m").alias("worst"),
                     (F.max("m") - F.min("m")).alias("gap"))


def preference_pairs(rankings: DataFrame) -> DataFrame:
    """``prompt_id, chosen, rejected``: every ordered pair of a prompt's answers (``answer_id, rank``), the better rank first.

    The result has a row for each pair, so it grows with the square of a prompt's answers. The
    join key is prompt and rank of the chosen answer: each answer goes to the better ranks that
    occur in its prompt, so a prompt of many answers is spread over its ranks.
    """
    ranks = rankings.where(F.col("rank").isNotNull()).groupBy("prompt_id").agg(F.collect_set("rank").alias("_ranks"))
    better = F.explode(F.filter("_ranks", lambda r: r < F.col("rank"))).alias("_rank")
    b = rankings.join(ranks, "prompt_id").select("prompt_id", F.col("answer_id").alias("rejected"), better)
    a = rankings.select("prompt_id", F.col("answer_id").alias("chosen"), F.col("rank").alias("_rank"))
    return a.join(b, ["prompt_id", "_rank"]).select("prompt_id", "chosen", "rejected")


def perturb(queries: DataFrame, seed: int, key: str = "query_id") -> DataFrame:
    """``query_id, kind, text``: typo (two letters swapped), lower case, doubled blanks, Thai digits."""
    from tamra.functions.calendar import thai_digits

    text, size = F.col("text"), F.length("text")
    draw = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    place = F.when(size > 1, draw % (size - 1)).otherwise(0).cast("int")
    swapped = F.concat(F.substring(text, F.lit(1), place), F.substring(text, place + 2, F.lit(1)), F.substring(text, place + 1, F.lit(1)),
                       F.substring(text, place + 3, size))
    kinds = F.array(*[
        F.struct(F.lit(kind).alias("kind"), value.alias("text")) for kind, value in (
            ("typo", F.when(size > 1, swapped).otherwise(text)), ("case", F.lower(text)),
            ("spacing", F.replace(text, F.lit(" "), F.lit("  "))), ("digits", thai_digits(text)))])
    return queries.select(key, F.inline(kinds))


def perturbation_drop(base: DataFrame, perturbed: DataFrame, key: str = "query_id") -> DataFrame:
    """``kind, n, mean_drop``: score lost per kind of perturbation."""
    both = perturbed.join(base.select(key, F.col("score").alias("_base")), key)
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("_base") - F.col("score")).alias("mean_drop"))
