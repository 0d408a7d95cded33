"""Queries over scores. Runs are derived from the event, order and vector tables."""

from pyspark.sql import functions as F

from tamra.functions import calendar
from tamra.functions.text import half_up, words
from tamra.operators import evaluate, retrieve
from tamra.plans import sqltext as S
from tamra.plans.registry import query, table
from tamra.plans.retrieval import DENSE_SQL, vector_queries, vector_table


def rounded(df, *columns):
    for c in columns:
        df = df.withColumn(c, half_up(F.col(c)))
    return df


_TRUTH = "(SELECT vec_id AS query_id, CAST(vec_id + unnest([0, 10, 20]) AS VARCHAR) AS chunk_id FROM embeddings)"


@query("e1_e2_retrieval_scores", f"""
WITH {DENSE_SQL.format(where='')}, t AS MATERIALIZED {_TRUTH},
 h AS (SELECT query_id, count(*) AS hits, min(rank) AS first, sum(1 / log2(rank + 1)) AS dcg FROM dense JOIN t USING (query_id, chunk_id) WHERE rank <= 10 GROUP BY 1),
 n AS (SELECT query_id, count(*) AS n_truth FROM t GROUP BY 1)
SELECT query_id, n_truth, coalesce(hits, 0) AS hits, round(coalesce(hits, 0) / n_truth, 6) AS recall, round(coalesce(hits, 0) / 10, 6) AS "precision",
  round(coalesce(1 / first, 0), 6) AS rr, round(coalesce(dcg / (1 + 1 / log2(3) + 1 / log2(4)), 0), 6) AS ndcg FROM n LEFT JOIN h USING (query_id)""")
def retrieval_scores(spark, sf):
    ranked = retrieve.dense_topk(vector_queries(spark, sf), vector_table(spark, sf), 10)
    truth = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.explode(F.array(*[(F.col("vec_id") + i).cast("string") for i in (0, 10, 20)])).alias("chunk_id"))
    return rounded(evaluate.retrieval_at_k(ranked, truth, 10), "recall", "precision", "rr", "ndcg")


@query("e3_answer_match", """
SELECT CAST('r' AS VARCHAR) AS run_id, o_orderkey AS item_id, o_orderkey % 4 = 1 AS exact, o_orderkey % 4 <> 2 AS normalised FROM orders""")
def answer_match(spark, sf):
    orders = table(spark, sf, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    iso = day.cast("string")
    status = F.concat(F.lit("status "), F.lower("o_orderstatus"))
    answer = (F.when(key % 4 == 0, calendar.format_be(day, F.lit("day"))).when(key % 4 == 1, iso)
              .when(key % 4 == 2, F.date_add(day, 1).cast("string")).otherwise(F.concat(F.lit("  The Status  "), "o_orderstatus", F.lit("."))))
    runs = orders.select(F.lit("r").alias("run_id"), key.alias("item_id"), answer.alias("answer"))
    golden = orders.select(key.alias("item_id"), F.when(key % 4 == 3, status).otherwise(iso).alias("expected_answer"))
    return evaluate.answer_match(runs, golden)


def _overlap_sql(n):
    grams = S.grams("w", n)
    return f"""
WITH a AS (SELECT pair_id, g, count(*) AS na FROM (SELECT doc_id AS pair_id, unnest({grams}) AS g FROM (SELECT doc_id, {S.words()} AS w FROM documents)) GROUP BY 1, 2),
     b AS (SELECT pair_id, g, count(*) AS nb FROM (SELECT doc_id AS pair_id, unnest({grams}) AS g FROM (SELECT doc_id, {S.words('b.text')} AS w FROM documents d JOIN benchmark b ON item_id = doc_id % (SELECT count(*) FROM benchmark))) GROUP BY 1, 2),
     m AS (SELECT pair_id, CAST(sum(least(coalesce(na, 0), coalesce(nb, 0))) AS BIGINT) AS c, sum(coalesce(na, 0)) AS ta, sum(coalesce(nb, 0)) AS tb FROM a FULL JOIN b USING (pair_id, g) GROUP BY 1)
SELECT pair_id, c AS n_common, round(CASE WHEN ta > 0 THEN c / ta ELSE 0.0 END, 6) AS "precision", round(CASE WHEN tb > 0 THEN c / tb ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN c > 0 THEN 2.0 * c / (ta + tb) ELSE 0.0 END, 6) AS f1 FROM m"""


def _overlap(n):
    def run(spark, sf):
        bench = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("expected"))
        n_items = bench.count()
        pairs = table(spark, sf, "documents").select(
            F.col("doc_id").alias("pair_id"), F.col("text").alias("answer"), (F.col("doc_id") % n_items).alias("item_id")).join(bench, "item_id")
        return rounded(evaluate.overlap_metrics(pairs, n), "precision", "recall", "f1")
    return run


query("e4_token_f1", _overlap_sql(1))(_overlap(1))
query("e4_rouge_2", _overlap_sql(2))(_overlap(2))


@query("e4_pass_at_k", """
SELECT item_id, n, c, round(CASE WHEN n < 5 THEN NULL WHEN n - c < 5 THEN 1.0
  ELSE 1 - ((n - c) * (n - c - 1) * (n - c - 2) * (n - c - 3) * (n - c - 4))::DOUBLE / (n * (n - 1) * (n - 2) * (n - 3) * (n - 4)) END, 6) AS pass_at_k FROM (
  SELECT l_partkey AS item_id, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS c FROM lineitem GROUP BY 1)""")
def pass_at_k(spark, sf):
    attempts = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item_id"), (F.col("l_returnflag") == "R").alias("passed"))
    return rounded(evaluate.pass_at_k(attempts, 5), "pass_at_k")


@query("e5_groundedness", f"""
WITH s AS (SELECT run_id, row_number() OVER () AS s, {S.words('x')} AS w FROM (SELECT item_id AS run_id, unnest(string_split_regex(text, '[.!?\\n]+')) AS x FROM benchmark) WHERE length(trim(x)) > 0),
     c AS (SELECT DISTINCT run_id, s, unnest(CASE WHEN len(w) >= 3 THEN {S.grams('w', 3)} ELSE [array_to_string(w, ' ')] END) AS g FROM s),
     d AS (SELECT doc_id % (SELECT count(*) FROM benchmark) AS run_id, {S.words()} AS w FROM documents),
     r AS (SELECT DISTINCT run_id, unnest(list_concat({S.grams('w', 1)}, {S.grams('w', 2)}, {S.grams('w', 3)})) AS g, 1 AS hit FROM d),
     p AS (SELECT run_id, s, count(hit) / count(*) >= 0.1 AS ok FROM c LEFT JOIN r USING (run_id, g) GROUP BY 1, 2)
SELECT run_id, count(*) AS n_sentences, count(*) FILTER (ok) AS n_supported, round(count(*) FILTER (ok) / count(*), 6) AS groundedness FROM p GROUP BY 1""")
def groundedness(spark, sf):
    runs = table(spark, sf, "benchmark").select(F.col("item_id").alias("run_id"), F.col("text").alias("answer"))
    retrieved = table(spark, sf, "documents").select((F.col("doc_id") % runs.count()).alias("run_id"), "text")
    return rounded(evaluate.support(runs, retrieved, 3, 0.1), "groundedness")


@query("e6_citation_check", f"""
WITH r AS (SELECT item_id AS run_id, text AS answer, unnest(['' || item_id, '' || (item_id + 40), 'none']) AS chunk_id FROM benchmark)
SELECT run_id, chunk_id, d.text IS NOT NULL AS "exists", chunk_id = '' || run_id AS was_retrieved,
  coalesce(list_has_any({S.grams('wa', 3)}, {S.grams('wd', 3)}), false) AS holds_claim FROM (
  SELECT r.*, d.text, {S.words('answer')} AS wa, {S.words('d.text')} AS wd FROM r LEFT JOIN documents d ON '' || doc_id = chunk_id) d""")
def citation_check(spark, sf):
    item = F.col("item_id").cast("string")
    runs = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("run_id"), F.col("text").alias("answer"), F.array(item).alias("retrieved"),
        F.array(item, (F.col("item_id") + 40).cast("string"), F.lit("none")).alias("cited"))
    chunks = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), "text")
    return evaluate.citation_check(runs, chunks)


def event_runs(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("config_id"), (F.col("event_id") % 5).alias("run_id"), F.col("user_id").alias("item_id"), "event_id",
        F.col("value").alias("latency_ms"), (F.col("value") > 60).alias("refused"), (F.col("event_type") == "error").alias("attack_success"),
        (F.col("event_id") % 500 + 100).alias("input_tokens"), (F.col("event_id") % 90).alias("output_tokens"),
        (F.col("event_id") % 4).alias("n_tool_calls"), (F.col("value") * 0.001).alias("cost"), F.col("value").alias("score"))


def users(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("item_id")).distinct()


@query("e7_refusal_scores", """
SELECT event_type AS config_id, round(avg((value > 60)::INT) FILTER (user_id % 4 = 0), 6) AS refusal_accuracy,
  round(avg((value > 60)::INT) FILTER (user_id % 4 <> 0), 6) AS over_refusal FROM events GROUP BY 1""")
def refusal_scores(spark, sf):
    golden = users(spark, sf).withColumn("answerable", F.col("item_id") % 4 != 0)
    return rounded(evaluate.refusal_scores(event_runs(spark, sf), golden), "refusal_accuracy", "over_refusal")


_ATTACKS = ["in_document", "in_field", "exfiltration", "tool_call", "role_play", "multi_turn"]


@query("e8_attack_rate", f"""
SELECT attack_type, count(*) AS n, count(*) FILTER (event_type = 'error') AS n_success, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS rate
FROM (SELECT event_type, {_ATTACKS}[user_id % 6 + 1] AS attack_type FROM events) GROUP BY ROLLUP (attack_type)""")
def attack_rate(spark, sf):
    attacks = users(spark, sf).withColumn(
        "attack_type", F.element_at(F.array(*[F.lit(a) for a in _ATTACKS]), (F.col("item_id") % 6 + 1).cast("int")))
    return rounded(evaluate.attack_rate(event_runs(spark, sf), attacks), "rate")


@query("e9_cost_report", """
SELECT event_type AS config_id, count(*) AS n, CAST(sum(event_id % 500 + 100) AS BIGINT) AS input_tokens, CAST(sum(event_id % 90) AS BIGINT) AS output_tokens,
  CAST(sum(event_id % 4) AS BIGINT) AS tool_calls, round(avg(value * 0.001::DOUBLE), 6) AS cost_per_query, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1""")
def cost_report(spark, sf):
    return rounded(evaluate.cost_report(event_runs(spark, sf)), "cost_per_query", "p50", "p95")


@query("e10_run_stats", """
SELECT config_id, count(*) AS n_runs, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS spread, round(1.96::DOUBLE * stddev_samp(m) / sqrt(count(*)), 6) AS ci95
FROM (SELECT event_type AS config_id, event_id % 5 AS run_id, avg(value) AS m FROM events GROUP BY 1, 2) GROUP BY 1""")
def run_stats(spark, sf):
    return rounded(evaluate.run_stats(event_runs(spark, sf)), "mean", "spread", "ci95")


@query("e11_compare", """
WITH s AS (SELECT user_id, avg(value) FILTER (event_type = 'click') AS sa, avg(value) FILTER (event_type = 'view') AS sb FROM events GROUP BY 1),
     j AS (SELECT count(*) AS n, avg(sa) AS ma, avg(sb) AS mb, avg(sb - sa) AS gap, 1.96::DOUBLE * stddev_samp(sb - sa) / sqrt(count(*)) AS ci FROM s WHERE sa IS NOT NULL AND sb IS NOT NULL)
SELECT n, round(ma, 6) AS mean_a, round(mb, 6) AS mean_b, round(gap, 6) AS gap, round(ci, 6) AS ci95,
  CASE WHEN abs(gap) <= ci THEN 'noise' WHEN gap > 0 THEN 'b' ELSE 'a' END AS verdict FROM j""")
def compare(spark, sf):
    def config(name):
        per_user = event_runs(spark, sf).filter(F.col("config_id") == name).groupBy("item_id").agg(F.avg("score").alias("score"))
        return per_user.select("*", *[F.lit("v1").alias(v) for v in evaluate.VERSIONS])
    return rounded(evaluate.compare(config("click"), config("view")), "mean_a", "mean_b", "gap", "ci95")


@query("e11_compare_refused", """
WITH r AS (SELECT user_id, event_type, avg(value) AS s FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2)
SELECT count(*) AS n, CASE WHEN count(*) > 0 THEN 'refused' END AS verdict FROM r a JOIN r b USING (user_id) WHERE a.event_type = 'click' AND b.event_type = 'view'""")
def compare_refused(spark, sf):
    def config(name, harness):
        per_user = event_runs(spark, sf).filter(F.col("config_id") == name).groupBy("item_id").agg(F.avg("score").alias("score"))
        return per_user.select("*", F.lit(harness).alias("harness"), *[F.lit("v1").alias(v) for v in evaluate.VERSIONS[1:]])
    return evaluate.compare(config("click", "v1"), config("view", "v2")).select("n", "verdict")


_COPIES = " + ".join(f"(d >= {limit})::INTEGER" for limit in evaluate.poisson_limits())


@query("e11_bootstrap", f"""
WITH r AS (SELECT event_type AS config_id, replica, value, ('0x' || substr(md5('7-' || replica || '-' || event_id), 1, 8))::BIGINT AS d
     FROM (SELECT *, unnest(range(1, 21)) AS replica FROM events)),
     w AS (SELECT *, {_COPIES} AS w FROM r)
SELECT config_id, CAST(replica AS INTEGER) AS replica, round(sum(value * w) / sum(w), 6) AS mean FROM w GROUP BY 1, 2""")
def bootstrap(spark, sf):
    scores = event_runs(spark, sf).select("config_id", F.col("event_id").alias("item_id"), "score")
    return rounded(evaluate.bootstrap(scores, 20, 7), "mean")


@query("e12_frontier", """
WITH p AS (SELECT p_partkey AS config_id, CASE WHEN p_partkey % 50 > 0 THEN p_retailprice END AS cost, p_size / 50 AS accuracy,
  coalesce(CASE WHEN p_partkey % 50 > 0 THEN p_retailprice END, 'infinity'::DOUBLE) AS c FROM part)
SELECT config_id, cost, accuracy FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE (b.c < a.c AND b.accuracy >= a.accuracy) OR (b.c = a.c AND b.accuracy > a.accuracy))""")
def frontier(spark, sf):
    scores = table(spark, sf, "part").select(F.col("p_partkey").alias("config_id"), F.when(F.col("p_partkey") % 50 > 0, F.col("p_retailprice")).alias("cost"),
                                             (F.col("p_size") / 50).alias("accuracy"))
    return evaluate.frontier(scores)


_LIMITS = [("recall", "min", 0.045, True), ("latency", "max", 26.0, True), ("refused", "max", 0.34, False)]


@query("e13_scorecard", f"""
WITH m AS (SELECT l_suppkey AS config_id, avg(l_discount) AS recall, avg(l_quantity) AS latency, avg((l_returnflag = 'R')::INT) AS refused FROM lineitem GROUP BY 1),
     l AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}', {c}::DOUBLE, {d})" for a, b, c, d in _LIMITS)}) t(metric, direction, limit_value, hard)),
     j AS (SELECT config_id, u.metric, value, limit_value, direction, hard, CASE WHEN direction = 'min' THEN value >= limit_value ELSE value <= limit_value END AS passed
       FROM (UNPIVOT m ON recall, latency, refused INTO NAME metric VALUE value) u JOIN l ON l.metric = u.metric)
SELECT config_id, metric, round(value, 6) AS value, limit_value, direction, passed, bool_and(passed OR NOT hard) OVER (PARTITION BY config_id) AS qualified FROM j""")
def scorecard(spark, sf):
    metrics = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("config_id")).agg(
        F.avg("l_discount").alias("recall"), F.avg("l_quantity").alias("latency"), F.avg((F.col("l_returnflag") == "R").cast("double")).alias("refused"))
    limits = spark.createDataFrame(_LIMITS, "metric string, direction string, limit_value double, hard boolean")
    return rounded(evaluate.scorecard(metrics, limits), "value")


@query("e14_regressions", """
SELECT o_orderpriority AS category, count(*) AS n, count(*) FILTER (NOT o_totalprice > 100000 AND o_orderstatus = 'F') AS fixed,
  count(*) FILTER (o_totalprice > 100000 AND o_orderstatus <> 'F') AS broken FROM orders GROUP BY 1""")
def regressions(spark, sf):
    orders = table(spark, sf, "orders")
    base = orders.select(F.col("o_orderkey").alias("item_id"), F.col("o_orderpriority").alias("category"), (F.col("o_totalprice") > 100000).alias("passed"))
    current = orders.select(F.col("o_orderkey").alias("item_id"), (F.col("o_orderstatus") == "F").alias("passed"))
    return evaluate.regressions(base, current)


def order_items(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("item_id"), F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("difficulty"),
        F.col("o_totalprice").alias("score"))


@query("e15_breakdown", """
SELECT o_orderpriority AS category, o_orderstatus AS difficulty, CAST(grouping_id(o_orderpriority, o_orderstatus) AS BIGINT) AS level, count(*) AS n, round(avg(o_totalprice), 4) AS mean_score
FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def breakdown(spark, sf):
    return evaluate.breakdown(order_items(spark, sf)).withColumn("mean_score", F.round("mean_score", 4))


_GOLDEN = """(SELECT * FROM (SELECT o_orderkey AS item_id, o_orderpriority AS category, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42-' || o_orderkey), o_orderkey) AS r FROM orders) WHERE r <= 30)"""


@query("e16_golden_sample", f"SELECT item_id, category FROM {_GOLDEN}")
def golden_sample(spark, sf):
    return evaluate.golden_sample(order_items(spark, sf), 30, 42).select("item_id", "category")


@query("e16_held_out", f"SELECT item_id, category FROM {_GOLDEN} WHERE o_orderstatus = 'P'")
def held_out(spark, sf):
    items = order_items(spark, sf)
    return evaluate.held_out(evaluate.golden_sample(items, 30, 42), items.filter("difficulty = 'P'")).select("item_id", "category")


@query("e17_trajectory", """
WITH r AS (SELECT l_orderkey AS k, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_returnflag) AS c FROM lineitem GROUP BY 1)
SELECT 'r' AS run_id, k AS item_id,
  CAST(CASE k % 3 WHEN 0 THEN (NOT contains(c, 'N'))::INT + (NOT contains(c, 'R'))::INT WHEN 1 THEN (NOT contains(c, 'A'))::INT ELSE (NOT contains(c, 'R'))::INT END AS INTEGER) AS missing,
  CAST(CASE k % 3 WHEN 0 THEN contains(c, 'A')::INT WHEN 1 THEN contains(c, 'N')::INT + contains(c, 'R')::INT ELSE contains(c, 'A')::INT + contains(c, 'N')::INT END AS INTEGER) AS extra,
  CASE k % 3 WHEN 0 THEN c LIKE '%N%R%' WHEN 1 THEN c LIKE '%A%A%' ELSE c LIKE '%R%' END AS in_order FROM r""")
def trajectory(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("item_id")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("_c"))  # at most the lines of one order
    runs = lines.select(F.lit("r").alias("run_id"), "item_id", F.col("_c.l_returnflag").alias("tool_calls"))
    need = F.when(F.col("item_id") % 3 == 0, F.array(F.lit("N"), F.lit("R"))).when(F.col("item_id") % 3 == 1, F.array(F.lit("A"), F.lit("A"))).otherwise(F.array(F.lit("R")))
    return evaluate.trajectory(runs, lines.select("item_id", need.alias("required_tool_calls")))


@query("e18_judge_agreement", """
WITH j AS (SELECT value AS score, event_id % 97 AS length, user_id % 2 = 0 AS first_won, CASE WHEN value > 10 THEN 'good' ELSE 'bad' END AS a, CASE WHEN value > 12 OR user_id % 10 = 0 THEN 'good' ELSE 'bad' END AS b FROM events),
     m AS (SELECT count(*) AS n, avg((a = b)::INT) AS po, avg((a = 'good')::INT) * avg((b = 'good')::INT) + avg((a = 'bad')::INT) * avg((b = 'bad')::INT) AS pe,
       corr(score, length) AS r, avg(first_won::INT) AS f FROM j)
SELECT n, round(po, 6) AS agreement, round((po - pe) / (1 - pe), 6) AS kappa, round(r, 6) AS length_corr, round(f, 6) AS first_share FROM m""")
def judge_agreement(spark, sf):
    events = table(spark, sf, "events")
    judged = events.select(F.col("event_id").alias("item_id"), F.when(F.col("value") > 10, "good").otherwise("bad").alias("label"), F.col("value").alias("score"),
                           (F.col("event_id") % 97).alias("length"), (F.col("user_id") % 2 == 0).alias("first_won"))
    human = events.select(F.col("event_id").alias("item_id"), F.when((F.col("value") > 12) | (F.col("user_id") % 10 == 0), "good").otherwise("bad").alias("label"))
    return rounded(evaluate.judge_agreement(judged, human), "agreement", "kappa", "length_corr", "first_share")


@query("e19_saturated", """
SELECT l_orderkey AS bench_id, count(*) AS n, round(min(1 - l_discount), 6) AS lowest FROM lineitem GROUP BY 1 HAVING min(1 - l_discount) > 0.9""")
def saturated(spark, sf):
    scores = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("bench_id"), (1 - F.col("l_discount")).alias("score"))
    return rounded(evaluate.saturated(scores), "lowest")


@query("e20_group_gap", """
SELECT count(*) AS n_groups, round(max(m), 6) AS best, round(min(m), 6) AS worst, round(max(m) - min(m), 6) AS gap FROM (SELECT avg(c_acctbal) AS m FROM customer GROUP BY c_mktsegment)""")
def group_gap(spark, sf):
    scores = table(spark, sf, "customer").select("c_mktsegment", F.col("c_acctbal").alias("score"))
    return rounded(evaluate.group_gap(scores, "c_mktsegment"), "best", "worst", "gap")


@query("e21_preference_pairs", """
WITH r AS (SELECT l_orderkey, l_partkey, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY floor(l_quantity / 10)) AS n FROM lineitem)
SELECT a.l_orderkey AS prompt_id, a.l_partkey AS chosen, b.l_partkey AS rejected FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.n < b.n""")
def preference_pairs(spark, sf):
    return evaluate.preference_pairs(table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("prompt_id"), F.col("l_partkey").alias("answer_id"), F.floor(F.col("l_quantity") / 10).alias("rank")))


_PERTURBED = f"""(SELECT item_id AS query_id, text AS base, unnest(['typo', 'case', 'spacing', 'digits']) AS kind, unnest([
   substr(text, 1, p) || substr(text, p + 2, 1) || substr(text, p + 1, 1) || substr(text, p + 3), lower(text), replace(text, ' ', '  '), translate(text, '0123456789', '{calendar.THAI_DIGITS}')]) AS text
   FROM (SELECT *, ('0x' || substr(md5('3-' || item_id), 1, 8))::BIGINT % (length(text) - 1) AS p FROM benchmark))"""


def perturbed(spark, sf):
    return evaluate.perturb(table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text"), 3)


@query("e22_perturb", f"SELECT query_id, kind, text FROM {_PERTURBED}")
def perturb(spark, sf):
    return perturbed(spark, sf)


@query("e22_perturbation_drop", f"""
SELECT kind, count(*) AS n, round(avg(1.0::DOUBLE - len(list_intersect(list_distinct({S.words('base')}), list_distinct({S.words('text')}))) / len(list_distinct({S.words('base')}))), 6) AS mean_drop
FROM {_PERTURBED} GROUP BY 1""")
def perturbation_drop(spark, sf):
    base = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.lit(1.0).alias("score"), F.col("text").alias("_base"))
    wanted = F.array_distinct(words(F.col("_base")))
    scored = perturbed(spark, sf).join(base.drop("score"), "query_id").withColumn("score", F.size(F.array_intersect(wanted, words(F.col("text")))) / F.size(wanted))
    return rounded(evaluate.perturbation_drop(base, scored.select("query_id", "kind", "score")), "mean_drop")
