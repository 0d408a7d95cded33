"""Queries over cleaning and deduplication."""

from itertools import combinations

from pyspark.sql import functions as F

from tamra.functions.text import half_up
from tamra.operators import clean, dedup
from tamra.plans import sqltext as S
from tamra.plans.registry import query, table
from tamra.session import scratch

TERMS = ("worthless", "click", "free", "offer", "win", "casino", "idiot", "stupid")


def documents(spark, sf):
    return table(spark, sf, "documents")


@query("c1_min_length", "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 50")
def min_length(spark, sf):
    return clean.min_length(documents(spark, sf), 50).select("doc_id", "n_chars")


# What stands behind every page: entities of each form, one unknown, and one that must not be decoded twice.
MORE_HTML = "<p>caf&eacute; &#8217;&#x2014; &unknown; &amp;lt;&#0;</p>"
# Those that occur in the pages and in the line above, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&eacute;", "é"), ("&#8217;", "’"),
            ("&#x2014;", "—"), ("&amp;", "&"))


def _decoded(expression):
    for entity, char in ENTITIES:
        expression = f"replace({expression}, {S.quote(entity)}, {S.quote(char)})"
    return expression


@query("c2_html_to_text", f"""
SELECT page_id, trim({_decoded("regexp_extract(html, " + S.quote(clean.TITLE) + ", 1)")}) AS title,
       trim({S.replace_all(_decoded(S.replace_all("html", clean.MARKUP_RULES)), clean.SPACE_RULES)}) AS text FROM (SELECT page_id, html || {S.quote(MORE_HTML)} AS html FROM pages)""")
def html_to_text(spark, sf):
    pages = table(spark, sf, "pages").withColumn("html", F.concat("html", F.lit(MORE_HTML)))
    return clean.html_to_text(pages).select("page_id", "title", "text")


@query("c3_boilerplate", """
WITH l AS (SELECT doc_id, p, ls[p] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS p
           FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
     hot AS (SELECT trim(line) AS line FROM l WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
     kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text, count(*) AS n FROM l
              WHERE trim(line) NOT IN (SELECT line FROM hot) GROUP BY 1)
SELECT d.doc_id, coalesce(k.text, '') AS text,
       CAST(len(string_split(d.text, chr(10))) - coalesce(k.n, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN kept k USING (doc_id)""")
def boilerplate(spark, sf):
    return clean.drop_boilerplate(documents(spark, sf), 3).select(
        "doc_id", "text", F.col("n_dropped").cast("bigint").alias("n_dropped"))


@query("c4_encoding_gate", f"""
SELECT doc_id, round(r, 6) AS broken_ratio FROM (
  SELECT doc_id, CASE WHEN length(text) > 0 THEN {S.matches(clean.BROKEN)} / length(text) ELSE 0.0 END AS r FROM documents)
WHERE r <= 0.001""")
def encoding_gate(spark, sf):
    return clean.encoding_gate(documents(spark, sf)).select("doc_id", half_up(F.col("broken_ratio")).alias("broken_ratio"))


def _stops(lang):
    return f"len(list_filter(w, lambda x: list_contains({list(clean.STOP_WORDS[lang])}, x))) AS {lang}"


@query("c5_language_gate", f"""
WITH s AS (SELECT doc_id, lang, {', '.join(_stops(x) for x in clean.STOP_WORDS)},
                  {S.matches('[\\x{0E00}-\\x{0E2F}\\x{0E40}-\\x{0E46}]')} AS thai, {S.matches('\\p{L}')} AS letters
           FROM (SELECT *, {S.words()} AS w FROM documents)),
     d AS (SELECT doc_id, lang, CASE WHEN letters > 0 AND thai / letters >= 0.5 THEN 'th'
             WHEN letters > 0 AND thai / letters >= 0.1 THEN 'th-en'
             WHEN greatest(en, fr, de, es) = 0 THEN 'und' WHEN en = greatest(en, fr, de, es) THEN 'en'
             WHEN fr = greatest(en, fr, de, es) THEN 'fr' WHEN de = greatest(en, fr, de, es) THEN 'de'
             ELSE 'es' END AS detected FROM s)
SELECT doc_id, lang, detected FROM d WHERE detected IN ('th', 'th-en', 'en')""")
def language_gate(spark, sf):
    return clean.language_gate(documents(spark, sf), ("th", "th-en", "en")).select("doc_id", "lang", "detected")


SHA = f"sha1({S.collapse()})"


@query("c6_exact_dedup", f"""
SELECT min(doc_id) AS doc_id, count(*) AS n_copies, arg_min(source, doc_id) AS source FROM documents GROUP BY {SHA}""")
def exact_dedup(spark, sf):
    return dedup.exact_dedup(documents(spark, sf)).select("doc_id", "n_copies", "source")


SHINGLES = f"""sh AS MATERIALIZED (
  SELECT doc_id, list_distinct(list_transform(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE {S.grams('w', 3)} END, lambda s: {S.hash32('s')})) AS hs
  FROM (SELECT doc_id, {S.words()} AS w FROM documents))"""
BANDS, ROWS = 16, 4


def _reach(accepted):
    """Components over all accepted pairs (a, b), by closure: ``comp`` holds doc_id and the smallest id reached."""
    return f"""e AS MATERIALIZED (SELECT a, b FROM ({accepted}) UNION SELECT b, a FROM ({accepted})),
  reach AS (SELECT a AS start, b AS node FROM e UNION SELECT start, e.b FROM reach JOIN e ON node = e.a),
  comp AS MATERIALIZED (SELECT start AS doc_id, least(start, min(node)) AS cluster_id FROM reach GROUP BY start)"""


def _minhash_cte():
    mins = ", ".join(
        f"min((h * {a} + {b}) % {dedup.HASH_PRIME}) AS m{i}"
        for i, (a, b) in ((i, dedup.affine(i)) for i in range(BANDS * ROWS)))
    keys = ", ".join(
        "'" + str(k) + "-' || " + " || '-' || ".join(f"m{k * ROWS + r}" for r in range(ROWS)) for k in range(BANDS))
    return f"""{SHINGLES},
  sig AS MATERIALIZED (SELECT doc_id, {mins} FROM (SELECT doc_id, unnest(hs) AS h FROM sh) GROUP BY doc_id),
  mem AS MATERIALIZED (SELECT doc_id, unnest([{keys}]) AS bucket FROM sig),
  cand AS MATERIALIZED (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM mem a JOIN mem b USING (bucket) WHERE a.doc_id < b.doc_id),
  jac AS MATERIALIZED (SELECT a, b, round(c / (la + lb - c), 6) AS jaccard FROM (
      SELECT a, b, len(list_intersect(x.hs, y.hs)) AS c, len(x.hs) AS la, len(y.hs) AS lb
      FROM cand JOIN sh x ON x.doc_id = a JOIN sh y ON y.doc_id = b)),
  {_reach("SELECT a, b FROM jac WHERE jaccard >= 0.7")}"""


@query("c7_minhash_pairs", f"""WITH RECURSIVE {_minhash_cte()}
SELECT cluster_id AS leader, c.doc_id AS member, round(k / (len(x.hs) + len(y.hs) - k), 6) AS jaccard FROM comp c JOIN sh x ON x.doc_id = cluster_id
  JOIN sh y ON y.doc_id = c.doc_id, LATERAL (SELECT len(list_intersect(x.hs, y.hs)) AS k) WHERE cluster_id < c.doc_id""")
def minhash_pairs(spark, sf):
    return dedup.minhash_pairs(documents(spark, sf), 3, BANDS, ROWS, 0.7)


def _simhash_cte():
    votes = ", ".join(f"sum(((h{i // 32} >> {i % 32}) & 1) * 2 - 1) AS v{i}" for i in range(64))
    hi, lo = (" + ".join(f"(CASE WHEN v{o + i} > 0 THEN {1 << i} ELSE 0 END)" for i in range(32)) for o in (0, 32))
    return f"""
  tok AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::BIGINT AS h0, ('0x' || substr(md5(w), 9, 8))::BIGINT AS h1
          FROM (SELECT doc_id, unnest({S.words()}) AS w FROM documents)),
  sim AS MATERIALIZED (SELECT doc_id, CAST({hi} AS BIGINT) AS hi, CAST({lo} AS BIGINT) AS lo
          FROM (SELECT doc_id, {votes} FROM tok GROUP BY 1))"""


def _simhash_keys():
    parts = [f"(({half} >> {start}) & {(1 << width) - 1})" for half, start, width in dedup.SIM_BLOCKS]
    return ", ".join("'" + "".join(map(str, c)) + "-' || " + " || '-' || ".join(parts[i] for i in c)
                     for c in combinations(range(len(parts)), 3))


@query("c8_simhash_pairs", f"""
WITH RECURSIVE {_simhash_cte()},
  dist AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM sim x JOIN sim y ON x.doc_id < y.doc_id
        WHERE bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) <= 3),
  {_reach("SELECT a, b FROM dist")}
SELECT cluster_id AS leader, c.doc_id AS member, CAST(bit_count(xor(x.hi, y.hi)) + bit_count(xor(x.lo, y.lo)) AS INTEGER) AS distance
FROM comp c JOIN sim x ON x.doc_id = cluster_id JOIN sim y ON y.doc_id = c.doc_id WHERE cluster_id < c.doc_id""")
def simhash_pairs(spark, sf):
    return dedup.simhash_pairs(documents(spark, sf))


@query("c9_dedup_clusters", f"""
WITH RECURSIVE {_minhash_cte()}
SELECT d.doc_id, coalesce(c.cluster_id, d.doc_id) AS cluster_id, coalesce(c.cluster_id, d.doc_id) = d.doc_id AS is_representative
FROM documents d LEFT JOIN comp c USING (doc_id)""")
def dedup_clusters(spark, sf):
    docs = documents(spark, sf)
    return dedup.dedup_clusters(dedup.minhash_pairs(docs, 3, BANDS, ROWS, 0.7), docs.select("doc_id"))


@query("c10_length_bounds", "SELECT doc_id, n_chars FROM documents WHERE length(text) BETWEEN 200 AND 5000")
def length_bounds(spark, sf):
    return clean.length_bounds(documents(spark, sf), 200, 5000).select("doc_id", "n_chars")


@query("c11_symbol_ratio", f"""
SELECT doc_id, round(r, 6) AS symbol_ratio FROM (SELECT doc_id, CASE WHEN len({S.words()}) > 0
  THEN {S.matches(clean.SYMBOL)} / len({S.words()}) ELSE 0.0 END AS r FROM documents) WHERE r <= 0.5""")
def symbol_ratio(spark, sf):
    return clean.symbol_gate(documents(spark, sf)).select("doc_id", half_up(F.col("symbol_ratio")).alias("symbol_ratio"))


@query("c12_repetition", f"""
WITH d AS (SELECT doc_id, {S.grams('w', 3)} AS g, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls
           FROM (SELECT *, {S.words()} AS w FROM documents)),
     t AS (SELECT doc_id, max(c) AS top FROM (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(g) AS x FROM d) GROUP BY 1, 2) GROUP BY 1)
SELECT doc_id,
  round(CASE WHEN len(ls) > 0 THEN (len(ls) - len(list_distinct(ls))) / len(ls) ELSE 0.0 END, 6) AS dup_line_ratio,
  round(CASE WHEN len(g) > 0 THEN (len(g) - len(list_distinct(g))) / len(g) ELSE 0.0 END, 6) AS dup_ngram_ratio,
  round(CASE WHEN len(g) > 0 THEN top / len(g) ELSE 0.0 END, 6) AS top_ngram_ratio
FROM d LEFT JOIN t USING (doc_id)""")
def repetition(spark, sf):
    found = clean.repetition(documents(spark, sf))
    return found.select("doc_id", *[half_up(F.col(c)).alias(c) for c in ("dup_line_ratio", "dup_ngram_ratio", "top_ngram_ratio")])


@query("c13_blocklist_score", f"""
SELECT doc_id, n AS n_blocked, round(CASE WHEN len(w) > 0 THEN n / len(w) ELSE 0.0 END, 6) AS blocked_ratio FROM (
  SELECT doc_id, w, len(list_filter(w, lambda x: list_contains({list(TERMS)}, x))) AS n
  FROM (SELECT doc_id, {S.words()} AS w FROM documents))""")
def blocklist_score(spark, sf):
    return clean.blocklist_score(documents(spark, sf), TERMS).select(
        "doc_id", F.col("n_blocked").cast("bigint").alias("n_blocked"), half_up(F.col("blocked_ratio")).alias("blocked_ratio"))


@query("c13_train_quality")
def train_quality(spark, sf):
    return clean.train_quality(documents(spark, sf), table(spark, sf, "labels")).select("doc_id", "score")


@query("c13_bayes_quality", f"""
WITH w AS MATERIALIZED (SELECT doc_id, unnest({S.words()}) AS term FROM documents),
  known AS MATERIALIZED (SELECT d.doc_id, l.quality AS y FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IN (0, 1)),
  c AS MATERIALIZED (SELECT term, count(*) FILTER (y = 1) AS good, count(*) FILTER (y = 0) AS bad FROM w JOIN known USING (doc_id) GROUP BY 1),
  t AS (SELECT sum(good) AS good, sum(bad) AS bad, count(*) AS n FROM c),
  p AS (SELECT ln((count(*) FILTER (y = 1) + 1) / (count(*) FILTER (y = 0) + 1)) AS prior FROM known),
  o AS MATERIALIZED (SELECT term, ln((c.good + 1) / (c.bad + 1) * ((t.bad + t.n) / (t.good + t.n))) AS odds FROM c, t),
  s AS (SELECT doc_id, sum(odds) AS s, count(*) AS n FROM w LEFT JOIN o USING (term) GROUP BY 1)
SELECT d.doc_id, round(coalesce((prior + coalesce(s, 0.0)) / n, prior), 6) AS log_odds FROM documents d LEFT JOIN s USING (doc_id), p""")
def bayes_quality(spark, sf):
    docs = documents(spark, sf)
    odds, prior = clean.word_odds(docs, table(spark, sf, "labels"))
    return clean.bayes_quality(docs.select("doc_id", "text"), odds, prior).select("doc_id", F.round("log_odds", 6).alias("log_odds"))


@query("c14_provenance", """
SELECT doc_id, source, 'corpus/' || source AS original_path, doc_id % 7 <> 0 AS sanitized,
       sha1('corpus/' || source || chr(1) || doc_id) AS doc_key FROM documents""")
def provenance(spark, sf):
    docs = clean.with_provenance(documents(spark, sf), F.concat(F.lit("corpus/"), F.col("source")), F.col("doc_id") % 7 != 0)
    return docs.select("doc_id", "source", "original_path", "sanitized", "doc_key")


@query("c15_quarantine", "SELECT doc_id, n_chars FROM documents WHERE doc_id % 7 = 0")
def quarantine(spark, sf):
    path = scratch(spark, "quarantine")
    clean.quarantine(documents(spark, sf).withColumn("sanitized", F.col("doc_id") % 7 != 0), path)
    return spark.read.parquet(path).filter(~F.col("sanitized")).select("doc_id", "n_chars")


@query("c16_funnel", f"""
WITH d AS (SELECT source, length(text) AS c, len({S.words()}) AS t, length(text) >= 50 AS a, length(text) <= 5000 AS b,
             {S.matches(clean.SYMBOL)} <= 0.5 * len({S.words()}) AS s FROM documents),
     f AS (SELECT source, c, t, unnest(['0_input', '1_long_enough', '2_not_too_long', '3_few_symbols']) AS stage,
             unnest([true, a, a AND b, a AND b AND s]) AS alive FROM d)
SELECT source, stage, count(*) FILTER (alive) AS n_docs, CAST(coalesce(sum(c) FILTER (alive), 0) AS BIGINT) AS n_chars,
       CAST(coalesce(sum(t) FILTER (alive), 0) AS BIGINT) AS n_tokens
FROM f GROUP BY GROUPING SETS ((stage), (source, stage))""")
def funnel(spark, sf):
    text = F.col("text")
    symbols = F.regexp_count(text, F.lit(clean.SYMBOL))
    stages = [("long_enough", F.length(text) >= 50), ("not_too_long", F.length(text) <= 5000),
              ("few_symbols", symbols <= F.lit(0.5) * F.regexp_count(F.lower(text), F.lit(S.WORD)))]
    return clean.funnel(documents(spark, sf), stages)


OLD_SQL = """(SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN text || ' edited' ELSE text END AS text FROM documents WHERE doc_id % 10 <> 1
  UNION ALL SELECT doc_id + 10000000, text FROM documents WHERE doc_id % 10 = 2)"""


def old_documents(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    edited = docs.filter(F.col("doc_id") % 10 != 1).withColumn(
        "text", F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" edited"))).otherwise(F.col("text")))
    return edited.unionByName(docs.filter(F.col("doc_id") % 10 == 2).withColumn("doc_id", F.col("doc_id") + 10_000_000))


@query("c17_delta", f"""
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.s, b.s) AS content_sha,
       CASE WHEN b.s IS NULL THEN 'new' WHEN a.s IS NULL THEN 'deleted' ELSE 'changed' END AS change
FROM (SELECT doc_id, {SHA} AS s FROM documents) a FULL JOIN (SELECT doc_id, {SHA} AS s FROM {OLD_SQL}) b USING (doc_id)
WHERE a.s IS DISTINCT FROM b.s""")
def delta(spark, sf):
    return dedup.delta(documents(spark, sf), old_documents(spark, sf))


@query("c18_decontaminate", f"""
WITH b AS (SELECT DISTINCT unnest({S.grams('w', 8)}) AS g FROM (SELECT {S.words()} AS w FROM benchmark)),
     d AS (SELECT doc_id, unnest(list_distinct({S.grams('w', 8)})) AS g FROM (SELECT doc_id, {S.words()} AS w FROM documents))
SELECT o.doc_id, coalesce(n, 0) AS n_grams, coalesce(s, 0) AS n_shared, coalesce(s, 0) > 0 AS contaminated FROM documents o
LEFT JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (g IN (SELECT g FROM b)) AS s FROM d GROUP BY 1) USING (doc_id)""")
def decontaminate(spark, sf):
    return dedup.decontaminate(documents(spark, sf), table(spark, sf, "benchmark")).select(
        "doc_id", "n_grams", "n_shared", "contaminated")


@query("c19_date_contamination", """
SELECT l_suppkey AS model_id, count(*) AS n_scores, count(*) FILTER (released <= cutoff) AS n_contaminated
FROM lineitem JOIN (SELECT p_partkey, date '2023-01-01' + CAST(p_size * 20 AS INTEGER) AS released FROM part) ON p_partkey = l_partkey
JOIN (SELECT s_suppkey, date '2023-06-01' + CAST(s_nationkey * 20 AS INTEGER) AS cutoff FROM supplier) ON s_suppkey = l_suppkey
GROUP BY 1""")
def date_contamination(spark, sf):
    scores = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("bench_id"), F.col("l_suppkey").alias("model_id"))
    bench = table(spark, sf, "part").select(F.col("p_partkey").alias("bench_id"),
                                            F.date_add(F.lit("2023-01-01").cast("date"), F.col("p_size") * 20).alias("released"))
    models = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("model_id"), F.date_add(F.lit("2023-06-01").cast("date"), F.col("s_nationkey") * 20).alias("cutoff"))
    return dedup.date_contamination(scores, bench, models).groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_scores"), F.count_if("contaminated").alias("n_contaminated"))
