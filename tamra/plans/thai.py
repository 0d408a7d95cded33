"""Queries over Thai text without blanks: tokens, vocabulary, chunks, weights and retrieval by dictionary words.

The documents spell the words of the given table in Thai letters with the blanks taken out; the
dictionary holds every word that makes up a 2,000th of all words or more, hence 2,000 words at most.
"""

from pyspark.sql import functions as F

from tamra.functions import thai
from tamra.functions.text import half_up, words
from tamra.operators import chunk, index, retrieve, tokens
from tamra.plans import sqltext as S
from tamra.plans.blocks import TOK_SQL, VOCAB, VOCAB_SQL, joined
from tamra.plans.registry import query, table
from tamra.plans.retrieval import BM25_SQL, CHUNKS_SQL, LATIN, OVERLAP, POST_SQL, SIZE, STEP, THAI
from tamra.session import cut

SHARE = 2000
_THAI_TEXT = f"translate(replace(lower(text), ' ', ''), '{LATIN}', '{THAI}')"
_BLOCK = thai.LETTERS + thai.DIGITS
_OTHER = "(?:" + "|".join(rf"[^\P{{{c}}}{_BLOCK}]" for c in "LMN") + ")+"
_TAIL = f"|[{thai.DIGITS}]+|{thai.CLUSTER}|{_OTHER}"
# One alternation, each word before those it begins with: what a prefix tree finds, spelled for another engine.
_DICT_SQL = f"""counted AS MATERIALIZED (SELECT translate(w, '{LATIN}', '{THAI}') AS w, count(*) AS c FROM (SELECT unnest({S.words()}) AS w FROM documents) GROUP BY 1),
  dict AS MATERIALIZED (SELECT w AS word FROM counted WHERE c * {SHARE} >= (SELECT sum(c) FROM counted) AND regexp_matches(w, '^[{thai.LETTERS}]+$')),
  pat AS MATERIALIZED (SELECT w, w || '|[^\\s\\p{{L}}\\p{{M}}\\p{{N}}]' AS p FROM (
    SELECT coalesce('(?:' || string_agg(word, '|' ORDER BY word DESC) || ')', '[^\\s\\S]') || {S.quote(_TAIL)} AS w FROM dict)),
  tdocs AS MATERIALIZED (SELECT doc_id, source, {_THAI_TEXT} AS text FROM documents),
  tbench AS MATERIALIZED (SELECT item_id, {_THAI_TEXT} AS text FROM benchmark),
  cutdocs AS MATERIALIZED (SELECT *, regexp_extract_all(text, p) AS tt FROM tdocs, pat),
  """
_CHUNK_WORDS = f"""SELECT chunk_id, list_filter(tt[chunk_no * {STEP} + 1:chunk_no * {STEP} + n_tokens], lambda x: regexp_matches(x, '^[\\p{{L}}\\p{{M}}\\p{{N}}]')) AS w
    FROM chunks JOIN cutdocs USING (doc_id)"""


def _thai_sql(sql):
    """The parts of a query of plain text, over the Thai tables, whose texts are cut once."""
    parts = ((f"SELECT chunk_id, {S.words()} AS w FROM chunks", _CHUNK_WORDS),
             (f"string_split(regexp_replace(text, {S.quote(S.TOKEN)}, chr(1), 'g'), chr(1))", f"string_split(regexp_replace(text, p, chr(1), 'g'), chr(1))"),
             (S.tokens(), "tt"), (S.quote(S.WORD), "w"), ("FROM documents", "FROM cutdocs"), ("FROM benchmark", "FROM tbench, pat"))
    for plain, cut_already in parts:
        sql = sql.replace(plain, cut_already)
    return _DICT_SQL + sql


def spelled(frame):
    return frame.withColumn("text", F.translate(F.replace(F.lower("text"), F.lit(" "), F.lit("")), LATIN, THAI))


def thai_docs(spark, sf):
    return spelled(table(spark, sf, "documents"))


def thai_rules(spark, sf):
    found = table(spark, sf, "documents").select(F.explode_outer(words(F.col("text"))).alias("w")).filter("w IS NOT NULL")
    counted = cut(found.groupBy(F.translate("w", LATIN, THAI).alias("word")).agg(F.count(F.lit(1)).alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0  # one number
    return thai.rules(counted.filter(F.col("n") * SHARE >= total))


def thai_chunks(spark, sf, rules):
    return chunk.chunk(thai_docs(spark, sf), SIZE, OVERLAP, rules=rules)


def dealt_chunks(spark, sf, rules):
    return index.dealt(thai_chunks(spark, sf, rules), rules, shas=False)


@query("t2_build_vocab_thai", f"WITH {_thai_sql(VOCAB_SQL)} SELECT * FROM vocab")
def build_vocab(spark, sf):
    return tokens.build_vocab(thai_docs(spark, sf), VOCAB, thai_rules(spark, sf))


@query("t1_tokenise_thai", f"WITH {_thai_sql(TOK_SQL)} SELECT doc_id, CAST(n_tokens AS INTEGER) AS n_tokens, array_to_string(ids, ' ') AS input_ids FROM tok")
def tokenise(spark, sf):
    docs, rules = thai_docs(spark, sf), thai_rules(spark, sf)
    return tokens.tokenise(docs, tokens.build_vocab(docs, VOCAB, rules), rules=rules).select("doc_id", "n_tokens", joined("input_ids"))


@query("k2_chunk_thai", f"""WITH {_thai_sql(CHUNKS_SQL)} SELECT chunk_id, doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, CAST(n_tokens AS INTEGER) AS n_tokens,
  CAST("start" AS INTEGER) AS "start", CAST("end" AS INTEGER) AS "end", text, source FROM chunks""")
def chunks(spark, sf):
    return thai_chunks(spark, sf, thai_rules(spark, sf))


@query("k5_chunk_sweep_thai", f"""
WITH {_thai_sql(f"n AS (SELECT len({S.tokens()}) AS n FROM documents)")}, s AS (SELECT unnest([64, 128, 256]) AS size),
  c AS (SELECT size, n, size - CAST(floor(size * 0.15) AS BIGINT) AS step FROM n, s),
  d AS (SELECT *, CAST(CASE WHEN n = 0 THEN 0 WHEN n <= size THEN 1 ELSE ceil((n - size) / step) + 1 END AS BIGINT) AS k FROM c)
SELECT size, count(*) AS n_docs, CAST(sum(k) AS BIGINT) AS n_chunks, max(k) AS max_chunks, CAST(sum(n + greatest(k - 1, 0) * (size - step)) AS BIGINT) AS n_tokens FROM d GROUP BY 1""")
def chunk_sweep(spark, sf):
    return chunk.chunk_sweep(thai_docs(spark, sf), [64, 128, 256], OVERLAP, thai_rules(spark, sf))


@query("x2_sparse_weights_thai", f"WITH {_thai_sql(POST_SQL)} SELECT chunk_id, term, round(w, 6) AS weight FROM wt")
def sparse_weights(spark, sf):
    rules = thai_rules(spark, sf)
    return index.sparse_weights(dealt_chunks(spark, sf, rules), rules).withColumn("weight", half_up(F.col("weight")))


@query("q3_bm25_thai", f"WITH {_thai_sql(BM25_SQL)} SELECT * FROM lex")
def bm25_topk(spark, sf):
    rules = thai_rules(spark, sf)
    asked = spelled(table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text"))
    chunks = dealt_chunks(spark, sf, rules)
    return retrieve.bm25_topk(asked, index.build_postings(chunks, rules), 20, rules=rules, chunks=chunks)
