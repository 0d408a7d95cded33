"""Queries over vocabulary, tokens, blocks and perplexity."""

from pyspark.sql import functions as F

from tamra.functions.text import half_up
from tamra.operators import clean, dedup, pii, shape, tokens
from tamra.plans import sqltext as S
from tamra.plans.registry import query, table

VOCAB, LENGTH = 4096, 128
VOCAB_SQL = f"""vocab AS MATERIALIZED (SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 3 AS INTEGER) AS token_id FROM (
  SELECT token, count(*) AS n FROM (SELECT unnest({S.tokens()}) AS token FROM documents) GROUP BY 1 ORDER BY n DESC, token LIMIT {VOCAB}))"""
TOK_SQL = f"""{VOCAB_SQL},
  tok AS MATERIALIZED (SELECT d.doc_id, d.source, len(t) + 1 AS n_tokens, list_append(coalesce(ids, []), 1) AS ids FROM (SELECT *, {S.tokens()} AS t FROM documents) d LEFT JOIN (
    SELECT doc_id, list(coalesce(token_id, 3) ORDER BY p) AS ids FROM (
      SELECT doc_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS p FROM (SELECT doc_id, {S.tokens()} AS t FROM documents)) LEFT JOIN vocab USING (token)
    GROUP BY 1) USING (doc_id))"""


def token_table(spark, sf):
    docs = table(spark, sf, "documents")
    return tokens.tokenise(docs, tokens.build_vocab(docs, VOCAB))


def joined(column):
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


@query("t1_tokenise", f"WITH {TOK_SQL} SELECT doc_id, CAST(n_tokens AS INTEGER) AS n_tokens, array_to_string(ids, ' ') AS input_ids FROM tok")
def tokenise(spark, sf):
    return token_table(spark, sf).select("doc_id", "n_tokens", joined("input_ids"))


@query("t1_byte_tokens", """
SELECT doc_id, CAST(length(hex(encode(text))) // 2 + 1 AS INTEGER) AS n_tokens,
  array_to_string(list_append(list_transform(range(0, length(hex(encode(text))) // 2), lambda i: CAST(('0x' || substr(hex(encode(text)), i * 2 + 1, 2)) AS INTEGER) + 4), 1), ' ') AS input_ids
FROM conversations SELECT_DOC""".replace("doc_id", "conv_id * 100 + turn AS doc_id").replace(" SELECT_DOC", ""))
def byte_tokens(spark, sf):
    turns = table(spark, sf, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("doc_id"), "text")
    return tokens.tokenise_bytes(turns).select("doc_id", "n_tokens", joined("input_ids"))


@query("t2_build_vocab", f"WITH {VOCAB_SQL} SELECT * FROM vocab")
def build_vocab(spark, sf):
    return tokens.build_vocab(table(spark, sf, "documents"), VOCAB)


BPE_ROUNDS = 6


def _bpe_sql():
    ctes = [f"""w0 AS MATERIALIZED (SELECT ' ' || array_to_string(string_split(w, ''), '  ') || ' ' AS s, count(*) AS n
             FROM (SELECT unnest({S.words()}) AS w FROM documents) GROUP BY w)"""]
    for r in range(BPE_ROUNDS):
        ctes.append(f"""t{r} AS MATERIALIZED (SELECT l, r, CAST(sum(n) AS BIGINT) AS n FROM (SELECT a[i] AS l, a[i + 1] AS r, n FROM (
            SELECT a, n, unnest(range(1, len(a))) AS i FROM (SELECT string_split(trim(s), '  ') AS a, n FROM w{r}))) GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1)""")
        ctes.append(f"""w{r + 1} AS MATERIALIZED (SELECT replace(s, ' ' || l || '  ' || r || ' ', ' ' || l || r || ' ') AS s, w{r}.n FROM w{r}, t{r})""")
    rows = " UNION ALL ".join(f"SELECT CAST({r + 1} AS INTEGER) AS merge_rank, l AS \"left\", r AS \"right\", n FROM t{r}" for r in range(BPE_ROUNDS))
    return f"WITH {', '.join(ctes)} {rows}"


@query("t3_learn_bpe", _bpe_sql())
def learn_bpe(spark, sf):
    return tokens.learn_bpe(table(spark, sf, "documents"), BPE_ROUNDS)


def _pack_sql(partition):
    """Tokens numbered in document order, grouped into whole blocks."""
    over = f"PARTITION BY {partition} ORDER BY doc_id, p" if partition else "ORDER BY doc_id, p"
    key = f"{partition} AS pack_key, " if partition else ""
    group = "pack_key, " if partition else ""
    return f"""flat AS (SELECT {key}id, row_number() OVER ({over}) - 1 AS spot FROM (
        SELECT doc_id, source, rn, unnest(ids) AS id, unnest(range(1, len(ids) + 1)) AS p FROM (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 1000 AS rn FROM tok))),
      blocks AS MATERIALIZED (SELECT {group}spot // {LENGTH} AS block_id, list(id ORDER BY spot) AS ids FROM flat GROUP BY ALL HAVING count(*) = {LENGTH})"""


def block_table(spark, sf):
    return tokens.pack(token_table(spark, sf), LENGTH)


@query("t4_pack", f"WITH {TOK_SQL}, {_pack_sql('')} SELECT block_id, array_to_string(ids, ' ') AS input_ids, array_to_string(ids, ' ') AS labels FROM blocks")
def pack(spark, sf):
    return block_table(spark, sf).select("block_id", joined("input_ids"), joined("labels"))


@query("t4_pack_by_source", f"WITH {TOK_SQL}, {_pack_sql('source')} SELECT pack_key, block_id, array_to_string(ids, ' ') AS input_ids FROM blocks")
def pack_by_source(spark, sf):
    return tokens.pack(token_table(spark, sf), LENGTH, "source").select("pack_key", "block_id", joined("input_ids"))


@query("t4_pack_batches", f"WITH {TOK_SQL}, {_pack_sql('rn')} SELECT pack_key, block_id, array_to_string(ids, ' ') AS input_ids FROM blocks")
def pack_batches(spark, sf):
    return tokens.pack_batches(token_table(spark, sf), LENGTH).select("pack_key", "block_id", joined("input_ids"))


@query("t5_next_token_pairs", f"""WITH {TOK_SQL}, {_pack_sql('')}
SELECT context, target, count(*) AS n FROM (SELECT ids[i] AS context, ids[i + 1] AS target FROM (SELECT ids, unnest(range(1, {LENGTH})) AS i FROM blocks)) GROUP BY 1, 2""")
def next_token_pairs(spark, sf):
    return tokens.next_token_pairs(block_table(spark, sf))


@query("t6_token_report", f"""WITH {TOK_SQL}, r AS (SELECT source, count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM tok GROUP BY ROLLUP (source))
SELECT source, n_docs, n_tokens, n_tokens // {LENGTH} AS n_blocks, n_tokens // {LENGTH} * {LENGTH} AS packed_tokens,
  CASE WHEN n_tokens // {LENGTH} * {LENGTH} < 1000 THEN printf('%.2f', n_tokens // {LENGTH} * {LENGTH} * 1.0::DOUBLE)
       WHEN n_tokens // {LENGTH} * {LENGTH} < 1000000 THEN printf('%.2fK', n_tokens // {LENGTH} * {LENGTH} / 1e3)
       ELSE printf('%.2fM', n_tokens // {LENGTH} * {LENGTH} / 1e6) END AS readable FROM r""")
def token_report(spark, sf):
    return tokens.token_report(token_table(spark, sf), LENGTH)


@query("t7_perplexity", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, round(avg(m), 6) AS mean_loss, round(exp(avg(m)), 6) AS perplexity FROM (
  SELECT (rn - 1) // 4 AS b, avg(loss) AS m, count(*) AS n FROM (SELECT value / 100 AS loss, row_number() OVER (ORDER BY event_id) AS rn FROM events) WHERE rn <= 256 GROUP BY 1)""")
def perplexity(spark, sf):
    losses = table(spark, sf, "events").select("event_id", (F.col("value") / 100).alias("loss"))
    return tokens.perplexity(losses, "event_id").select(
        "n_rows", half_up(F.col("mean_loss")).alias("mean_loss"), half_up(F.col("perplexity")).alias("perplexity"))


_VAL = "('0x' || substr(md5('42-' || doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.1"


@query("t8_ngram_perplexity", f"""
WITH b AS MATERIALIZED (SELECT doc_id, {_VAL} AS val, w[i] AS a, w[i + 1] AS b FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM (SELECT doc_id, {S.words()} AS w FROM documents))),
     ab AS (SELECT a, b, count(*) AS n_ab FROM b WHERE NOT val GROUP BY 1, 2), ca AS (SELECT a, sum(n_ab) AS n_a FROM ab GROUP BY 1),
     v AS (SELECT count(DISTINCT b) AS v FROM ab)
SELECT doc_id, count(*) AS n_pairs, round(exp(-avg(ln((coalesce(n_ab, 0) + 0.1::DOUBLE) / (coalesce(n_a, 0) + 0.1::DOUBLE * v)))), 4) AS perplexity
FROM b LEFT JOIN ab USING (a, b) LEFT JOIN ca USING (a), v WHERE val GROUP BY 1""")
def ngram_perplexity(spark, sf):
    docs = shape.split_by_hash(table(spark, sf, "documents"), 0.1, 42)
    scored = tokens.ngram_perplexity(docs.filter("split = 'train'"), docs.filter("split = 'validation'"))
    return scored.select("doc_id", "n_pairs", F.round("perplexity", 4).alias("perplexity"))


def corpus_to_blocks(spark, sf):
    """Filter, drop copies, redact, tokenise, pack, split and count: the whole way from text to blocks."""
    docs = table(spark, sf, "documents")
    clear = clean.min_length(shape.non_blank(docs), 50)
    unique = dedup.exact_dedup(clear)
    safe = pii.redact(unique, kinds=("EMAIL", "CARD"))
    ids = tokens.tokenise(safe, tokens.build_vocab(safe, VOCAB))
    blocks = shape.split(tokens.pack(ids, LENGTH, "source").withColumn(
        "block_key", F.concat_ws("-", "pack_key", F.col("block_id").cast("string"))), 0.02, 42, "block_key")
    return blocks.groupBy(F.col("pack_key").alias("source"), "split").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum(F.size("input_ids").cast("bigint")).alias("n_tokens"))


query("corpus_to_blocks")(corpus_to_blocks)
