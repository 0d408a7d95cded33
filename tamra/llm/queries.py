"""One thin query for each operator, and the pipeline; none is registered with the rest of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tamra.llm import bpe, infill, jaccard, kdtree, minhash, mixing, negatives, packed, quality, sharding, spots, toxicity, urls
from tamra.llm.tables import table, tokenizer_path
from tamra.plans.registry import Query, QueryFn
from tamra.session import scratch

QUERIES: dict[str, Query] = {}

def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = Query(fn, sql)
        return fn
    return register


# The stated rules of the url filter: host, path, verdict.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))
SOURCE_WEIGHTS = [3.0, 1.0, 2.0]
SHARDS = 8

OP2_SQL = """
with u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from u),
q as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from p),
rules(rhost, rpath, rverdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit as (select page_id, rhost || rpath as rule, rverdict,
               row_number() over (partition by page_id order by length(rhost || rpath) desc, length(rhost) desc, rverdict) as n
        from q join rules on (host = rhost or host like '%.' || rhost) and starts_with(path, rpath))
select q.page_id, host, path, rule, coalesce(rverdict, 'allow') as verdict from q left join fit on q.page_id = fit.page_id and n = 1
"""


@query("op1_ngram_jaccard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles reach a Jaccard of 0.85."""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op2_url_filter", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the stated rules, by the sorted sweep."""
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@query("op3_packed_ids")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ids as packed blocks, read the files back, and place and digest each document."""
    out = scratch(spark, "token-ids")
    packed.write(table(spark, sf_dir, "documents"), out, tokenizer_path())
    return packed.documents(spark, out)


@query("op4_spotsigs")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, with their likeness and the next one's."""
    return spots.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op5_mix")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of each document."""
    return mixing.totals(mixing.mix(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)).drop("_row")


@query("op6_feistel_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of row counts at most one apart, by the permuted row number."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by the pair occurrence index, decoded again, as digests per document."""
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_line_crf_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by the chain of its lines."""
    return quality.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_noisy_or_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by the noisy-or of its sentences."""
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP10_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
           where embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
      from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s)
select query_id, cast(n as int) as rank, vec_id, score from r where n <= 5
"""


@query("op10_kd_topk", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector, exact."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP11_SQL = """
with t as (select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as d from documents),
u as (select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as units,
             [cast('0x' || substr(d, 8 * i + 1, 8) as bigint) for i in [0, 1, 2, 3]] as h from t),
c as (select *, len(units) as n, h[1] % (len(units) + 1) as x, h[2] % (len(units) + 1) as y,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 90 then 'plain'
                  when h[4] % 100 < 20 then 'spm' else 'psm' end as form from u),
p as (select *, array_to_string(units[1:least(x, y)], '') as prefix, array_to_string(units[least(x, y) + 1:greatest(x, y)], '') as middle,
             array_to_string(units[greatest(x, y) + 1:], '') as suffix from c)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256 from p
"""


@query("op11_fill_in_middle", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as prefix, suffix and middle, and the text that its output gives back."""
    made = infill.transform(table(spark, sf_dir, "documents"))
    back = infill.restored(F.col("form"), F.col("output"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


@query("op12_tensored_minhash")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 5-word shingles reach a Jaccard of 0.85, and which to keep."""
    return minhash.near_copies(table(spark, sf_dir, "documents"))


OP13_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
           where label is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_dot_product(a.e, c.e) as bigint) as score
      from v a join v c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id and len(a.e) = len(c.e)),
p as (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as n from s where same),
m as (select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
             row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as r
      from p join s on p.anchor_id = s.anchor_id and p.n <= 5 and not s.same
                    and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select anchor_id, positive_id, cast(r as int) as rank, negative_id, positive_score, negative_score from m where r <= 3
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives below each of the five nearest positives of every fiftieth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the pipeline on all documents."""
    return corpus_pipeline.run(spark, sf_dir)
