"""Queries over readers, writers and corpus shaping."""

from pyspark.sql import functions as F

from tamra.operators import shape
from tamra.plans.registry import query, table
from tamra.session import scratch
from tamra.sources import readers, sinks

ALLOWED = ("mit", "apache", "cc0", "cc-by-4.0", "public domain")


@query("s1_markdown_tree", """
SELECT text || chr(10) AS text, 'TOR-Law' AS source FROM documents WHERE regexp_matches(text, '\\S')""")
def markdown_tree(spark, sf):
    folder = scratch(spark, "tree")
    sinks.write_tree(table(spark, sf, "documents"), folder)
    return readers.read_markdown(spark, folder, "TOR-Law", pattern="*.txt").select("text", "source")


@query("s2_social_jsonl", """
SELECT CASE WHEN doc_id % 4 = 0 THEN 'Doc ' || doc_id || chr(10) || text
            WHEN doc_id % 4 = 1 THEN text
            WHEN doc_id % 4 = 2 THEN 'Doc ' || doc_id
            ELSE 'Doc ' || doc_id || chr(10) || text END AS text,
       'social' AS source
FROM documents""")
def social_jsonl(spark, sf):
    folder = scratch(spark, "social")
    kind = F.col("doc_id") % 4
    title = F.concat(F.lit("Doc "), F.col("doc_id").cast("string"))
    both = F.to_json(F.struct(title.alias("title"), F.col("text").alias("body_text")))
    body = F.to_json(F.struct(F.lit("").alias("title"), F.col("text")))
    empty = F.to_json(F.struct(title.alias("title"), F.lit("").alias("body_text"), F.col("text")))
    plain = F.to_json(F.struct(title.alias("title"), F.col("text")))
    line = F.when(kind == 0, both).when(kind == 1, body).when(kind == 2, empty).otherwise(plain)
    broken = F.concat(F.lit('{"title": '), F.col("doc_id").cast("string"))
    docs = table(spark, sf, "documents")
    docs.select(F.explode(F.array(line, F.lit(" "), broken)).alias("value")).write.text(folder)
    return readers.read_social_jsonl(spark, folder, pattern="*.txt")


@query("s3_news_jsonl", "SELECT text, 'nation_data' AS source FROM documents")
def news_jsonl(spark, sf):
    folder = scratch(spark, "news")
    table(spark, sf, "documents").write.json(folder)
    return readers.read_jsonl(spark, folder)


@query("s4_parquet_globs", """
SELECT lang, source, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ALL""")
def parquet_globs(spark, sf):
    docs = readers.read_parquet_globs(spark, [f"{sf}/documents.parquet", f"{sf}/doc*.parquet"])
    return docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("chars"))


@query("s5_mixed_parquet", """
SELECT text FROM documents WHERE regexp_matches(text, '\\S')
UNION ALL SELECT text FROM benchmark
UNION ALL SELECT html FROM pages""")
def mixed_parquet(spark, sf):
    folder = scratch(spark, "mixed")
    table(spark, sf, "documents").select(F.col("text").alias("txt"), "lang", F.lit("x").alias("content")).write.parquet(f"{folder}/a")
    table(spark, sf, "benchmark").select("item_id", "text").write.parquet(f"{folder}/b")
    table(spark, sf, "pages").select("url", F.col("html").alias("body")).write.parquet(f"{folder}/c")
    table(spark, sf, "part").select("p_name", F.col("p_size").alias("article")).write.parquet(f"{folder}/d")
    table(spark, sf, "region").write.parquet(f"{folder}/e")
    return readers.read_mixed_parquet(spark, folder)[0]


@query("s6_load_sources", """
SELECT source, source_ord, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM (
  SELECT 'docs' AS source, 0 AS source_ord, text FROM documents
  UNION ALL SELECT 'pages', 1, html FROM pages
  UNION ALL SELECT 'talk', 2, text FROM conversations) GROUP BY ALL""")
def load_sources(spark, sf):
    corpus = readers.load_sources(spark, [
        {"id": "docs", "path": f"{sf}/documents.parquet"},
        {"id": "pages", "path": f"{sf}/pages.parquet", "text_field": "html"},
        {"id": "talk", "path": f"{sf}/conversations.parquet"}], keep=())
    return corpus.groupBy("source", "source_ord").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text").cast("bigint")).alias("chars"))


@query("s7_corpus_sink", "SELECT doc_id, text, source FROM documents")
def corpus_sink(spark, sf):
    path = scratch(spark, "corpus")
    sinks.write_corpus(table(spark, sf, "documents").select("doc_id", "text", "source"), path)
    return spark.read.parquet(path)


SPLIT_SQL = """
SELECT {cols}, CASE WHEN rn <= ceil({frac} * n) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY md5('42-' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents)"""


@query("s8_split_sink", f"SELECT doc_id, source FROM ({SPLIT_SQL.format(cols='doc_id, source', frac=0.02)}) WHERE split = 'validation'")
def split_sink(spark, sf):
    path = scratch(spark, "splits")
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    sinks.write_splits(shape.split(docs, 0.02, 42), path)
    return sinks.read_split(spark, path, "validation").select("doc_id", "source")


@query("s9_run_manifest", """
SELECT 'documents' AS stage, count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS chars, '{"seed":42,"source":"all"}' AS parameters FROM documents
UNION ALL SELECT 'pages', count(*), CAST(sum(length(html)) AS BIGINT), '{"seed":42,"source":"web"}' FROM pages""")
def run_manifest(spark, sf):
    path = scratch(spark, "manifest")
    sinks.write_manifest(table(spark, sf, "documents"), path, "documents", {"seed": 42, "source": "all"},
                         chars=F.sum("n_chars"))
    sinks.write_manifest(table(spark, sf, "pages"), path, "pages", {"seed": 42, "source": "web"},
                         chars=F.sum(F.length("html").cast("bigint")))
    return spark.read.parquet(path)


@query("s9_run_log", """
SELECT event_type AS config_id, count(*) AS n_runs, round(sum(value), 4) AS latency FROM events GROUP BY 1""")
def run_log(spark, sf):
    path = scratch(spark, "runs")
    runs = table(spark, sf, "events").select(F.col("event_type").alias("config_id"), F.col("event_id").alias("item_id"),
                                             F.col("value").alias("latency_ms"))
    sinks.append_runs(runs, path)
    return spark.read.parquet(path).groupBy("config_id").agg(
        F.count(F.lit(1)).alias("n_runs"), F.round(F.sum("latency_ms"), 4).alias("latency"))


@query("s10_license_gate", """
SELECT doc_id, source, license_line FROM (
  SELECT doc_id, source, regexp_extract(text, '(?im)^([^\\n]*licen[cs]e[^\\n]*)', 1) AS license_line FROM documents)
WHERE license_line = '' OR """ + " OR ".join(f"regexp_matches(lower(license_line), '(^|[^a-z0-9]){a.lower()}($|[^a-z0-9])')" for a in ALLOWED))
def license_gate(spark, sf):
    return readers.license_gate(table(spark, sf, "documents"), ALLOWED).select("doc_id", "source", "license_line")


@query("p1_normalise", "SELECT html AS text, page_id FROM pages")
def normalise(spark, sf):
    return shape.normalise(table(spark, sf, "pages"), "html", keep=["page_id"])


@query("p2_non_blank", "SELECT doc_id, n_chars FROM documents WHERE regexp_matches(text, '\\S')")
def non_blank(spark, sf):
    return shape.non_blank(table(spark, sf, "documents")).select("doc_id", "n_chars")


def two_sources(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    return shape.concat([docs, pages])


TWO_SOURCES = """(SELECT doc_id, text, 0 AS source_ord FROM documents
  UNION ALL SELECT page_id, html, 1 FROM pages)"""


@query("p3_concat", f"SELECT source_ord, doc_id, length(text) AS n_chars FROM {TWO_SOURCES}")
def concat(spark, sf):
    return two_sources(spark, sf).select("source_ord", "doc_id", F.length("text").cast("bigint").alias("n_chars"))


@query("p4_source_tag", "SELECT page_id, 'web' AS source, length(html) AS n_chars FROM pages")
def source_tag(spark, sf):
    return shape.tag(table(spark, sf, "pages"), "web").select(
        "page_id", "source", F.length("html").cast("bigint").alias("n_chars"))


@query("p5_cap", f"SELECT source_ord, doc_id FROM {TWO_SOURCES} ORDER BY source_ord, doc_id LIMIT 1100")
def cap(spark, sf):
    return shape.cap(two_sources(spark, sf).select("source_ord", "doc_id"), 1100)


@query("p6_interleave", f"""
WITH r AS (SELECT source_ord, doc_id, row_number() OVER (PARTITION BY source_ord ORDER BY doc_id) - 1 AS r,
                  count(*) OVER (PARTITION BY source_ord) AS n FROM {TWO_SOURCES}),
     m AS (SELECT max(n) AS m, count(DISTINCT source_ord) AS k FROM r),
     p AS (SELECT unnest(range(0, m)) AS p, k FROM m)
SELECT r.source_ord, r.doc_id, CAST(p.p * p.k + r.source_ord AS BIGINT) AS pos FROM r JOIN p ON p.p % r.n = r.r""")
def interleave(spark, sf):
    return shape.interleave(two_sources(spark, sf).select("source_ord", "doc_id"))


@query("p7_shuffle", """
SELECT doc_id, row_number() OVER (ORDER BY md5('42-' || doc_id), doc_id) AS shuffle_pos FROM documents""")
def shuffle(spark, sf):
    return shape.shuffle(table(spark, sf, "documents").select("doc_id"), 42)


@query("p8_take_skip", """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= 200 THEN 'eval' ELSE 'train' END AS split FROM documents""")
def take_skip(spark, sf):
    return shape.take_skip(table(spark, sf, "documents").select("doc_id"), 200, "doc_id")


@query("p9_split", SPLIT_SQL.format(cols="doc_id", frac=0.02))
def split(spark, sf):
    return shape.split(table(spark, sf, "documents").select("doc_id"), 0.02, 42)


@query("p9_split_by_hash", """
SELECT doc_id, CASE WHEN ('0x' || substr(md5('42-' || doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.02
  THEN 'validation' ELSE 'train' END AS split FROM documents""")
def split_by_hash(spark, sf):
    return shape.split_by_hash(table(spark, sf, "documents").select("doc_id"), 0.02, 42)


@query("p10_head_sample", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 256")
def head_sample(spark, sf):
    return shape.head_sample(table(spark, sf, "documents").select("doc_id", "n_chars"), 256, "doc_id")
