"""Queries over personal data.

The tables hold no Thai ids and no Thai phone numbers, so every document gets a line with both,
glued to Thai letters and one in Thai digits, and with a secret, a card and a name; the check digit
of the id is right for even document ids only. DuckDB reads the border ``\\b`` as one of ASCII
letters and knows no Thai digits, so its text has them translated (the texts hold no others).
"""

from pyspark.sql import functions as F

from tamra.functions.personal import KINDS, PATTERNS, THAI_DIGITS
from tamra.functions.text import half_up
from tamra.operators import pii
from tamra.plans import sqltext as S
from tamra.plans.registry import query, table

ID12_SQL = "lpad(CAST(100000000000 + doc_id * 7919 AS VARCHAR), 12, '0')"
CHECK_SQL = "((11 - (" + " + ".join(f"CAST(substr(d, {i}, 1) AS INTEGER) * {14 - i}" for i in range(1, 13)) + ") % 11) % 10 + doc_id % 2) % 10"
THAI_PHONE_SQL = "translate('08' || lpad(CAST(doc_id AS VARCHAR), 8, '0'), '0123456789', '๐๑๒๓๔๕๖๗๘๙')"
DOCS_SQL = f"""pdocs AS MATERIALIZED (SELECT doc_id, source, n_base, translate(text, '๐๑๒๓๔๕๖๗๘๙', '0123456789') AS text
  FROM (SELECT doc_id, source, length(text) AS n_base, text || chr(10) || 'ID ' || d || CAST({CHECK_SQL} AS VARCHAR)
   || ' tel 08' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || ' from ' || (doc_id % 300) || '.1.2.3'
   || chr(10) || 'เลข' || d || CAST({CHECK_SQL} AS VARCHAR) || 'ครับโทร' || {THAI_PHONE_SQL} || 'นะไอพี10.1.2.' || (doc_id % 300)
   || 'ครับ API_KEY=abcd' || doc_id || 'efghij card 3782-822463-10005 by Dr. Somchai.' AS text
  FROM (SELECT *, {ID12_SQL} AS d FROM documents)))"""


def personal_documents(spark, sf):
    docs = table(spark, sf, "documents")
    d = F.lpad((F.lit(100000000000) + F.col("doc_id") * 7919).cast("string"), 12, "0")
    total = F.lit(0)
    for i in range(1, 13):
        total = total + F.substring(d, i, 1).cast("int") * (14 - i)
    check = ((F.lit(11) - total % 11) % 10 + F.col("doc_id") % 2) % 10
    tail = F.concat(F.lit("\nID "), d, check.cast("string"), F.lit(" tel 08"), F.lpad(F.col("doc_id").cast("string"), 8, "0"),
                    F.lit(" from "), (F.col("doc_id") % 300).cast("string"), F.lit(".1.2.3"))
    thai = F.translate(F.concat(F.lit("08"), F.lpad(F.col("doc_id").cast("string"), 8, "0")), "0123456789", THAI_DIGITS)
    tail = F.concat(tail, F.lit("\nเลข"), d, check.cast("string"), F.lit("ครับโทร"), thai, F.lit("นะไอพี10.1.2."), (F.col("doc_id") % 300).cast("string"),
                    F.lit("ครับ API_KEY=abcd"), F.col("doc_id").cast("string"), F.lit("efghij card 3782-822463-10005 by Dr. Somchai."))
    return docs.select("doc_id", "source", F.length("text").alias("n_base"), F.concat("text", tail).alias("text"))


_D = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(0, len({_D})), lambda i: CASE WHEN i % 2 = 0
  THEN CAST({_D}[len({_D}) - i] AS INTEGER) ELSE CAST({_D}[len({_D}) - i] AS INTEGER) * 2
  - CASE WHEN CAST({_D}[len({_D}) - i] AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
VALID_SQL = {
    "THAI_ID": f"len({_D}) = 13 AND (11 - list_sum(list_transform(range(1, 13), lambda i: CAST({_D}[i] AS INTEGER) * (14 - i))) % 11) % 10 = CAST({_D}[13] AS INTEGER)",
    "CARD": f"len({_D}) BETWEEN 13 AND 19 AND {_LUHN}",
    "IP": "len(list_filter(string_split(v, '.'), lambda p: CAST(p AS INTEGER) > 255)) = 0",
    "SECRET": "len(list_distinct(string_split(v, ''))) >= 8",
}


def valid_sql(kind):
    return VALID_SQL.get(kind, "true")


def _detect_sql(kind):
    return f"""WITH {DOCS_SQL} SELECT doc_id, '{kind}' AS pii_type, v AS value FROM (
      SELECT doc_id, unnest(regexp_extract_all(text, {S.quote(PATTERNS[kind])})) AS v FROM pdocs) WHERE {valid_sql(kind)}"""


def _detector(kind):
    def run(spark, sf):
        return pii.detect(personal_documents(spark, sf), kind)
    return run


for _name, _kind in (("r1_thai_id", "THAI_ID"), ("r2_phone", "PHONE"), ("r3_email", "EMAIL"), ("r4_card", "CARD"),
                     ("r5_ip", "IP"), ("r6_secret", "SECRET"), ("r7_honorific", "NAME")):
    query(_name, _detect_sql(_kind))(_detector(_kind))


@query("r5_url", f"""SELECT page_id AS doc_id, 'URL' AS pii_type, unnest(regexp_extract_all('see ' || url || ' or ' || html, {S.quote(PATTERNS["URL"])})) AS value FROM pages""")
def url(spark, sf):
    pages = table(spark, sf, "pages")
    text = F.concat(F.lit("see "), "url", F.lit(" or "), "html")
    return pii.detect(pages.select(F.col("page_id").alias("doc_id"), text.alias("text")), "URL")


SPANS_SQL = ", spans AS MATERIALIZED (" + " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS pii_type, v, CAST(s AS INTEGER) AS s, CAST(s + len(v) AS INTEGER) AS e FROM (
    SELECT doc_id, m[p] AS v, list_sum(list_transform(g[1:p], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:p - 1], lambda x: len(x))), 0) AS s
    FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS p FROM (SELECT doc_id, regexp_extract_all(text, {S.quote(PATTERNS[kind])}) AS m,
      string_split_regex(text, {S.quote(PATTERNS[kind])}) AS g FROM pdocs) WHERE len(m) > 0)) WHERE {valid_sql(kind)}""" for kind in KINDS) + ")"
HITS_SQL = f"""{DOCS_SQL}{SPANS_SQL},
  o AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e DESC, pii_type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
  i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s, e DESC, pii_type ROWS UNBOUNDED PRECEDING) AS island FROM o),
  hits AS MATERIALIZED (SELECT doc_id, arg_max(pii_type, (len(v), -s, pii_type)) AS pii_type, min(s) AS "start", max(e) AS "end",
     sha256('pepper' || arg_max(v, (len(v), -s, pii_type))) AS value_hash FROM i GROUP BY doc_id, island)"""


@query("r8_pii_hits", f"WITH {HITS_SQL} SELECT * FROM hits")
def pii_hits(spark, sf):
    return pii.pii_hits(personal_documents(spark, sf), salt="pepper")


HONORIFIC_SQL = r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof)\. ?|(?:นางสาว|นาย|นาง|คุณ) ?)(\p{L}[\p{L}\p{M}]+(?: (?:\p{Lu}|[ก-๏])[\p{L}\p{M}]+)?)"


@query("r7_names", f"""
WITH d AS (SELECT doc_id, 'Dr. ' || n_name || ' of ' || n_name || ' wrote. ' || text AS text FROM documents JOIN nation ON n_nationkey = doc_id % 25),
     t AS (SELECT doc_id, {S.tokens()} AS t FROM d)
SELECT doc_id, unnest(regexp_extract_all(text, {S.quote(HONORIFIC_SQL)}, 1)) AS name, 'honorific' AS how FROM d
UNION ALL
SELECT doc_id, p, 'gazetteer' FROM (SELECT doc_id, unnest(list_concat({S.grams('t', 1)}, {S.grams('t', 2)}, {S.grams('t', 3)})) AS p FROM t)
WHERE lower(p) IN (SELECT lower(n_name) FROM nation)""")
def names(spark, sf):
    nation = table(spark, sf, "nation")
    docs = table(spark, sf, "documents").withColumn("n_nationkey", F.col("doc_id") % 25).join(nation, "n_nationkey")
    led = docs.select("doc_id", F.concat(F.lit("Dr. "), "n_name", F.lit(" of "), "n_name", F.lit(" wrote. "), "text").alias("text"))
    return pii.detect_names(led, nation.select(F.col("n_name").alias("name")))


def _redacted_sql(mark):
    """The text with every valid value replaced, kind after kind."""
    steps = []
    previous = "pdocs"
    for i, kind in enumerate(KINDS):
        pattern = S.quote(PATTERNS[kind])
        steps.append(f"""x{i} AS MATERIALIZED (SELECT doc_id, source, CASE WHEN len(m) = 0 THEN text ELSE
          array_to_string(list_transform(range(1, len(g) + 1), lambda k: g[k] || coalesce(w[k], '')), '') END AS text FROM (
            SELECT *, list_transform(m, lambda v: CASE WHEN {valid_sql(kind)} THEN {mark(kind)} ELSE v END) AS w FROM (
              SELECT *, regexp_extract_all(text, {pattern}) AS m, string_split_regex(text, {pattern}) AS g FROM {previous})))""")
        previous = f"x{i}"
    return f"{DOCS_SQL}, " + ", ".join(steps), previous


_REDACTED, _LAST = _redacted_sql(lambda kind: f"'<{kind}>'")
_HASHED, _LAST_HASHED = _redacted_sql(lambda kind: f"'<{kind}:' || substr(sha256('pepper' || v), 1, 16) || '>'")


@query("r9_redact", f"WITH {_REDACTED} SELECT doc_id, text FROM {_LAST}")
def redact(spark, sf):
    return pii.redact(personal_documents(spark, sf)).select("doc_id", "text")


@query("r9_redact_hash", f"WITH {_HASHED} SELECT doc_id, text FROM {_LAST_HASHED}")
def redact_hash(spark, sf):
    return pii.redact(personal_documents(spark, sf), "hash", "pepper").select("doc_id", "text")


def _hits_with_source(spark, sf):
    docs = personal_documents(spark, sf)
    return pii.pii_hits(docs).join(docs.select("doc_id", "source"), "doc_id")


@query("r10_redaction_report", f"""WITH {HITS_SQL}
SELECT pii_type, source, count(*) AS n_hits, count(DISTINCT doc_id) AS n_docs FROM hits JOIN documents USING (doc_id) GROUP BY CUBE (pii_type, source)""")
def redaction_report(spark, sf):
    return pii.redaction_report(_hits_with_source(spark, sf))


@query("r10_redaction_pivot", f"""WITH {HITS_SQL}
SELECT source, {", ".join(f"count(*) FILTER (pii_type = '{k}') AS {k.lower()}" for k in KINDS)} FROM hits JOIN documents USING (doc_id) GROUP BY source""")
def redaction_pivot(spark, sf):
    return pii.redaction_pivot(_hits_with_source(spark, sf))


@query("r11_pii_score", f"""WITH {HITS_SQL},
 truth AS (SELECT doc_id, 'THAI_ID' AS pii_type, n_base + 4 AS ts, n_base + 17 AS te FROM pdocs
   UNION ALL SELECT doc_id, 'PHONE', n_base + 22, n_base + 32 FROM pdocs),
 a AS (SELECT pii_type, count(*) AS n_true, count(*) FILTER (EXISTS (SELECT 1 FROM hits h WHERE h.doc_id = t.doc_id AND h.pii_type = t.pii_type
        AND h."start" < te AND ts < h."end")) AS f FROM truth t GROUP BY 1),
 b AS (SELECT pii_type, count(*) AS n_hits, count(*) FILTER (EXISTS (SELECT 1 FROM truth t WHERE h.doc_id = t.doc_id AND h.pii_type = t.pii_type
        AND h."start" < te AND ts < h."end")) AS r FROM hits h GROUP BY 1)
SELECT pii_type, coalesce(n_true, 0) AS n_true, coalesce(n_hits, 0) AS n_hits, round(f / n_true, 6) AS recall, round(r / n_hits, 6) AS "precision",
  coalesce(f / n_true >= 0.95, false) AS ship FROM a FULL JOIN b USING (pii_type)""")
def pii_score(spark, sf):
    docs = personal_documents(spark, sf)
    truth = docs.select("doc_id", F.lit("THAI_ID").alias("pii_type"), (F.col("n_base") + 4).alias("start"), (F.col("n_base") + 17).alias("end")).unionByName(
        docs.select("doc_id", F.lit("PHONE").alias("pii_type"), (F.col("n_base") + 22).alias("start"), (F.col("n_base") + 32).alias("end")))
    scored = pii.pii_score(pii.pii_hits(docs), truth, 0.95)
    return scored.withColumn("recall", half_up(F.col("recall"))).withColumn("precision", half_up(F.col("precision")))


@query("r12_leak_check", f"WITH {_REDACTED} " + " UNION ALL ".join(
    f"""SELECT '{k}' AS pii_type, CAST(coalesce(sum(len(list_filter(regexp_extract_all(text, {S.quote(PATTERNS[k])}), lambda v: {valid_sql(k)}))), 0) AS BIGINT) AS n_leaks
    FROM {_LAST}""" for k in KINDS))
def leak_check(spark, sf):
    return pii.leak_check(pii.redact(personal_documents(spark, sf)))


@query("r13_memorised", f"""
WITH o AS (SELECT conv_id * 100 + turn AS out_id, unnest(list_distinct({S.grams('w', 5)})) AS g FROM (SELECT *, {S.words()} AS w FROM conversations)),
     c AS (SELECT DISTINCT unnest({S.grams('w', 5)}) AS g FROM (SELECT {S.words()} AS w FROM documents))
SELECT out_id, count(*) AS n_grams, count(*) FILTER (g IN (SELECT g FROM c)) AS n_repeated FROM o GROUP BY 1""")
def memorised(spark, sf):
    outputs = table(spark, sf, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("out_id"), "text")
    return pii.memorised(outputs, table(spark, sf, "documents"), 5)
