"""Queries over streams: each runs a stream to the end of its input and returns what it wrote."""

from pyspark.sql import functions as F

from tamra.plans import sqltext as S
from tamra.plans.cleaning import OLD_SQL, SHA, old_documents
from tamra.plans.personal import _LAST, _REDACTED, personal_documents
from tamra.plans.registry import query, table
from tamra.schemas import TABLE_DOC
from tamra.session import scratch
from tamra.operators import clean
from tamra.streaming import streams


EVENTS_A_TASK = 250_000


def run(spark, stream, mode="append", settings=None):
    out = scratch(spark, "stream-out")
    streams.run_available(stream, out, scratch(spark, "stream-state"), mode, settings)
    return spark.read.schema(stream.schema).parquet(out)


def as_files(df, spark, label, files=4):
    """The table as ``files`` files or one per scan task, whichever is more, so that none grows with the table."""
    folder = scratch(spark, label)
    df.repartition(max(files, df.rdd.getNumPartitions())).write.parquet(folder)
    return folder


@query("w1_stream_corpus", "SELECT doc_id, source, n_chars FROM documents")
def stream_corpus(spark, sf):
    folder = as_files(table(spark, sf, "documents"), spark, "corpus-files")
    return run(spark, streams.stream_corpus(spark, folder, TABLE_DOC, 1).select("doc_id", "source", "n_chars"))


@query("w2_resume", "SELECT doc_id, source FROM documents")
def resume(spark, sf):
    docs = table(spark, sf, "documents")
    folder, out, state = (scratch(spark, x) for x in ("resume-in", "resume-out", "resume-state"))
    for part in (docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")):
        part.write.mode("append").parquet(folder)
        stream = streams.stream_corpus(spark, folder, TABLE_DOC, 2).select("doc_id", "source")
        streams.run_available(stream, out, state)
    return spark.read.parquet(out)


@query("w3_stream_redact", f"""WITH {_REDACTED} SELECT doc_id, {_LAST}.text FROM {_LAST} JOIN pdocs p USING (doc_id)
WHERE length(p.text) BETWEEN 100 AND 20000 AND {S.matches(clean.SYMBOL, 'p.text')} <= 0.5 * len({S.words('p.text')})""")
def stream_redact(spark, sf):
    docs = personal_documents(spark, sf).select("doc_id", "text")
    stream = spark.readStream.schema(docs.schema).parquet(as_files(docs, spark, "redact-in"))
    return run(spark, streams.clean_and_redact(stream, 100, 20000, 0.5))


@query("w4_stream_dedup", f"SELECT DISTINCT {SHA} AS content_sha FROM documents")
def stream_dedup(spark, sf):
    folder = as_files(table(spark, sf, "documents"), spark, "dedup-in")
    return run(spark, streams.stream_dedup(streams.stream_corpus(spark, folder, TABLE_DOC, 2)).select("content_sha"))


def events_of(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", (F.col("event_type") == "error").alias("is_error"),
        (F.col("value") * 0.001).alias("cost"), F.col("value").alias("latency_ms"))


def event_tasks(spark, sf):
    """Tasks of about ``EVENTS_A_TASK`` events each."""
    return -(-events_of(spark, sf).count() // EVENTS_A_TASK) or 1


def event_stream(spark, sf):
    events = events_of(spark, sf).drop("event_id")
    return spark.readStream.schema(events.schema).parquet(as_files(events, spark, "events-in", event_tasks(spark, sf)))


def session_settings(spark, sf):
    """For a stream whose one batch holds a session of nearly every event: no task and no memory grows with the table.

    The state of all sessions lies on disk, in partitions that grow in number; a scan task takes a file or two.
    """
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), event_tasks(spark, sf))
    return {**streams.STATE_ON_DISK, "spark.sql.shuffle.partitions": str(tasks), "spark.sql.files.maxPartitionBytes": "8m"}


def two_runs(spark, sf, build):
    """The output of a stream over two runs: events up to the middle, then the later ones with earlier ones again."""
    events = events_of(spark, sf)
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = F.lit(ends["a"] + (ends["b"] - ends["a"]) / 2)
    folder, out, state = (scratch(spark, x) for x in ("late-in", "late-out", "late-state"))
    for part in (events.filter(F.col("ts") <= middle), events):  # the second holds all of the first once more
        part.write.mode("append").parquet(folder)
        stream = build(spark.readStream.schema(events.schema).parquet(folder))
        streams.run_available(stream, out, state)
    return spark.read.schema(stream.schema).parquet(out)


@query("w4_dedup_watermark", "SELECT event_id, ts, user_id FROM events")
def dedup_watermark(spark, sf):
    found = two_runs(spark, sf, lambda events: streams.stream_dedup(events, "ts", "1 hour", ["event_id"]))
    return found.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id")


def _windows_sql(slide):
    starts = "unnest([time_bucket(INTERVAL 1 HOUR, ts)])" if slide is None else (
        "unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE])")
    return f"""SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS n, round(avg((event_type = 'error')::INT), 6) AS error_share,
  round(sum(value * 0.001::DOUBLE), 6) AS cost, round(avg(value), 6) AS latency_ms FROM (SELECT *, {starts} AS s FROM events)
  WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1, 2"""


def _monitor(slide):
    def go(spark, sf):
        found = run(spark, streams.monitor(event_stream(spark, sf), "1 hour", slide, "10 minutes"))
        plain = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
        return found.select(*plain, "n", *[F.round(c, 6).alias(c) for c in ("error_share", "cost", "latency_ms")])
    return go


query("w5_monitor", _windows_sql(None))(_monitor(None))
query("w5_monitor_sliding", _windows_sql("30 minutes"))(_monitor("30 minutes"))


@query("w5_monitor_late", f"""WITH e AS MATERIALIZED (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS middle FROM events),
  m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events, e WHERE ts <= middle),
  r AS (SELECT ts, event_type, value, time_bucket(INTERVAL 1 HOUR, ts) AS s FROM events),
  twice AS (SELECT * FROM r UNION ALL SELECT r.* FROM r, e, m WHERE ts <= middle AND s + INTERVAL 1 HOUR > mark)
SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS n, round(avg((event_type = 'error')::INT), 6) AS error_share,
  round(sum(value * 0.001::DOUBLE), 6) AS cost, round(avg(value), 6) AS latency_ms FROM twice
WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) GROUP BY 1, 2""")
def monitor_late(spark, sf):
    found = two_runs(spark, sf, lambda events: streams.monitor(events, "1 hour", None, "10 minutes"))
    plain = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return found.select(*plain, "n", *[F.round(c, 6).alias(c) for c in ("error_share", "cost", "latency_ms")])


@query("w5_sessions", """
WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opened FROM events),
     g AS (SELECT *, sum(opened) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM m)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM g GROUP BY user_id, session
HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def sessions(spark, sf):
    found = run(spark, streams.sessions(event_stream(spark, sf)), settings=session_settings(spark, sf))
    return found.select("user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")], "n")


@query("w6_stream_upsert", f"""
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.s, b.s) AS content_sha, CASE WHEN a.s IS NULL OR a.s = b.s THEN 1 ELSE 3 END AS version
FROM (SELECT doc_id, {SHA} AS s FROM documents) a FULL JOIN (SELECT doc_id, {SHA} AS s FROM {OLD_SQL}) b USING (doc_id)""")
def stream_upsert(spark, sf):
    folder, target, state = (scratch(spark, x) for x in ("upsert-in", "upsert-table", "upsert-state"))
    old, new = old_documents(spark, sf), table(spark, sf, "documents").select("doc_id", "text")
    late = new.withColumn("text", F.concat(F.lit("late "), "text"))  # an older version that comes after a newer one
    for docs in (old.withColumn("version", F.lit(1)), new.withColumn("version", F.lit(3)).unionByName(late.withColumn("version", F.lit(2))),
                 late.withColumn("version", F.lit(2))):
        docs.write.mode("append").parquet(folder)
        stream = spark.readStream.schema("doc_id bigint, text string, version int").parquet(folder)
        streams.upsert_stream(stream, target, state)
    return streams.current(spark.read.parquet(target)).select("doc_id", "content_sha", "version")
