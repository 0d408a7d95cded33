"""Streams: corpus intake with exact resume, clean and redact, dedup, monitoring, upsert."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamra.functions.text import non_blank
from tamra.operators.clean import symbol_ratio
from tamra.operators.dedup import content_sha
from tamra.operators.pii import redact


def stream_corpus(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """Files of a folder as a stream; the consumer bounds how much is pulled."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


# State that lies in files of the executors, with one bound of memory for all stores of an executor.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
}


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", settings: Mapping[str, str] | None = None) -> None:
    """Process what is there, then stop. The checkpoint keeps the exact position for the next run.

    ``settings`` hold in the session until the stream ends: state is placed at the start, files are dealt in every batch.
    """
    conf, settings = stream.sparkSession.conf, settings or {}
    before = {name: conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            conf.set(name, value)
        query = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                 .outputMode(mode).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def clean_and_redact(stream: DataFrame, lo: int, hi: int, most_symbols: float, mode: str = "redact", salt: str = "") -> DataFrame:
    """Blank, length and symbol filters, then redaction: row by row, so batch and stream agree."""
    text = F.col("text")
    kept = stream.filter(non_blank(text) & F.length(text).between(lo, hi) & (symbol_ratio(text) <= most_symbols))
    return redact(kept, mode, salt)


def stream_dedup(stream: DataFrame, time: str | None = None, delay: str = "1 hour", keys: Sequence[str] = ("content_sha",)) -> DataFrame:
    """First row of each key. With an event time, state is kept for ``delay`` only; without, for ever."""
    keyed = stream.withColumn("content_sha", content_sha(F.col("text"))) if "text" in stream.columns else stream
    if time is None:
        return keyed.dropDuplicates(list(keys))
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def monitor(stream: DataFrame, length: str = "1 hour", slide: str | None = None, delay: str = "10 minutes",
            by: Sequence[str] = ()) -> DataFrame:
    """Rows, error share, cost and latency per time window; rows later than ``delay`` are dropped.

    Reads ``ts, is_error, cost, latency_ms``.
    """
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    grouped = stream.withWatermark("ts", delay).groupBy(window.alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("is_error").cast("double")).alias("error_share"),
        F.sum("cost").alias("cost"), F.avg("latency_ms").alias("latency_ms"))
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "error_share", "cost", "latency_ms")


def sessions(stream: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes", by: str = "user_id") -> DataFrame:
    """Sessions: rows of a key with no gap longer than ``gap``."""
    grouped = stream.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def upsert_batch(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: append the documents of a batch that are newer than what is stored, and changed.

    Of a document's rows in a batch the highest version counts, the greatest hash of two that tie. A
    newer version of unchanged text is noted without its payload, so a late row between two
    versions loses. Only key columns of the table are read. A batch writes to a folder of its own
    and overwrites it when it is tried again, so a retry leaves no second copy.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("content_sha", content_sha(F.col("text")))
        payload = [c for c in keyed.columns if c not in ("doc_id", "version", "content_sha")]
        best = F.max_by(F.struct(*(c for c in keyed.columns if c != "doc_id")), F.struct("version", "content_sha"))
        keyed = keyed.groupBy("doc_id").agg(best.alias("_r")).select("doc_id", "_r.*")
        known = newest(batch.sparkSession.read.schema("doc_id long, version int, content_sha string, batch int").parquet(path).filter(F.col("batch") < batch_id))
        keyed = keyed.join(known, "doc_id", "left").filter(F.col("_known").isNull() | (F.col("version") > F.col("_known.version")))
        changed = ~F.col("content_sha").eqNullSafe(F.col("_known.content_sha")) | F.col("_known").isNull()
        keyed = keyed.withColumn("changed", changed).select("doc_id", "version", "content_sha", "changed", *(F.when(F.col("changed"), F.col(c)).alias(c) for c in payload))
        keyed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def newest(stored: DataFrame) -> DataFrame:
    """``doc_id`` and ``_known``, the latest version noted of each document; reads key columns only."""
    return stored.groupBy("doc_id").agg(F.max(F.struct("version", "batch", "content_sha")).alias("_known"))


def current(stored: DataFrame) -> DataFrame:
    """The text of each document at its latest version, with the version that brought it."""
    columns = [c for c in stored.columns if c not in ("doc_id", "changed")]
    latest = F.max_by(F.struct(*columns), F.struct("version", "batch"))
    return stored.filter("changed").groupBy("doc_id").agg(latest.alias("_r")).select("doc_id", "_r.*")


def upsert_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Bring the table at ``path`` up to date with what the stream has; made empty if there is none."""
    spark = stream.sparkSession
    empty = spark.createDataFrame([], stream.schema).selectExpr("*", "cast(null as string) AS content_sha", "true AS changed")
    empty.write.mode("overwrite").parquet(f"{path}/batch=-1")
    query = (stream.writeStream.foreachBatch(upsert_batch(path)).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
