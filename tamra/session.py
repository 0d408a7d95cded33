"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings for a session this package starts itself (tests, bench). A cluster
# session keeps its own values; shuffle partitions are then sized by the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, memory: str = "12g", **conf: str) -> SparkSession:
    """Start a single-JVM session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tamra")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only in a local session without the setting (tests) a temporary folder is made, once per
    session, and recorded in the session settings; a cluster must name its folder,
    since executors don't see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("tamra.scratch.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tamra-")
        spark.conf.set("tamra.scratch.dir", base)
    return base


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


BATCH_ROWS = 2_000  # texts of an Arrow batch, at most


def bounded(spark: SparkSession) -> None:
    """Let Arrow batches of texts be small from here on in this session, unless they are already: Spark bounds them by rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint, which outlives a lost executor."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
