"""Writers: corpus, train/validation split, run manifest."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MAX_RECORDS = 1_000_000


def write_corpus(df: DataFrame, path: str, max_records: int = MAX_RECORDS) -> None:
    """Parquet with bounded files; refuses to overwrite."""
    df.write.option("maxRecordsPerFile", max_records).mode("errorifexists").parquet(path)


def write_splits(df: DataFrame, path: str, max_records: int = MAX_RECORDS) -> None:
    """Parquet partitioned by ``split``, so that reading one split prunes the other.

    A table without a ``split`` column is written as one unsplit set.
    """
    writer = df.write.option("maxRecordsPerFile", max_records).mode("errorifexists")
    (writer.partitionBy("split") if "split" in df.columns else writer).parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == split)


def write_manifest(df: DataFrame, path: str, stage: str, parameters: dict[str, object],
                   **measures: Column) -> None:
    """Append one summary row of a stage: row count, further measures, parameters."""
    fixed = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in sorted(parameters.items())]))
    counts = [F.count(F.lit(1)).alias("n_rows"), *[m.alias(k) for k, m in measures.items()]]
    df.agg(*counts).select(F.lit(stage).alias("stage"), "*", fixed.alias("parameters")).write.mode("append").parquet(path)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append scored runs to the run log, one folder per configuration."""
    runs.write.mode("append").partitionBy("config_id").parquet(path)


def write_tree(df: DataFrame, folder: str, column: str = "text", suffix: str = ".txt") -> None:
    """One file per row, a line with the text, in a folder per task.

    On a mounted folder each task makes its files itself: Spark's writer starts two processes a file
    there (for its rights and those of its checksum), and the driver moves all files one by one. A
    task that runs again writes the same names. Other stores get Spark's writer, whose tasks move their files.
    """
    place = urlsplit(folder)
    if place.scheme not in ("", "file"):
        df.select(column).write.options(**{"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}).text(folder)
        return
    root = place.path
    os.makedirs(root)

    def run(rows: Iterator[Row]) -> None:
        inside = f"{root}/{TaskContext.get().partitionId():05d}"
        os.makedirs(inside, exist_ok=True)
        for i, row in enumerate(rows):
            with open(f"{inside}/.{i}.{TaskContext.get().taskAttemptId()}", "wb") as file:
                file.write(bytes(row[0] or b"") + b"\n")
            os.replace(file.name, f"{inside}/{i}{suffix}")

    df.select(F.col(column).cast("binary")).foreachPartition(run)
