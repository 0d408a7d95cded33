"""Where the queries and the pipeline find their inputs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A vocabulary file in the folder TOKENIZER_DIR, else in that of the installed vocabularies."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)
