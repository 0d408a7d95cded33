"""A corpus from raw documents to token ids: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's rows and reads them again, so no stage is
run twice and a lost executor costs its tasks only. Rows with nulls pass: a null text counts as
empty in every stage, a null id is never a near copy. An empty table stays empty. The last
stages give a document as often as the mix takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tamra.llm import bpe, jaccard, mixing, quality, toxicity
from tamra.llm.order import stored
from tamra.llm.samples import labelled
from tamra.llm.tables import table, tokenizer_path

QUALITY_AT_LEAST = 0.5
TOXICITY_BELOW = 0.7
SOURCE_WEIGHTS = [3.0, 1.0, 2.0]

# SQL can state none of the fitted stages; the tests hold the stages against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are good on the whole."""
    model = quality.fit(labelled(docs, table(spark, sf_dir, "labels"), "quality"))
    return quality.keep(docs, model, QUALITY_AT_LEAST)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an offending sentence."""
    weights = toxicity.fit(labelled(docs, table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.keep(docs, weights, TOXICITY_BELOW)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: that of the smallest id, once."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once for every pass of the mix that takes half of it or more."""
    return mixing.repeated(docs, mixing.mix(docs, SOURCE_WEIGHTS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("mix", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
