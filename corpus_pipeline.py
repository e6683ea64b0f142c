"""A corpus from raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read again for the next.
All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import mixing, ngram_join, packing, quality_crf, repeats
from helixframe.llm.storage import documents, materialize, small_batches


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model accepts."""
    small_batches(spark)  # for the stages that follow as well
    return quality_crf.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.representatives(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 50 words or 400 bytes that stand elsewhere too; emptied documents stay as empty ones."""
    return repeats.without_repeats(docs, repeats.BYTES, repeats.PASSAGES)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights of their sources ask."""
    return mixing.mix(docs)


def power_of_two_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two lengths."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard),
    ("suffix-array dedup", suffix_dedup),
    ("mixing sources to target weights", mixing_sources),
    ("packing", power_of_two_packing),
]

#: No stage's decisions can be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
