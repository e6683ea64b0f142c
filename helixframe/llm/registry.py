"""Queries of the training-data operators and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import laesa, license_scan, media_tiff, mixing, ngram_join, nn_descent, packing, pitman_yor, quality_crf, repeats, simhash, token_files, whitening
from .storage import documents


def op1_media_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_tiff.payload_digests(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(documents(spark, sf_dir))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed_bytes(documents(spark, sf_dir))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scores(documents(spark, sf_dir))


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_crf.scores(docs, model)
    return scored.select("doc_id", F.coalesce(quality_crf.fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality_crf.THRESHOLD).cast("int").alias("predicted"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.labels(license_scan.scan(documents(spark, sf_dir)))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_token_counts(documents(spark, sf_dir))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_laesa_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laesa.coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_media_tiff, op2_packing, op3_ngram_join, op4_suffix_dedup, op5_pitman_yor, op6_quality_crf, op7_license_scan, op8_token_counts, op9_nn_descent, op10_mixing,
        op11_laesa_codes, op12_simhash, op13_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op7_license_scan": license_scan.oracle_sql(),
    "op8_token_counts": r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents",
    "op11_laesa_codes": laesa.oracle_sql(),
}
