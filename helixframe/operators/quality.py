"""Comparisons of sequence sets and figures of the performance studies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def consistent(small: Column, big: Column, gaps: str = "-") -> Column:
    """Whether small stands somewhere in big, each letter of `gaps` standing for any one; an empty small does if big isn't empty."""
    quoted = F.regexp_replace(small, r"([^A-Za-z0-9\-])", r"\\$1")
    pattern = F.regexp_replace(quoted, f"[{gaps}]", ".")
    return (F.length(big) > 0) & F.coalesce(F.regexp_like(big, F.concat(F.lit("(?s)"), pattern)), F.lit(False))


def fasta_diff(small: DataFrame, big: DataFrame) -> DataFrame:
    """protein_id, status: same, different or missing of each sequence in small against big; consistent and longer tell how differing ones relate."""
    pairs = small.select("protein_id", F.col("sequence").alias("s")).join(big.select("protein_id", F.col("sequence").alias("b")), "protein_id", "left")
    status = F.when(F.col("b").isNull(), "missing").when(F.col("s") == F.col("b"), "same").otherwise("different")
    return pairs.select("protein_id", status.alias("status"), consistent(F.col("s"), F.col("b")).alias("consistent"), (F.length("s") > F.length("b")).alias("longer"))


def fasta_diff_stats(diff: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("same", "different", "missing")]
    off = F.count_if(F.col("status") != "same")
    return diff.agg(*counts, (F.try_divide(off, F.countDistinct("protein_id")) * 100).alias("percent_off"))


def task_times(times: DataFrame) -> DataFrame:
    """task, total, n, mean of column seconds; a task without times has mean 0."""
    return times.groupBy("task").agg(F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total"), F.count("seconds").alias("n"), F.coalesce(F.avg("seconds"), F.lit(0.0)).alias("mean"))


def speedup(runs: DataFrame, base_cores: int) -> DataFrame:
    """cores, seconds (the first run's), speedup and efficiency against the run on base_cores. runs: cores, run_no, seconds."""
    first = runs.groupBy("cores").agg(F.min_by("seconds", "run_no").alias("seconds"))
    base = first.where(F.col("cores") == base_cores).select(F.col("seconds").alias("base"))
    ratio = F.try_divide(F.col("base"), F.col("seconds"))
    return first.crossJoin(F.broadcast(base)).select("cores", "seconds", ratio.alias("speedup"), (ratio * base_cores / F.col("cores")).alias("efficiency"))
