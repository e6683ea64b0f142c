"""Ids that arrive over time: keyed state knows which have been seen, and each micro-batch builds the others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.index_log import IndexLog


def watch_ids(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """Ids of text files as they appear in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder).select(F.trim("value").alias("protein_id")).where("protein_id <> ''")


def first_seen(ids: DataFrame, known: DataFrame) -> DataFrame:
    """protein_id and held of a stream of ids: each id once, when it or a known one like it first comes; held tells which of the two was taken.

    known is a stream too, which begins with all that is known. Which ids have come is keyed state of Spark's own (no Python process is asked by key):
    a batch touches only its own keys, whatever the catalog's size. An id that comes in one batch with its known one is told as either.
    """
    both = ids.select("protein_id", F.lit(False).alias("held")).unionByName(known.select("protein_id", F.lit(True).alias("held")))
    return both.where("protein_id IS NOT NULL").dropDuplicates(["protein_id"])


def build_missing(ids: DataFrame, log: IndexLog, build: Callable[[DataFrame, int], DataFrame], checkpoint: str, name: str = "build") -> StreamingQuery:
    """Calls build(new ids, batch number) for ids that come for the first time and that the log lacks; what it returns (protein_id, path) is added to the log.

    The log may be empty. It is read whole once, when the checkpoint begins: its ids are written beside the checkpoint, and the first batch puts them
    into the state and leaves out its own ids that are among them. A batch is committed to the log under its
    own name: if it runs again after a failure or a restart, its ids are the same, and where its commit is there already nothing is built.
    An id that a build left out isn't asked for again by this stream.
    """
    spark, held = ids.sparkSession, f"{checkpoint}/held"
    if not log.exists(f"{checkpoint}/metadata"):
        log.latest().select("protein_id").distinct().write.mode("overwrite").parquet(held)
    known = spark.readStream.schema("protein_id string").parquet(held)  # all of its files are in the first batch

    def each(batch: DataFrame, number: int) -> None:
        run = f"{name}-{number}"
        if any(c.run == run for c in log.commits()):
            return
        new = batch.where("NOT held").select("protein_id")
        if number == 0:
            new = new.join(spark.read.schema("protein_id string").parquet(held), "protein_id", "left_anti")
        found = new.persist()
        try:
            if not found.isEmpty():
                log.append(build(found, number), run)
        finally:
            found.unpersist()

    provider, store = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(provider)
    spark.conf.set(provider, store)  # the query keeps what it starts with
    try:
        return first_seen(ids, known).writeStream.outputMode("append").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(provider, before)


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type and window, closed once the watermark has passed; works on streams and tables alike."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
