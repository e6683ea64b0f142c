"""Shared storage for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set, a temporary one of our own, which a cluster couldn't share."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.shared_path = path
    return table


#: Bytes of texts that travel to Python and back at a time, where the session has Spark's own bound.
BATCH_BYTES = 4 << 20
_BOUND, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, which hold 10,000 rows or 64 MB otherwise: of long texts every task holds several at once, in and out.

    A bound of the user's own is kept. Spark reads it when a plan begins to run, so it stays set.
    """
    if spark.conf.get(_BOUND, None) in (None, f"{_DEFAULT}b", str(_DEFAULT), "64m", "64MB"):
        spark.conf.set(_BOUND, f"{BATCH_BYTES}b")


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialize wrote, when nothing that is still to run reads them."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.shared_path)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
