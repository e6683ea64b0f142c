"""Tables between two steps of one job, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only in local mode, where none is set, a temporary one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows, computed once: written to the shared folder and read from there, which also ends their lineage."""
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
