"""Exports: zip archives by batch, and sizes of a table under several codecs."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CODECS = ("uncompressed", "snappy", "gzip", "lz4", "zstd")


def zip_batches(structures: DataFrame, suffix: str = ".pdb") -> DataFrame:
    """batch, n, archive of structures (batch, protein_id, pdb_text): a zip file per batch, members in order of id. Batches bound what one task holds."""

    def pack(rows: pa.Table) -> pa.Table:
        return pa.table({"batch": rows["batch"][:1].cast(pa.int64()), "n": pa.array([rows.num_rows], pa.int64()), "archive": pa.array([_zip(rows, suffix)], pa.binary())})

    return structures.select("batch", "protein_id", "pdb_text").groupBy("batch").applyInArrow(pack, "batch long, n long, archive binary")


def _zip(rows: pa.Table, suffix: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in sorted(zip(rows["protein_id"].to_pylist(), rows["pdb_text"].to_pylist())):
            z.writestr(zipfile.ZipInfo(name if name.endswith(suffix) else name + suffix), text)
    return out.getvalue()


def write_archives(structures: DataFrame, path: str, suffix: str = ".pdb") -> DataFrame:
    """Write the archives of zip_batches as files batch_<n>.zip under path, each where it is made; gives batch, n, file."""

    def write(rows: pa.Table) -> pa.Table:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        system.create_dir(at, recursive=True)
        name = f"batch_{rows['batch'][0].as_py()}.zip"
        with system.open_output_stream(f"{at}/{name}") as out:
            out.write(_zip(rows, suffix))
        return pa.table({"batch": rows["batch"][:1].cast(pa.int64()), "n": pa.array([rows.num_rows], pa.int64()), "file": pa.array([name])})

    return structures.select("batch", "protein_id", "pdb_text").groupBy("batch").applyInArrow(write, "batch long, n long, file string")


def codec_sizes(df: DataFrame, path: str, codecs: tuple[str, ...] = CODECS) -> DataFrame:
    """codec, files, bytes of df written as Parquet under each codec below path."""
    spark = df.sparkSession
    for codec in codecs:
        df.write.mode("overwrite").option("compression", codec).parquet(f"{path}/{codec}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.groupBy(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("codec")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
