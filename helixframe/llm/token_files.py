"""Token counts of flat token files by separator scan.

A token file is a stream of little-endian ids (of 16 bits, unless told otherwise) in which an end-of-document id follows every
document; nothing indexes it. Files are listed with their lengths and read by ranges of bytes, so no task holds or reads a
whole file, as blocks of equal size that ignore documents. Each block is searched for
separators by itself, in one vectorised pass; what is open at its edges is stitched by a prefix scan over block
summaries (separators so far, tokens since the last one), first within runs of blocks, then over the runs of a file,
so no file gathers in one task.

Defined cases: a null or empty text is a document of 0 tokens; rows with equal ids are separate documents; a stream that
ends without separator gives a last document with closed = false, an empty stream none; an empty table gives no rows;
a file whose length is no multiple of the width of ids is an error.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import materialize, shared_dir
from .textkernels import Words, byte_column, chunks

SEPARATOR = 0
BLOCK_TOKENS = 1 << 18
#: Blocks of a run of the first prefix scan.
RUN_BLOCKS = 256
#: Blocks that are read one after another.
SPAN_BLOCKS = 32

STREAM = "file long, block long, data binary, ordinal long, doc_id long"


def write_stream(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Token files of the documents and, beside them, which document stands where.

    Each task writes one file: words become ids 1 to 65535 by hash. Returns blocks (file, block, data) and a manifest
    (file, ordinal, doc_id) that the scan doesn't read.
    """

    def write(batches):
        file, block, ordinal = TaskContext.get().partitionId(), 0, 0
        schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("data", pa.binary()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])
        held, n_held = [], 0

        def rows(data, ordinals, ids):
            n = max(len(ordinals), 1)
            blocks = [block] if data is not None else [None] * n
            return pa.record_batch([pa.array([file] * n, pa.int64()), pa.array(blocks, pa.int64()), pa.array([data] * n, pa.binary()), pa.array(ordinals or [None], pa.int64()), pa.array(ids or [None], pa.int64())], schema=schema)

        for batch in batches:
            data, off = byte_column(batch, "text")
            ids = batch.column(0).to_pylist()
            for lo, hi in chunks(off):
                w = Words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                tokens = (w.hashes() % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
                held.append(np.insert(tokens, w.doc_off[1:], SEPARATOR))
                n_held += len(held[-1])
                yield rows(None, list(range(ordinal, ordinal + hi - lo)), ids[lo:hi])
                ordinal += hi - lo
                while n_held >= block_tokens:
                    stream = np.concatenate(held)
                    yield rows(stream[:block_tokens].astype("<u2").tobytes(), [], [])
                    held, n_held, block = [stream[block_tokens:]], n_held - block_tokens, block + 1
        if n_held:
            yield rows(np.concatenate(held).astype("<u2").tobytes(), [], [])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    stored = materialize(texts.mapInArrow(write, STREAM), "tokens")
    return stored.where("data IS NOT NULL").select("file", "block", "data"), stored.where("data IS NULL").select("file", "ordinal", "doc_id")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _reaches(path: str) -> bool:
    try:
        _store(path)
    except (pa.ArrowException, OSError):
        return False
    return True


def write_files(docs: DataFrame, folder: str) -> DataFrame:
    """Flat token files of the documents under `folder`, one per task, with ids as in write_stream; returns the manifest (name, ordinal, doc_id)."""

    def write(batches):
        out, name, ordinal = None, f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}.bin", 0  # no two attempts share a file
        try:
            for batch in batches:
                data, off = byte_column(batch, "text")
                ids = batch.column(0)
                for lo, hi in chunks(off):
                    w = Words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                    tokens = (w.hashes() % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
                    if out is None:
                        store, at = _store(f"{folder}/{name}")
                        out = store.open_output_stream(at)
                    out.write(np.insert(tokens, w.doc_off[1:], SEPARATOR).astype("<u2").tobytes())
                    yield pa.record_batch([pa.array([name] * (hi - lo)), pa.array(np.arange(ordinal, ordinal + hi - lo)), ids.slice(lo, hi - lo)], names=["name", "ordinal", "doc_id"])
                    ordinal += hi - lo
        finally:
            if out is not None:
                out.close()

    store, at = _store(folder)
    store.create_dir(at)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return materialize(texts.mapInArrow(write, "name string, ordinal long, doc_id long"), "manifest")


def _read(size: int):
    def run(batches):
        schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("data", pa.binary())])
        for batch in batches:
            for file, path, length, span in zip(*(batch.column(i).to_pylist() for i in range(4))):
                store, at = _store(path)
                first, last = span * SPAN_BLOCKS, max(min((span + 1) * SPAN_BLOCKS, -(-length // size)), 1)
                with store.open_input_file(at) as source:
                    for block in range(first, last):
                        want = min(size, length - block * size)
                        data = source.read_at(want, block * size)
                        if len(data) != want:
                            raise OSError(f"{path} is shorter than listed")
                        yield pa.record_batch([[file], [block], [data]], schema=schema)

    return run


def read_token_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, id_bytes: int = 2) -> DataFrame:
    """Blocks of real flat files under `path`; `file` numbers them by hash of their path."""
    files = spark.read.format("binaryFile").load(path)
    size = id_bytes * block_tokens
    one = files.select("path").first()
    if one and not _reaches(one["path"]):
        # a store that Spark alone reads: it gives whole files, of less than 2 GiB each, and fails at larger ones
        n = F.greatest(F.ceil(F.octet_length("content") / size), F.lit(1)).cast("long")
        cut = files.select(F.xxhash64("path").alias("file"), "content", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("block"))
        return cut.select("file", "block", F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size)).alias("data"))
    n = F.greatest(F.ceil(F.col("length") / (size * SPAN_BLOCKS)), F.lit(1)).cast("long")
    spans = files.select(F.xxhash64("path").alias("file"), "path", "length", n.alias("n"))
    tasks = min(max(spans.agg(F.sum("n")).first()[0] or 1, 1), 20_000)
    spans = spans.select("file", "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("span"))
    return spans.repartition(tasks).mapInArrow(_read(size), "file long, block long, data binary")


SUMMARY = "file long, block long, n_tokens long, seps long, tail long, lengths array<long>"


def _summaries(separator: int, id_bytes: int):
    def run(batches):
        schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("n_tokens", pa.int64()), ("seps", pa.int64()), ("tail", pa.int64()), ("lengths", pa.list_(pa.int64()))])
        for batch in batches:
            rows = []
            for file, block, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = np.frombuffer(data, f"<u{id_bytes}")
                at = np.flatnonzero(ids == separator)
                tail = len(ids) - (int(at[-1]) + 1 if len(at) else 0)
                rows.append((file, block, len(ids), len(at), tail, (np.diff(at, prepend=-1) - 1).tolist()))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else pa.RecordBatch.from_pylist([], schema=schema)

    return run


def _prefix(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds `before` (separators in earlier rows) and `carry` (tokens since the last of them)."""
    w = Window.partitionBy(*by).orderBy(order)
    df = df.withColumn("_since", F.sum((F.col("seps") > 0).cast("long")).over(w))
    df = df.withColumn("_open", F.sum("tail").over(Window.partitionBy(*by, "_since").orderBy(order)))
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum("seps").over(earlier), F.lit(0))).withColumn("carry", F.coalesce(F.lag("_open").over(w), F.lit(0)))


def token_counts(blocks: DataFrame, separator: int = SEPARATOR, id_bytes: int = 2) -> DataFrame:
    """file, ordinal, n_tokens, closed of each document of the blocks (file, block, data)."""
    found = materialize(blocks.select("file", "block", "data").mapInArrow(_summaries(separator, id_bytes), SUMMARY), "separators")
    local = _prefix(found.select("file", "block", "seps", "tail", F.floor(F.col("block") / RUN_BLOCKS).alias("run")), ["file", "run"], "block")
    runs = local.groupBy("file", "run").agg(F.sum("seps").alias("seps"), F.max_by("_open", "block").alias("tail"))
    runs = _prefix(runs, ["file"], "run").select("file", "run", F.col("seps").alias("run_seps"), F.col("tail").alias("run_tail"), F.col("before").alias("run_before"), F.col("carry").alias("run_carry"), "_since", "_open")
    runs = materialize(runs, "runs")
    state = local.join(runs.select("file", "run", "run_before", "run_carry"), ["file", "run"])
    state = state.select("file", "block", (F.col("run_before") + F.col("before")).alias("before"), (F.col("carry") + F.when(F.col("before") == 0, F.col("run_carry")).otherwise(0)).alias("carry"))
    docs = found.where("seps > 0").select("file", "block", "lengths").join(state, ["file", "block"]).select("file", "before", "carry", F.posexplode("lengths").alias("pos", "length"))
    docs = docs.select("file", (F.col("before") + F.col("pos")).alias("ordinal"), (F.col("length") + F.when(F.col("pos") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"), F.lit(True).alias("closed"))
    ends = runs.groupBy("file").agg(F.sum("run_seps").alias("ordinal"), F.max_by("_open", "run").alias("n_tokens")).where("n_tokens > 0")
    return docs.unionByName(ends.withColumn("closed", F.lit(False)))


def document_token_counts(docs: DataFrame) -> DataFrame:
    """doc_id and n_tokens of each document, counted in the token files written from them."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    if _reaches(folder):
        manifest = write_files(docs, folder)
        one = spark.read.format("binaryFile").load(folder).select("path").first()
        stem = one["path"].rsplit("/", 1)[0] + "/" if one else ""
        manifest = manifest.select(F.xxhash64(F.concat(F.lit(stem), "name")).alias("file"), "ordinal", "doc_id")
        blocks = read_token_files(spark, folder)
    else:
        blocks, manifest = write_stream(docs)
    return token_counts(blocks).join(manifest, ["file", "ordinal"]).select("doc_id", "n_tokens")
