"""The driver's tables as tables of structures, ids and indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Residue names by part number: the standard ones, an unknown one, a modified one and a nucleic one.
NAMES = ("ALA", "CYS", "ASP", "GLU", "PHE", "GLY", "HIS", "ILE", "LYS", "LEU", "MET", "ASN", "PRO", "GLN", "ARG", "SER", "THR", "VAL", "TRP", "TYR", "UNK", "MSE", "DA")
INDEX_TYPES = ("dataset", "coordinates", "sequences", "distograms", "embeddings")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixed(column: str, places: int) -> Column:
    """A number as text with so many places, half up."""
    return F.col(column).cast(f"decimal(24,{places})").cast("string")


def pick(values: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (number % len(values)).cast("int"))


def atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as atoms: an order and return flag are a chain, a line number is a residue."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), "l_returnflag").alias("protein_id"),
        F.col("l_linenumber").cast("int").alias("res_seq"),
        pick(NAMES, F.col("l_partkey")).alias("res_name"),
        F.when(F.col("l_linestatus") == "O", "CA").otherwise("CB").alias("atom_name"),
        F.col("l_quantity").alias("x"),
        (F.col("l_discount") * 100).alias("y"),
        (F.col("l_tax") * 100).alias("z"),
        F.col("l_discount").alias("occupancy"),
        *(F.col(c) for c in ("l_orderkey", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")),
    )
    order = Window.partitionBy("protein_id").orderBy("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return rows.withColumn("line_no", F.row_number().over(order)).drop("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def long_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as residues of long chains: 500 orders in a row are a chain of some 2,000 residues; every 19th has no coordinates."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_extendedprice", "l_partkey", "l_quantity")).alias("v"))
    known = F.col("l_orderkey") % 19 != 0
    return rows.select(
        F.concat(F.lit("L"), F.floor(F.col("l_orderkey") / 500).cast("string")).alias("protein_id"),
        ((F.col("l_orderkey") % 500) * 7 + F.col("l_linenumber")).cast("int").alias("res_idx"),
        F.when(known, F.col("v.l_extendedprice") / 100).alias("x"),
        F.when(known, (F.col("v.l_partkey") % 500).cast("double")).alias("y"),
        F.when(known, F.col("v.l_quantity").cast("double")).alias("z"),
    )


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as index entries: a user is a protein, an event its path, a type an index type."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("protein_id"),
        F.col("event_id").alias("path"),
        F.col("event_type").alias("index_type"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("dataset_id"),
    )


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as index entries with paths in both layouts, and some that are neither."""
    o = table(spark, sf_dir, "orders")
    db, coll = pick(("PDB", "AFDB", "ESMatlas", "other", "wwPDB"), F.col("o_orderkey")), pick(("all", "part", "subset", "clust"), F.col("o_custkey"))
    kind = pick(INDEX_TYPES, F.col("o_orderkey") + F.col("o_custkey"))
    slug, batch = F.concat(F.lit("run_"), (F.col("o_custkey") % 97).cast("string")), (F.col("o_orderkey") % 13).cast("string")
    flat = F.concat(kind, F.lit("/"), db, F.lit("-"), coll, F.lit("--"), slug, F.lit("/batch_"), batch, F.when(kind == "coordinates", "_ca.h5").otherwise(".h5"))
    nested = F.concat(F.lit("structures/"), db, F.lit("/"), coll, F.lit("_/"), slug, F.lit("/"), batch, F.lit("/pdbs.h5"))
    return o.select(F.col("o_orderkey").cast("string").alias("protein_id"), kind.alias("index_type"), F.when(kind == "dataset", nested).otherwise(flat).alias("path"))


def range_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of a CSV file with residue ranges, some of them malformed."""
    o = table(spark, sf_dir, "orders")
    a = F.col("o_custkey") % 50
    span = lambda s, e: F.concat(s.cast("string"), F.lit("-"), e.cast("string"))
    one, two = span(a, a + F.col("o_orderkey") % 7 - 1), span(a + 60, a + 70)
    text = (
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(""))
        .when(F.col("o_orderkey") % 11 == 1, a.cast("string"))
        .when(F.col("o_orderkey") % 11 == 2, F.concat(F.lit("x-"), a.cast("string")))
        .when(F.col("o_orderkey") % 11 < 6, F.concat(F.lit(" "), two, F.lit(" ; "), one))
        .otherwise(one)
    )
    base = F.concat(F.lit("AF-"), F.col("o_custkey").cast("string"), F.lit("-F1-model_v4"))
    part = F.when(F.col("o_orderkey") % 5 == 0, F.lit("nan")).otherwise(F.concat((F.col("o_orderkey") % 1000).cast("string"), F.lit("_A")))
    return o.select(F.col("o_orderkey").alias("line_no"), F.concat(base, F.lit("__"), part, F.lit(","), text).alias("line"))


def dealt(rows: DataFrame, key: str, each: int) -> Column:
    """A file number for each row by its key, so that a file has `each` rows on average, whatever the size."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, rows.count() // each)))


def fasta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as FASTA records over several lines, all in one file: file, line_no, line."""
    d = table(spark, sf_dir, "documents")
    letters = F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z\n]+", ""))
    body = F.filter(F.split(letters, "\n"), lambda x: x != "")
    lines = F.concat(F.array(F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" "), F.coalesce("lang", F.lit("")))), body)
    return d.select(F.lit(0).alias("file"), "doc_id", F.posexplode(lines).alias("pos", "line")).select("file", F.struct("doc_id", "pos").alias("line_no"), "line")
