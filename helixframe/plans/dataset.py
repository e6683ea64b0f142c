"""Datasets end to end: which ids exist, what is missing, and the stages from structures to embeddings.

Under one root lie the tables `datasets` (descriptors), `indexes` (what each dataset has: protein_id, path), `structures`,
`sequences`, `coordinates`, `distograms` and `embeddings` (a folder per dataset and batch), `missing_ids` and `errors`. A stage asks the
indexes of all compatible datasets what exists, the newest first, makes only the rest, and writes the dataset's own index,
which refers to files of other datasets for what was reused.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.refdata import COLLECTIONS, DATABASES
from ..functions.text import double_last_underscore, in_ranges, lower_ids, without_last_token
from ..operators import catalog, distograms, embeddings, mmcif, residues
from ..sources import bcif, fetch, readers
from .log import dataset_logger

#: The model of the embedding stage where none is named.
DEFAULT_EMBEDDER = "esm2_t33_650M_UR50D"


class FatalDatasetError(Exception):
    """A dataset that can't be built at all."""


@dataclass(frozen=True)
class Spec:
    db_type: str = "PDB"
    collection_type: str = "subset"
    proteome: str = ""
    version: str = field(default_factory=lambda: time.strftime("%Y%m%d_%H%M"))
    input_path: str = ""
    #: Name of a store registered with sources.fetch; files of input_path are read where there is none.
    store: str = ""
    ids_file: str | None = None
    carbon: str = "CA"
    embedder_type: str | None = None
    overwrite: bool = False
    batch_size: int = 1000
    created_at: str = field(default_factory=lambda: str(int(time.time() * 1e6)))

    def __post_init__(self):
        if self.db_type not in DATABASES or self.collection_type not in COLLECTIONS:
            raise ValueError(f"unknown kind of dataset: {self.db_type}, {self.collection_type}")
        if self.collection_type == "subset" and not self.ids_file:
            raise FatalDatasetError("a subset needs a file of ids")

    @property
    def dataset_id(self) -> str:
        return "-".join((self.db_type, self.collection_type, self.proteome, self.version))

    def folder(self, kind: str, batch: int | None = None) -> str:
        """Where a stage's files of this dataset lie, relative to the root."""
        return f"{kind}/dataset_id={self.dataset_id}" + ("" if batch is None else f"/batch={batch}")


# --- ids --------------------------------------------------------------------------------------

IdSource = Callable[[SparkSession, Spec], DataFrame]
_id_sources: dict[tuple[str, str], IdSource] = {}


def register_ids(db_type: str, collection_type: str, source: IdSource) -> None:
    """source gives the protein_id of a whole collection; it is what a server's list would give."""
    _id_sources[db_type, collection_type] = source


def _all_entries(spark: SparkSession, spec: Spec) -> DataFrame:
    """Entries that hold protein, of a local entry-type file."""
    if not spec.ids_file:
        raise NotImplementedError(f"listing all entries of {spec.db_type} needs a file of entries and types, or register_ids")
    return readers.entry_types(spark, spec.ids_file)


def _listed(spark: SparkSession, spec: Spec) -> DataFrame:
    if not spec.ids_file:
        raise NotImplementedError(f"{spec.db_type} {spec.collection_type} needs a file of ids, or register_ids")
    return readers.id_list(spark, spec.ids_file).select(F.trim("protein_id").alias("protein_id")).where("protein_id <> ''")


def requested_ids(spark: SparkSession, spec: Spec) -> DataFrame:
    """protein_id and ranges (null for none) of the ids that a dataset asks for."""
    none = F.lit(None).cast("array<struct<s:int,e:int>>").alias("ranges")
    source = _id_sources.get((spec.db_type, spec.collection_type))
    if source is None and spec.collection_type != "subset":
        source = _all_entries if (spec.db_type, spec.collection_type) == ("PDB", "all") else _listed
    if source is not None:
        return source(spark, spec).select("protein_id", none)
    if not spec.ids_file.endswith(".csv"):
        ids = readers.id_list(spark, spec.ids_file)
        return (ids.select(lower_ids(F.col("protein_id")).alias("protein_id")) if spec.db_type == "PDB" and spec.collection_type == "all" else ids).select("protein_id", none)
    if readers.has_ranges(spark, spec.ids_file):
        return readers.range_file(spark, spec.ids_file)[0].select(F.col("full_id").alias("protein_id"), "ranges")
    return readers.simple_csv(spark, spec.ids_file).select("protein_id", none)


# --- tables -----------------------------------------------------------------------------------

DATASETS = "id string, " + ", ".join(f"{f.name} {'boolean' if f.name == 'overwrite' else 'int' if f.name == 'batch_size' else 'string'}" for f in fields(Spec))
INDEXES = "protein_id string, path string, batch int, dataset_id string, index_type string"


def _write(df: DataFrame, path: str, *by: str) -> None:
    """A rerun replaces only the partitions that it writes."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table that may not be there yet; then empty, where its schema is told."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if schema is None or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def datasets(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/datasets", f"{DATASETS}, dataset_id string")


def indexes(spark: SparkSession, root: str) -> DataFrame:
    """Every dataset's indexes: protein_id, path, batch, dataset_id, index_type."""
    return _read(spark, f"{root}/indexes", INDEXES)


def describe(spark: SparkSession, root: str, spec: Spec) -> None:
    row = asdict(spec) | {"id": spec.dataset_id}
    df = spark.createDataFrame([tuple(row[f.split()[0]] for f in DATASETS.split(", "))], DATASETS)
    _write(df.withColumn("dataset_id", F.col("id")), f"{root}/datasets", "dataset_id")


def load(spark: SparkSession, root: str, dataset_id: str) -> Spec:
    """The descriptor of a dataset under root."""
    row = datasets(spark, root).where(F.col("id") == dataset_id).first()
    if row is None:
        raise FatalDatasetError(f"no dataset {dataset_id} under {root}")
    return Spec(**{f.name: row[f.name] for f in fields(Spec)})


def searched(spark: SparkSession, root: str, spec: Spec, index_type: str) -> DataFrame:
    """protein_id and path that any compatible dataset of the same database has, the newest dataset's first."""
    same = lambda name: catalog.alike(F.col(name), F.lit(getattr(spec, name)).cast("string"))
    fit = catalog.of_database(datasets(spark, root), spec.db_type, column="id").where(catalog.applies(F.lit(index_type), same("embedder_type"), same("carbon"), same("input_path")))
    rows = indexes(spark, root).where(F.col("index_type") == index_type)
    if rows.isEmpty():  # told before, so no step of a first build joins its ids with nothing
        return rows.select("protein_id", "path").limit(0)
    held = rows.join(fit.select("dataset_id", F.col("created_at").cast("long").alias("created_at")), "dataset_id")
    return catalog.newest_wins(held)


def own(spark: SparkSession, root: str, spec: Spec, index_type: str) -> DataFrame:
    """protein_id and path in the dataset's own index."""
    return indexes(spark, root).where((F.col("dataset_id") == spec.dataset_id) & (F.col("index_type") == index_type)).select("protein_id", "path")


def _with_batch(rows: DataFrame) -> DataFrame:
    """Rows whose protein_id carries their batch, `batch/id`, through operators that keep the id alone."""
    return rows.withColumn("protein_id", F.concat_ws("/", F.col("batch").cast("string"), "protein_id")).drop("batch")


def _apart(rows: DataFrame) -> DataFrame:
    """protein_id and batch again; the number has no slash, the id may have some."""
    both = F.col("protein_id")
    return rows.withColumns({"protein_id": F.substr(both, F.instr(both, "/") + 1), "batch": F.substring_index(both, "/", 1).cast("int")})


def _place() -> tuple[Column, Column]:
    """Dataset and batch that a path names; null for what it doesn't. Without regular expressions, as every id's path goes through it."""
    path = F.col("path")
    dataset = F.substring_index(F.substr(path, F.instr(path, "dataset_id=") + len("dataset_id=")), "/", 1)
    return F.when(path.contains("dataset_id="), dataset), F.when(path.contains("/batch="), F.substring_index(path, "/batch=", -1).try_cast("int"))


def write_index(root: str, spec: Spec, index_type: str, present: DataFrame, made: DataFrame) -> None:
    """The dataset's index of a type: what it reuses and what it made (a row for each id), which counts where both have an id."""
    both = present.select("protein_id", "path").join(made.select("protein_id"), "protein_id", "left_anti").unionByName(made)
    _write(both.withColumns({"batch": _place()[1], "dataset_id": F.lit(spec.dataset_id), "index_type": F.lit(index_type)}), f"{root}/indexes", "dataset_id", "index_type")


def _save(rows: DataFrame, root: str, kind: str, spec: Spec, first: int) -> DataFrame:
    """Rows of a stage, with their batch, as Parquet, a folder per batch of ids; gives the ids made and their paths.

    Rows are brought together by batch first, so a folder has a file, or some where it is large, and not one from each task.
    The batches of a run begin at first, after all there are, so what it made is told by the folders alone.
    """
    _write(rows.withColumn("dataset_id", F.lit(spec.dataset_id)).hint("rebalance", F.col("batch")), f"{root}/{kind}", "dataset_id", "batch")
    mine = rows.sparkSession.read.parquet(f"{root}/{kind}").where((F.col("dataset_id") == spec.dataset_id) & (F.col("batch") >= first))
    path = F.concat(F.lit(spec.folder(kind) + "/batch="), F.col("batch").cast("string"))
    return mine.groupBy("protein_id").agg(F.max("batch").alias("batch")).select("protein_id", path.alias("path"))


#: Where a row of a stage's table lies, and whose it is.
PLACE = ["dataset_id", "batch", "protein_id"]


def stored(spark: SparkSession, root: str, kind: str, work: DataFrame, told: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Rows of a stage's table for the ids of work (protein_id, path); only the folders that are named are read.

    told makes what is asked for of the rows, by PLACE, before they meet work. Where work has a batch, which stands for the run that reads, rows get it;
    an id then has one path.
    """
    at = work.withColumns(dict(zip(("dataset_id", "_at"), _place())))
    rows = told(spark.read.parquet(f"{root}/{kind}"))
    if "batch" not in work.columns:
        return rows.join(at.select("dataset_id", F.col("_at").alias("batch"), "protein_id"), PLACE, "left_semi").drop("dataset_id", "batch")
    new = at.select("dataset_id", F.col("_at").alias("batch"), "protein_id", F.col("batch").alias("_new"))
    return rows.join(new, PLACE).drop("dataset_id", "batch").withColumnRenamed("_new", "batch")


def report_errors(root: str, spec: Spec, stage: str, errors: DataFrame) -> None:
    """protein_id and error of what a stage left out."""
    _write(errors.select("protein_id", "error").withColumns({"dataset_id": F.lit(spec.dataset_id), "stage": F.lit(stage)}), f"{root}/errors", "dataset_id", "stage")


def staged(df: DataFrame, root: str, spec: Spec, name: str) -> DataFrame:
    """df written below root and read back: what several steps use is computed once, and no plan grows with the steps before it."""
    path = f"{root}/_work/{spec.dataset_id}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- structures -------------------------------------------------------------------------------


def _parsed(files: DataFrame) -> DataFrame:
    """protein_id and pdb_text of files (stem, kind, content)."""
    kinds = {r[0] for r in files.select("kind").distinct().collect()}  # three at most
    text = lambda kind: files.where(F.col("kind") == kind).select(F.col("stem").alias("file"), F.col("content").cast("string").alias("text"))
    out = text("pdb").select(F.col("file").alias("protein_id"), F.col("text").alias("pdb_text"))
    if "cif" in kinds:
        out = out.unionByName(mmcif.chains(text("cif")))
    if "bcif" in kinds:
        binary = bcif.to_cif(files.where("kind = 'bcif'").select(F.col("stem").alias("file"), "content"))
        out = out.unionByName(mmcif.chains(binary.where("text IS NOT NULL"), strict=True))
    return out


def _serving(stems: DataFrame, ids: DataFrame | None) -> DataFrame:
    """stems (stem) of files that can hold any of the ids: the id's own, its code's, or a chain of it."""
    if ids is None:
        return stems
    asked = ids.select(F.explode(F.array(F.col("protein_id"), without_last_token(F.col("protein_id")))).alias("k")).distinct()
    keys = stems.select("stem", F.explode(F.array_distinct(F.array(F.col("stem"), without_last_token(F.col("stem"))))).alias("k"))
    return keys.join(asked, "k", "left_semi").select("stem").distinct()


def structures(spark: SparkSession, spec: Spec, wanted: DataFrame | None = None, root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """protein_id and pdb_text of the chains in the input, and what couldn't be had (protein_id, error).

    wanted (protein_id): ids to fetch, or whose files alone are read. What is fetched or unpacked is kept below root, where one is given.
    """
    keep = lambda df, name: df if root is None else staged(df, root, spec, name)
    none = spark.createDataFrame([], "protein_id string, error string")
    if spec.store:
        store = fetch.store_of(spec.store)
        if wanted is None:
            raise FatalDatasetError("a store is asked for ids")
        codes = wanted.select(without_last_token(F.col("protein_id")).alias("protein_id")).distinct()
        got, lost = fetch.fetched_missing(keep(fetch.fetch(codes, store), "fetched"))
        return _parsed(got.select(F.col("protein_id").alias("stem"), F.lit(store.kind).alias("kind"), "content")), lost
    if spec.input_path.endswith((".zip", ".tar", ".tar.gz", ".tgz")):
        return _parsed(keep(readers.archives(spark, spec.input_path, lambda stems: _serving(stems, wanted)).select("stem", "kind", "content"), "unpacked")), none
    texts = readers.structure_files(spark, spec.input_path).select("stem", "kind", F.col("text").cast("binary").alias("content"))
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.bcif").option("recursiveFileLookup", "true").load(spec.input_path)
    files = texts.unionByName(found.select(F.regexp_extract("path", r"([^/]+)\.bcif$", 1).alias("stem"), F.lit("bcif").alias("kind"), "content"))
    if wanted is not None:
        files = files.join(keep(_serving(files.select("stem").distinct(), wanted), "stems"), "stem", "left_semi")
    return _parsed(files), none


def with_ranges(found: DataFrame, asked: DataFrame) -> DataFrame:
    """Ranges of each structure: those of its id, else of the id with its last underscore doubled, else of its base id."""
    r = asked.where("ranges IS NOT NULL").select(F.col("protein_id").alias("asked"), "ranges").dropDuplicates(["asked"])
    if r.isEmpty():
        return found.withColumn("ranges", F.lit(None).cast(r.schema["ranges"].dataType))
    keys = found.select("protein_id", F.posexplode(F.array("protein_id", double_last_underscore(F.col("protein_id")), without_last_token(F.col("protein_id")))).alias("p", "asked"))
    best = keys.join(r, "asked").groupBy("protein_id").agg(F.min_by("ranges", "p").alias("ranges"))
    return found.join(best, "protein_id", "left")


# --- stages -----------------------------------------------------------------------------------


def _batched(ids: DataFrame, root: str, spec: Spec, name: str, *kinds: str) -> tuple[DataFrame, int]:
    """ids, a row each, with their batch, after the batches that the dataset has of any of these kinds; staged as name. Also the first of them."""
    spark = ids.sparkSession
    last = [-1]
    for kind in kinds:
        have = _read(spark, f"{root}/{kind}", "protein_id string, dataset_id string, batch int").where(F.col("dataset_id") == spec.dataset_id)
        last.append(have.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0])
    first, ids = max(last) + 1, staged(ids, root, spec, f"{name}_ids")  # ranges are sampled first, so ids are read twice
    return staged(catalog.batches(ids, "protein_id", spec.batch_size, first).withColumn("batch", F.col("batch").cast("int")), root, spec, name), first


def structures_stage(spark: SparkSession, root: str, spec: Spec, asked: DataFrame) -> None:
    """Reuse structures of any compatible dataset, get the others, and write the index, the missing ids and the descriptor."""
    known = searched(spark, root, spec, "dataset")
    match = catalog.expand_prefixes if spec.db_type == "PDB" else lambda a, i: a.select(F.col("protein_id").alias("asked"), "protein_id").distinct().join(i, "protein_id").select("asked", "protein_id", "path")
    held = staged(match(asked, known).limit(0) if spec.overwrite else match(asked, known), root, spec, "held")
    missing = staged(asked.select("protein_id").distinct().join(held.select(F.col("asked").alias("protein_id")), "protein_id", "left_anti"), root, spec, "missing")
    got, lost = structures(spark, spec, missing, root)
    got = staged(got, root, spec, "parsed")
    matched = staged(match(missing, got.select("protein_id", F.lit("").alias("path"))).select("asked", "protein_id").distinct(), root, spec, "matched")
    new, first = _batched(matched.select("protein_id").distinct(), root, spec, "batches", "structures")
    made = _save(got.join(new, "protein_id"), root, "structures", spec, first)
    write_index(root, spec, "dataset", held.select("protein_id", "path").distinct(), made)
    index = own(spark, root, spec, "dataset")
    unresolved = missing.join(matched.select(F.col("asked").alias("protein_id")), "protein_id", "left_anti")
    unresolved.withColumn("dataset_id", F.lit(spec.dataset_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset_id").text(f"{root}/missing_ids")
    report_errors(root, spec, "dataset", lost)
    if index.isEmpty():
        raise FatalDatasetError("none of the ids has a structure")
    if spec.db_type == "other" and spec.collection_type == "subset" and not unresolved.isEmpty():
        raise FatalDatasetError("ids of a subset of another database have no structure")
    describe(spark, root, spec)


def sequences_stage(spark: SparkSession, root: str, spec: Spec, asked: DataFrame) -> None:
    """Sequences and coordinates of the dataset's structures; what lacks either is made from its structure."""
    structure_index = own(spark, root, spec, "dataset")
    held = {k: searched(spark, root, spec, k) for k in ("sequences", "coordinates")}
    present = {k: catalog.plan(structure_index, held[k], structure_index, spec.overwrite).present for k in held}
    # an id has one structure, so the work is the index without the ids that have both
    both = held["sequences"].select("protein_id").join(held["coordinates"].select("protein_id"), "protein_id")
    work = structure_index if spec.overwrite else structure_index.join(both, "protein_id", "left_anti")
    work, first = _batched(work, root, spec, "sequence_work", "sequences", "coordinates")
    # texts are dealt by id before they are split, so all that is grouped lies within a task
    texts = stored(spark, root, "structures", work.select("protein_id", "path")).repartition("protein_id")
    read = residues.chains(mmcif.atoms_of_text(texts), spec.carbon)
    ranged = with_ranges(work.select("protein_id", "batch").join(read, "protein_id", "left"), asked)
    # lines are read once; sequences, coordinates and errors are told from what was read
    chains = staged(ranged.withColumn("a", F.filter("a", lambda e: in_ranges(e["r"], F.col("ranges")))).drop("ranges"), root, spec, "chains")
    fine, a = chains.where(F.size("a") > 0), F.col("a")
    made = _save(fine.select("protein_id", residues.filled_sequence(a, "l").alias("sequence"), "batch"), root, "sequences", spec, first)
    placed = _save(residues.coordinate_rows(fine, residues.filled_coordinates(a, "xyz"), "protein_id", "batch"), root, "coordinates", spec, first)
    write_index(root, spec, "sequences", present["sequences"], made)
    write_index(root, spec, "coordinates", present["coordinates"], placed)
    why = F.when(F.col("n").isNull(), "no atoms").when(F.col("bad") > 0, F.concat(F.lit("residue number unreadable in lines: "), F.col("bad").cast("string"))).otherwise("no residue in the ranges")
    report_errors(root, spec, "sequences", chains.where("n IS NULL OR size(a) = 0 OR bad > 0").select("protein_id", why.alias("error")))


def distograms_stage(spark: SparkSession, root: str, spec: Spec) -> None:
    """Distograms of the dataset's structures, from the coordinate files of each; chains too short for one are reported."""
    ids, coordinate_index = own(spark, root, spec, "dataset"), own(spark, root, spec, "coordinates")
    plan = catalog.plan(ids, searched(spark, root, spec, "distograms"), coordinate_index, spec.overwrite)
    work, first = _batched(plan.work, root, spec, "distogram_work", "distograms")
    pairs = distograms.distogram(_with_batch(stored(spark, root, "coordinates", work)))
    write_index(root, spec, "distograms", plan.present, _save(_apart(pairs), root, "distograms", spec, first))
    # any two residues are a pair, so a chain without one is too short
    short = work.join(own(spark, root, spec, "distograms").select("protein_id"), "protein_id", "left_anti").select("protein_id", F.lit("too short").alias("error"))
    report_errors(root, spec, "distograms", plan.lost.select("protein_id", F.lit("no coordinates").alias("error")).unionByName(short))


def embeddings_stage(spark: SparkSession, root: str, spec: Spec) -> None:
    """Embeddings of the dataset's sequences by the model that the descriptor names."""
    ids, sequence_index = own(spark, root, spec, "dataset"), own(spark, root, spec, "sequences")
    plan = catalog.plan(ids, searched(spark, root, spec, "embeddings"), sequence_index, spec.overwrite)
    factory = embeddings.factory_of(spec.embedder_type or DEFAULT_EMBEDDER)
    work, first = _batched(plan.work, root, spec, "embedding_work", "embeddings")
    found = embeddings.embeddings(_with_batch(stored(spark, root, "sequences", work)), factory)
    write_index(root, spec, "embeddings", plan.present, _save(_apart(found), root, "embeddings", spec, first))
    report_errors(root, spec, "embeddings", plan.lost.select("protein_id", F.lit("no sequence").alias("error")))


def build(spark: SparkSession, root: str, spec: Spec) -> dict[str, str]:
    """All stages of a dataset; returns the state of each. A stage that fails is reported and the next still runs; only FatalDatasetError ends it."""
    state: dict[str, str] = {}
    log = dataset_logger(root, spec.dataset_id)

    def stage(name: str, f) -> None:
        try:
            f()
            state[name] = "done"
            log.info("%s: done", name)
        except FatalDatasetError as e:
            log.error("%s: %s", name, e)
            raise
        except Exception as e:  # reported by stage, as the caller asked
            state[name] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
            log.error("%s: %s", name, state[name])

    asked = staged(requested_ids(spark, spec), root, spec, "asked")
    stage("dataset", lambda: structures_stage(spark, root, spec, asked))
    stage("sequences", lambda: sequences_stage(spark, root, spec, asked))
    stage("distograms", lambda: distograms_stage(spark, root, spec))
    if spec.embedder_type:
        stage("embeddings", lambda: embeddings_stage(spark, root, spec))
    return state
