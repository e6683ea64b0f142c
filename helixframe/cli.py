"""Command line: python -m helixframe.cli COMMAND ...; --help lists the commands."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import catalog, distograms, mmcif, ordering, quality, residues
from .plans import dataset, report
from .sources import exports, readers

#: Flags of commands that make a dataset: name, default.
_SPEC = (("input", ""), ("store", ""), ("ids", None), ("db", "PDB"), ("collection", "subset"), ("proteome", ""), ("version", None), ("carbon", "CA"), ("embedder", None), ("batch-size", "1000"))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="helixframe")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, help_: str, *needed: str, **optional: str | None) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=help_)
        for n in needed:
            c.add_argument(f"--{n}", required=True)
        for n, default in optional.items():
            c.add_argument(f"--{n}", default=default)
        return c

    for name, help_ in (("build", "all stages of a dataset"), ("dataset", "structures of a dataset and its index")):
        c = command(name, help_, "root")
        for flag, default in _SPEC:
            c.add_argument(f"--{flag}", default=default)
        c.add_argument("--overwrite", action="store_true", help="make everything anew, whatever other datasets have")
    command("load", "a dataset's descriptor", "root", "dataset")
    for name in ("sequences", "distograms"):
        command(name, f"{name} of a dataset, or of structure files", input=None, output=None, carbon="CA", root=None, dataset=None)
    command("embeddings", "embeddings of a dataset", "root", "dataset")
    command("read-distograms", "distograms of a dataset, the first ids", "root", "dataset", limit="10")
    command("read-pdbs", "structures of a dataset, of some ids or all", "root", "dataset", ids=None, output=None)
    command("archive", "structures of a dataset as zip files, one per batch", "root", "dataset", "output")
    command("verify", "structures against reference sequences", "input", "reference")
    command("report", "HTML report of a dataset's indexes, of a folder of index files, or of an index table", "output", root=None, dataset=None, folder=None, index=None)
    command("extract", "structures of ids as text files, a folder per id", "root", "ids", "output")
    command("list", "datasets under a root", "root")
    d = sub.add_parser("fasta-diff", help="compare two FASTA files")
    d.add_argument("small")
    d.add_argument("big")
    return p


def _atoms(spark: SparkSession, path: str):
    return mmcif.atoms_of_text(dataset.structures(spark, dataset.Spec(collection_type="all", input_path=path))[0])


def _spec(a: argparse.Namespace) -> dataset.Spec:
    given = {"version": a.version} if a.version else {}
    return dataset.Spec(
        db_type=a.db, collection_type=a.collection, proteome=a.proteome, input_path=a.input, store=a.store, ids_file=a.ids, carbon=a.carbon,
        embedder_type=a.embedder, overwrite=a.overwrite, batch_size=int(a.batch_size), **given,
    )


def _indexed(spark: SparkSession, a: argparse.Namespace):
    if a.folder:
        return report.discovered_index(spark, a.folder)
    if a.index:
        return spark.read.parquet(a.index)
    return report.described_index(dataset.indexes(spark, a.root).where(F.col("dataset_id") == a.dataset))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("helixframe").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spec = dataset.load(spark, a.root, a.dataset) if getattr(a, "root", None) and getattr(a, "dataset", None) else None
    if a.command == "build":
        print(json.dumps(dataset.build(spark, a.root, _spec(a))))
    elif a.command == "dataset":
        made = _spec(a)
        dataset.structures_stage(spark, a.root, made, dataset.requested_ids(spark, made))
        print(made.dataset_id)
    elif a.command == "load":
        print(json.dumps(dataset.asdict(spec)))
    elif a.command == "sequences":
        if spec:
            dataset.sequences_stage(spark, a.root, spec, dataset.requested_ids(spark, spec))
        else:
            readers.write_fasta(residues.sequences(_atoms(spark, a.input), a.carbon), a.output)
    elif a.command == "distograms":
        if spec:
            dataset.distograms_stage(spark, a.root, spec)
        else:
            distograms.distogram(residues.coordinates(_atoms(spark, a.input), a.carbon)).write.mode("overwrite").parquet(a.output)
    elif a.command == "embeddings":
        dataset.embeddings_stage(spark, a.root, spec)
    elif a.command == "read-distograms":
        rows = dataset.stored(spark, a.root, "distograms", dataset.own(spark, a.root, spec, "distograms"))
        ordering.first_keys(rows, "protein_id", int(a.limit)).orderBy("protein_id", "i", "j").show(1000, truncate=False)
    elif a.command in ("read-pdbs", "archive"):
        rows = dataset.stored(spark, a.root, "structures", dataset.own(spark, a.root, spec, "dataset"))
        if a.command == "archive":
            ids = catalog.batches(rows.select("protein_id"), "protein_id", spec.batch_size)
            exports.write_archives(rows.join(ids, "protein_id"), a.output).orderBy("batch").show(1000, truncate=False)
        else:
            rows = rows.join(readers.id_list(spark, a.ids), "protein_id", "left_semi") if a.ids else rows
            rows.write.mode("overwrite").parquet(a.output) if a.output else rows.orderBy("protein_id").show(20)
    elif a.command == "fasta-diff":
        quality.fasta_diff_stats(quality.fasta_diff(readers.fasta(spark, a.small), readers.fasta(spark, a.big))).show(truncate=False)
    elif a.command == "verify":
        residues.verification_ratio(residues.verify_chains(_atoms(spark, a.input), readers.fasta(spark, a.reference))).show()
    elif a.command == "report":
        index = _indexed(spark, a)
        page = report.index_report(index)
        spark.createDataFrame([(page,)], "value string").coalesce(1).write.mode("overwrite").text(a.output)
        catalog.top_referenced(index, own=spec and spec.version).show(truncate=False)
    elif a.command == "extract":
        wanted = readers.id_list(spark, a.ids)
        rows = readers.read_structures(spark, f"{a.root}/structures", wanted)
        rows.select("pdb_text", "protein_id").write.mode("overwrite").partitionBy("protein_id").text(a.output)
    else:
        dataset.datasets(spark, a.root).select("id", "db_type", "collection_type", "proteome", "version", "created_at").orderBy(F.desc("created_at")).show(1000, truncate=False)


if __name__ == "__main__":
    main()
