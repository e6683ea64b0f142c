"""Datasets built on one another: what is reused, made anew, missing and reported."""

import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from helixframe import cli
from helixframe.functions.text import without_last_token
from helixframe.operators import catalog, ordering
from helixframe.plans import dataset, report
from helixframe.sources import exports, fetch, readers
from test_residues import cif

LINE = "ATOM {i} CA . {r} {c} {n} ? {n}.000 2.000 3.000 1.00 20.00 C ? 1"
FIVE = {"1aa6": "A", "1fdi": "A", "1fdo": "A", "1pae": "X", "2iv2": "X"}
SEVEN = FIVE | {"3eao": "ABCDEF", "1brs": "ABCDEF"}


def write_inputs(folder):
    folder.mkdir()
    for code, chains in SEVEN.items():
        rows = [LINE.format(i=k, r=r, c=c, n=n) for k, (c, r, n) in enumerate((c, r, n) for c in chains for r, n in (("ALA", 1), ("GLY", 3)))]
        (folder / f"{code}.cif").write_text(cif("\n".join(rows)))
    return str(folder)


def origins(spark, root, spec, kind="dataset"):
    """How many ids of a dataset's index come from each dataset."""
    rows = dataset.own(spark, root, spec, kind).select(F.regexp_extract("path", "--([^/]+)/", 1).alias("d")).groupBy("d").count().collect()
    return {r.d: r["count"] for r in rows}


def test_five_datasets(spark, tmp_path):
    source, root = write_inputs(tmp_path / "in"), str(tmp_path / "out")
    ids = {5: "\n".join(FIVE), 7: "\n".join([*SEVEN, "9zzz"])}
    for n, text in ids.items():
        (tmp_path / f"{n}.txt").write_text(text + "\n")
    wanted = {
        "initial_5": (5, False, {"initial_5": 5}), "second_5": (5, True, {"second_5": 5}), "third_7": (7, False, {"second_5": 5, "third_7": 12}),
        "fourth_7": (7, True, {"fourth_7": 17}), "fifth_7": (7, False, {"fourth_7": 17}),
    }
    specs = {}
    for k, (name, (n, overwrite, found)) in enumerate(wanted.items()):
        spec = specs[name] = dataset.Spec(version=name, input_path=source, ids_file=str(tmp_path / f"{n}.txt"), overwrite=overwrite, batch_size=4, created_at=str(k + 1))
        assert set(dataset.build(spark, root, spec).values()) == {"done"}
        for kind in ("dataset", "sequences", "coordinates", "distograms"):
            assert origins(spark, root, spec, kind) == found, (name, kind)
    third = specs["third_7"]
    assert dataset.load(spark, root, third.dataset_id) == third
    lost = spark.read.text(f"{root}/missing_ids").where(F.col("dataset_id") == third.dataset_id)
    assert [r.value for r in lost.collect()] == ["9zzz"]
    # twelve new ids in batches of four
    assert spark.read.parquet(f"{root}/structures").where(F.col("dataset_id") == third.dataset_id).groupBy("batch").count().orderBy("batch").collect() == [(0, 4), (1, 4), (2, 4)]
    sequences = dataset.stored(spark, root, "sequences", dataset.own(spark, root, third, "sequences"))
    assert {r.sequence for r in sequences.collect()} == {"AXG"} and sequences.count() == 17
    index = report.described_index(dataset.indexes(spark, root).where(F.col("dataset_id") == third.dataset_id))
    top = {r.slug: (r.files, r.is_self) for r in catalog.top_referenced(index.where("index_type = 'dataset'"), own="third_7").collect()}
    assert top == {"second_5": (2, False), "third_7": (3, True)}
    # other settings find nothing
    other = dataset.Spec(version="x", input_path=source, ids_file=third.ids_file, carbon="CB")
    assert dataset.searched(spark, root, other, "distograms").isEmpty() and dataset.searched(spark, root, other, "dataset").count() == 17
    # a second run of a dataset adds batches and replaces none
    more = dataset.Spec(**(dataset.asdict(specs["initial_5"]) | {"ids_file": third.ids_file, "overwrite": True}))
    dataset.structures_stage(spark, root, more, dataset.requested_ids(spark, more))
    assert origins(spark, root, more) == {"initial_5": 17}


def test_structures_are_read_once(spark, tmp_path, monkeypatch):
    """Texts are split for one table only; what is saved or indexed joins nothing, and archives are listed once."""
    source, root, plans = write_inputs(tmp_path / "in"), str(tmp_path / "out"), {}
    (tmp_path / "ids.txt").write_text("\n".join(SEVEN) + "\n")
    write = dataset._write

    def kept(df, path, *by):
        plans.setdefault(path.rsplit("/", 1)[1], []).append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, path, *by)

    monkeypatch.setattr(dataset, "_write", kept)
    spec = dataset.Spec(version="v", input_path=source, ids_file=str(tmp_path / "ids.txt"), batch_size=4)
    assert set(dataset.build(spark, root, spec).values()) == {"done"}
    assert not [k for k in ("sequences", "coordinates", "errors", "indexes") for p in plans[k] if "split(" in p]
    assert not [k for k in ("sequences", "coordinates") for p in plans[k] if "Join" in p]
    # of the indexes, only that of structures asks what is held, which is a table by then
    assert ["Join" in p for p in plans["indexes"]] == [True, False, False, False]
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("2xyz.pdb", b"two")
    found = readers.archives(spark, str(tmp_path / "x.zip"), lambda stems: stems.where("stem = '2xyz'"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1 and found.count() == 1


def test_paths_of_batches(spark):
    """Places of odd paths, and ids by their last underscore, without regular expressions."""
    rows = ["sequences/dataset_id=PDB-subset--v/batch=12", "x/dataset_id=a b", "batch=3", "/batch=x", "", None]
    at = spark.createDataFrame([(k, p) for k, p in enumerate(rows)], "k int, path string").select("k", *(c.alias(n) for n, c in zip("db", dataset._place()))).orderBy("k")
    assert [(r.d, r.b) for r in at.collect()] == [("PDB-subset--v", 12), ("a b", None), (None, None), (None, None), (None, None), (None, None)]
    ids = ["1abc_A", "a__b", "a_", "_", "a", "", "_a", None, "é_é_é"]
    got = spark.createDataFrame([(k, i) for k, i in enumerate(ids)], "k int, i string").orderBy("k").select(without_last_token(F.col("i"))).collect()
    assert [r[0] for r in got] == ["1abc", "a_", "a", "", "a", "", "", None, "é_é"]
    both = spark.createDataFrame([("a/b_A", 0), ("c", 12)], "protein_id string, batch int")
    assert {tuple(r) for r in dataset._apart(dataset._with_batch(both)).collect()} == {("a/b_A", 0), ("c", 12)}


def test_commands_over_a_dataset(spark, tmp_path, capsys):
    source, root = write_inputs(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "ids.txt").write_text("1aa6\n3eao_B\n")
    run = lambda *a: cli.main([*a, "--root", root], spark)
    run("dataset", "--input", source, "--ids", str(tmp_path / "ids.txt"), "--version", "v1", "--batch-size", "1")
    name = ("--dataset", "PDB-subset--v1")
    for command in ("load", "sequences", "distograms", "read-distograms", "read-pdbs"):
        run(command, *name)
    out = capsys.readouterr().out
    assert '"version": "v1"' in out and "3eao_B" in out and "2.0" in out
    run("archive", *name, "--output", str(tmp_path / "zips"))
    with zipfile.ZipFile(tmp_path / "zips" / "batch_1.zip") as z:
        assert z.namelist() == ["3eao_B.pdb"]
    run("report", *name, "--output", str(tmp_path / "page"))
    page = spark.read.text(str(tmp_path / "page"), wholetext=True).first()[0]
    data = json.loads(page.split('id="d">')[1].split("</script>")[0])
    assert {r["index_type"]: r["proteins"] for r in data if r["level"] == 0} == dict.fromkeys(("dataset", "sequences", "coordinates", "distograms"), 2)
    with pytest.raises(NotImplementedError):
        run("embeddings", *name)


def test_errors_of_single_proteins(spark, tmp_path):
    """A structure that can't be read, one too short and one without atoms are reported; the rest goes on."""
    folder = tmp_path / "in"
    folder.mkdir()
    line = "ATOM      1  CA  ALA A{n:>4}       1.000   2.000   3.000  1.00 20.00           C  "
    (folder / "good_A.pdb").write_text("\n".join(line.format(n=n) for n in (1, 2)))
    (folder / "bad_A.pdb").write_text("\n".join(line.format(n=n) for n in (1, "x", 2)))
    (folder / "short_A.pdb").write_text(line.format(n=1))
    (folder / "empty_A.pdb").write_text("HEADER")
    spec = dataset.Spec(collection_type="all", version="v", input_path=str(folder), ids_file=str(tmp_path / "types.txt"))
    (tmp_path / "types.txt").write_text("GOOD prot xray\nbad prot-nuc xray\nshort prot x\nempty prot x\nother nuc x\nlone\n")
    assert [r[0] for r in dataset.requested_ids(spark, spec).orderBy("protein_id").select("protein_id").collect()] == ["bad", "empty", "good", "short"]
    dataset.build(spark, str(tmp_path / "out"), spec)
    errors = {(r.stage, r.protein_id): r.error for r in spark.read.parquet(str(tmp_path / "out" / "errors")).collect()}
    assert errors == {("sequences", "bad_A"): "residue number unreadable in lines: 1", ("sequences", "empty_A"): "no atoms", ("distograms", "short_A"): "too short", ("distograms", "empty_A"): "no coordinates"}
    log = (tmp_path / "out" / "logs" / f"{spec.dataset_id}.log").read_text()
    assert "distograms: done" in log


class _Flaky:
    """Two files; one comes at the third attempt."""

    def __init__(self):
        self.seen = {}

    def __call__(self, name: str) -> bytes:
        self.seen[name] = self.seen.get(name, 0) + 1
        if name == "late" and self.seen[name] < 3 or name == "never":
            raise OSError("not now")
        return cif(LINE.format(i=1, r="ALA", c="A", n=1)).encode()


def test_fetching(spark, tmp_path):
    store = fetch.Store(_Flaky, "cif", attempts=4, delay_s=0.0)
    ids = spark.createDataFrame([("soon",), ("late",), ("never",), (None,), ("soon",)], "protein_id string").coalesce(1)
    rows = {r.protein_id: (r.error, r.attempts, r.content is None) for r in fetch.fetch(ids, store).collect()}
    assert rows == {"soon": (None, 1, False), "late": (None, 3, False), "never": ("OSError: not now", 4, True)}
    fetch.register("flaky", store)
    (tmp_path / "ids.txt").write_text("soon\nlate\nnever\n")
    spec = dataset.Spec(version="v", store="flaky", ids_file=str(tmp_path / "ids.txt"))
    root = str(tmp_path / "out")
    dataset.structures_stage(spark, root, spec, dataset.requested_ids(spark, spec))
    assert sorted(r.protein_id for r in dataset.own(spark, root, spec, "dataset").collect()) == ["late_A", "soon_A"]
    assert [tuple(r) for r in spark.read.parquet(f"{root}/errors").select("protein_id", "error").collect()] == [("never", "OSError: not now")]
    assert [r.value for r in spark.read.text(f"{root}/missing_ids").collect()] == ["never"]


def test_archives_of_both_kinds(spark, tmp_path):
    files = {"a/1abc.cif": b"one", "2xyz.pdb": b"two", "note.txt": b"no", "b/3bin.bcif": b"\x80"}
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z, tarfile.open(tmp_path / "x.tar.gz", "w:gz") as t:
        for name, content in files.items():
            z.writestr(name, content)
            (tmp_path / "m").write_bytes(content)
            t.add(tmp_path / "m", name)
    want = {("1abc", "cif", b"one"), ("2xyz", "pdb", b"two"), ("3bin", "bcif", b"\x80")}
    for name in ("x.zip", "x.tar.gz"):
        got = readers.archives(spark, str(tmp_path / name)).select("stem", "kind", "content").collect()
        assert {(r.stem, r.kind, bytes(r.content)) for r in got} == want
    only = readers.archives(spark, str(tmp_path / "x.zip"), lambda stems: stems.where("stem = '2xyz'"))
    assert [r.stem for r in only.collect()] == ["2xyz"]


def test_small_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,id\n1,abc\n2,\n3, def \n")
    assert [r[0] for r in readers.simple_csv(spark, str(tmp_path / "a.csv"), column=1).collect()] == ["abc", "def"]
    (tmp_path / "short.csv").write_text("k,id\n1,abc\n2\n")
    with pytest.raises(Exception, match="no column 1"):
        readers.simple_csv(spark, str(tmp_path / "short.csv"), column=1).collect()
    assert not readers.has_ranges(spark, str(tmp_path / "short.csv"))
    (tmp_path / "lookup").write_text("0 AF-1.pdb 0\n1 AF-2.cif 0\n2 AF-3.cif.pdb 0\nlone\n")
    assert [r.id for r in readers.lookup_entries(spark, str(tmp_path / "lookup")).collect()] == ["AF-1.pdb", "AF-3.cif.pdb"]
    wanted = spark.createDataFrame([("AF-3",)], "id string")
    assert [r.id for r in readers.lookup_entries(spark, str(tmp_path / "lookup"), wanted).collect()] == ["AF-3.cif.pdb"]
    index = spark.createDataFrame([("p", "f"), ("q", "f"), ("r", "g")], "protein_id string, path string")
    readers.write_json_index(index, str(tmp_path / "i" / "dataset"))
    pairs = {("p", "f"), ("q", "f"), ("r", "g")}
    assert set(map(tuple, readers.json_index(spark, str(tmp_path / "i" / "dataset.idx"), lines=True).collect())) == pairs
    assert set(map(tuple, readers.json_index(spark, str(tmp_path / "i" / "dataset_reversed.idx"), reverse=True, lines=True).collect())) == pairs


def test_discovered_index(spark, tmp_path):
    (tmp_path / "coordinates.idx").write_text(json.dumps({"p": "coordinates/PDB-subset--run/batch_4_ca.h5"}))
    (tmp_path / "coordinates_reversed.idx").write_text("{}")
    (tmp_path / "dataset.idx").write_text(json.dumps([["p", "structures/PDB/subset_/run/2/pdbs.h5"]]))
    rows = report.discovered_index(spark, str(tmp_path)).collect()
    assert {(r.index_type, r.slug, r.batch, r.protein_id) for r in rows} == {("coordinates", "run", "4", "p"), ("dataset", "run", "2", "p")}


def test_order_over_ranges(spark):
    """Places are the same whether one range holds all or many do, with ties and nulls."""
    rows = spark.createDataFrame([(k % 37, None if k % 11 == 0 else f"n{k % 53}", k) for k in range(400)], "a int, b string, c int").repartition(5)
    want = {r.c: k for k, r in enumerate(sorted(rows.collect(), key=lambda r: (r.a, r.b is not None, r.b or "", r.c)))}
    for ranges in (None, 1, 11):
        assert {r.c: r["rank"] for r in ordering.numbered(rows, "a", "b", "c", ranges=ranges).collect()} == want
    assert catalog.batch_count(spark.createDataFrame([("0",), ("12",), ("x1",)], "name string")) == 2
    lists = spark.createDataFrame([("p", [1]), ("q", [1, 2, 3]), ("r", [1, 2])], "id string, h array<int>")
    assert [r.id for r in ordering.longest(lists, "h", "id", 2).collect()] == ["q", "r"]


def test_written_archives(spark, tmp_path):
    df = spark.createDataFrame([(0, "b", "B"), (1, "c", "C")], "batch long, protein_id string, pdb_text string")
    assert sorted(map(tuple, exports.write_archives(df, str(tmp_path / "o")).collect())) == [(0, 1, "batch_0.zip"), (1, 1, "batch_1.zip")]
    with zipfile.ZipFile(tmp_path / "o" / "batch_1.zip") as z:
        assert z.read("c.pdb") == b"C"
