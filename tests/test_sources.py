"""Readers, the catalog, comparisons and the dataset plan."""

import json
import random
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions import text as t
from helixframe.operators import catalog, embeddings, ordering, quality
from helixframe.plans import dataset, report
from helixframe.sources import readers
from helixframe.streaming import incremental
from test_residues import cif

RANGES = """AF-A0A0A0K0K1-F1-model_v4__nan,
AF-A0A024B7W1-F1-model_v4__8cxi_C,1-403
AF-A0A024B7W1-F1-model_v4__8cxi_D,1-403
invalid_entry_with_bad_range,bad-range
AF-A0A024B7W1-F1-model_v4__8cxi_E,202-613;700-712
"""


def test_range_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(RANGES)
    good, bad = readers.range_file(spark, str(tmp_path / "a.csv"))
    rows = {r.full_id: r for r in good.collect()}
    assert sorted(rows) == ["AF-A0A024B7W1-F1-model_v4__8cxi_C", "AF-A0A024B7W1-F1-model_v4__8cxi_E", "AF-A0A0A0K0K1-F1-model_v4"]
    assert rows["AF-A0A0A0K0K1-F1-model_v4"].ranges is None
    assert [r.error for r in bad.collect()] == ["Range values must be integers"]
    assert readers.has_ranges(spark, str(tmp_path / "a.csv"))


def test_simple_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("protein_id\nA\n B \n\n")
    assert [r[0] for r in readers.simple_csv(spark, str(tmp_path / "a.csv")).collect()] == ["A", "B"]
    assert not readers.has_ranges(spark, str(tmp_path / "a.csv"))
    with pytest.raises(ValueError):
        readers.simple_csv(spark, str(tmp_path / "a.csv"), column=3)


def test_fasta(spark, tmp_path):
    df = spark.createDataFrame([("a", "AVL"), ("b", "G")], "protein_id string, sequence string")
    readers.write_fasta(df, str(tmp_path / "f"))
    assert sorted(map(tuple, readers.fasta(spark, str(tmp_path / "f")).collect())) == [("a", "AVL"), ("b", "G")]
    (tmp_path / "m.fa").write_text(">x one\nAV\nLG\n>y\n\n>z\nK")
    got = dict(map(tuple, readers.fasta(spark, str(tmp_path / "m.fa")).collect()))
    assert got == {"x": "AVLG", "y": "", "z": "K"}
    wanted = spark.createDataFrame([("z",)], "protein_id string")
    assert [r.protein_id for r in readers.fasta(spark, str(tmp_path / "m.fa"), wanted).collect()] == ["z"]


def test_indexes(spark, tmp_path):
    (tmp_path / "a.idx").write_text(json.dumps({"p": "f1", "q": "f1"}))
    (tmp_path / "r.idx").write_text(json.dumps({"f1": ["p", "q"]}))
    (tmp_path / "l.idx").write_text(json.dumps([["p", "f1"], ["q", "f1"]]))
    want = {("p", "f1"), ("q", "f1")}
    for name, reverse in (("a", False), ("r", True), ("l", False)):
        assert set(map(tuple, readers.json_index(spark, str(tmp_path / f"{name}.idx"), reverse).collect())) == want


def test_reuse_takes_the_newest_dataset(spark):
    rows = [("p", "initial", 1), ("p", "second", 2), ("q", "initial", 1)]
    index = spark.createDataFrame([(p, f"{d}/{p}", d, c) for p, d, c in rows], "protein_id string, path string, dataset_id string, created_at long")
    newest = catalog.newest_wins(index)
    asked = spark.createDataFrame([("p",), ("z",)], "protein_id string")
    present, missing = catalog.present_missing(asked, newest)
    assert [tuple(r) for r in present.collect()] == [("p", "second/p")] and [r[0] for r in missing.collect()] == ["z"]


def test_identity(spark):
    p = spark.createDataFrame([("coordinates/PDB-subset--fourth_7/batch_0_ca.h5", "coordinates"), ("structures/PDB/subset_/fourth_7/0/pdbs.h5", "dataset"), ("x/y", "dataset")], "path string, k string")
    rows = p.select(t.dataset_identity(F.col("path")).alias("i"), t.batch_of_path(F.col("path"), F.col("k")).alias("b")).collect()
    assert [tuple(r.i) for r in rows[:2]] == [("PDB", "subset", "fourth_7")] * 2 and rows[2].i.db is None
    assert [r.b for r in rows] == ["0", "0", None]


def test_consistency(spark):
    df = spark.createDataFrame([("A-C", "XABCX"), ("", "A"), ("", ""), ("A.C", "ABC"), ("ABCD", "ABC")], "s string, b string")
    assert [r[0] for r in df.select(quality.consistent(F.col("s"), F.col("b"))).collect()] == [True, True, False, False, False]


def test_containing(spark):
    ids = spark.createDataFrame([("abcdef",), ("xyz",), ("b",)], "id string")
    wanted = spark.createDataFrame([("bcd",), ("yz",), ("",)], "id string")
    assert sorted(r.id for r in catalog.containing(ids, wanted).collect()) == ["abcdef", "xyz"]


@pytest.mark.parametrize("keys", [1000, 7, 1])
def test_containing_with_any_number_of_automata(spark, keys):
    rng = random.Random(keys)
    word = lambda a, b: "".join(rng.choices("abé_", k=rng.randint(a, b)))
    texts = [word(0, 14) for _ in range(300)] + [None, "", "a"]
    words = [word(2, 5) for _ in range(40)] + ["", None]
    ids = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "id string, n int").repartition(3)
    wanted = spark.createDataFrame([(w,) for w in words * 2], "id string")
    want = [k for k, t in enumerate(texts) if t is not None and any(w in t for w in words if w)]
    found = catalog.containing(ids, wanted, keys=keys)
    assert sorted(r.n for r in found.collect()) == want and found.columns == ["id", "n"]
    plan = catalog.containing(ids, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_fasta_by_blocks_of_lines(spark, monkeypatch, size):
    """Records that span blocks, blocks without a header, lines before the first header, several files, empty records."""
    monkeypatch.setattr(readers, "BLOCK_LINES", size)
    text = {1: ["x", ">a one", "AB", " C", "", "D", "E", "F", ">b", ">c", "G"], 2: ["lost"], 3: [">a", *"HIJKLMNOP"]}
    lines = spark.createDataFrame([(f, k, v) for f, vs in text.items() for k, v in enumerate(vs)], "file int, line_no int, line string").repartition(6)
    assert sorted(map(tuple, readers.parse_fasta(lines).collect())) == [("a", "ABCDEF"), ("a", "HIJKLMNOP"), ("b", ""), ("c", "G")]
    assert readers.parse_fasta(lines.limit(0)).count() == 0


def test_index_stats_against_counting(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["dataset", "sequences"]), rng.choice(["s", "t", None]), rng.choice([0, 1, None]), rng.choice([*(f"f{k}" for k in range(9)), None]), f"p{k}") for k in range(200)]
    index = spark.createDataFrame(rows, "index_type string, slug string, batch int, path string, protein_id string").repartition(4)
    want = {}
    for t, s, b, f, p in rows:
        b = "-" if b is None else str(b)
        for key in ((0, t, None, None), (1, t, s, None), (2, t, s, b), (3, None, s, None)):
            n, files = want.setdefault(key, [0, set()])
            want[key][0] += 1
            files.update({f} - {None})
    got = catalog.index_stats(index)
    assert {(r.level, r.index_type, r.slug, r.batch): (r.proteins, r.files) for r in got.collect()} == {k: (n, len(f)) for k, (n, f) in want.items()}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    # bitmaps of two runs, put together
    files = catalog.file_numbers(index)
    halves = [catalog.file_bitmaps(index.where(c), files) for c in ("protein_id < 'p5'", "protein_id >= 'p5'")]
    assert sorted(map(str, catalog.bitmap_stats(halves[0].unionByName(halves[1])).collect())) == sorted(map(str, got.collect()))


def test_report_in_pages(spark, tmp_path):
    index = spark.createDataFrame([("dataset", f"s</{k}", k, f"f{k}", f"p{k}") for k in range(10)], "index_type string, slug string, batch int, path string, protein_id string")
    report.write_report(index, str(tmp_path / "r"), each=12)
    pages = {int(p.parent.name[5:]): p.read_text() for p in (tmp_path / "r").glob("page=*/*.txt")}
    rows = [json.loads(pages[k].split('id="d">')[1].split("</script>")[0]) for k in sorted(pages)]
    assert [len(r) for r in rows] == [12, 12, 7] and sum(r["files"] for p in rows for r in p if r["level"] == 2) == 10
    assert "page=1" in pages[0] and "page=3" not in pages[2] and {r["slug"] for p in rows for r in p} == {None, *(f"s</{k}" for k in range(10))}


def test_batches(spark):
    df = spark.range(1, 26).withColumnRenamed("id", "k")
    assert {r.k: r.batch for r in catalog.batches(df, "k", 10, 5).collect()} == {k: 5 + (k - 1) // 10 for k in range(1, 26)}


def test_dataset_end_to_end(spark, tmp_path):
    line = "ATOM {i} {a} . {r} {c} {n} ? {n}.000 2.000 3.000 1.00 20.00 C ? 1"
    rows = "\n".join(line.format(i=i, a="CA", r=r, c=c, n=n) for i, (r, c, n) in enumerate([("ALA", "A", 1), ("GLY", "A", 3), ("VAL", "B", 1), ("TRP", "B", 2)]))
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as z:
        z.writestr("x/1abc.cif", cif(rows))
        z.writestr("note.txt", "no structure")
    (tmp_path / "ids.txt").write_text("1abc\n9zzz\n")
    embeddings.register("esmc_300m", lambda: embeddings.HashEmbedder(960))
    spec = dataset.Spec(version="v1", input_path=str(tmp_path / "in.zip"), ids_file=str(tmp_path / "ids.txt"), embedder_type="esmc_300m")
    assert dataset.build(spark, str(tmp_path / "out"), spec) == dict.fromkeys(("dataset", "sequences", "distograms", "embeddings"), "done")
    read = lambda n: spark.read.parquet(str(tmp_path / "out" / n))
    assert {r.protein_id: r.sequence for r in read("sequences").collect()} == {"1abc_A": "AXG", "1abc_B": "VW"}
    assert {r.protein_id: len(r.emb) for r in read("embeddings").collect()} == {"1abc_A": 5, "1abc_B": 4}
    with pytest.raises(dataset.FatalDatasetError):
        dataset.Spec(ids_file=None)


def test_report(spark):
    index = spark.createDataFrame([("dataset", "s", 0, "f", "p"), ("dataset", "s", None, "g", "q")], "index_type string, slug string, batch int, path string, protein_id string")
    page = report.index_report(index)
    data = json.loads(page.split('id="d">')[1].split("</script>")[0])
    assert {(r["level"], r["slug"], r["batch"]): (r["files"], r["proteins"]) for r in data}[(1, "s", None)] == (2, 2)


def test_embedding_batches_keep_to_a_budget(spark):
    """Long and short sequences in any order: no batch, padded, exceeds the budget unless one sequence alone does."""
    rng = random.Random(8)
    rows = [(f"p{k}", "A" * rng.choice((1, 5, 40, 41, 300, 900))) for k in range(400)] + [("none", None), ("empty", "")]
    budget = 800

    class Checked(embeddings.HashEmbedder):
        def embed(self, sequences):
            padded = max(len(s) + 2 for s in sequences) * len(sequences)
            if padded > budget and len(sequences) > 1:
                raise ValueError(f"{padded} tokens")
            return [np.full((len(s) + 2, self.width), padded, np.float32) for s in sequences]

    df = spark.createDataFrame(rows, "protein_id string, sequence string").repartition(7)
    for ranges in (1, 5, None):
        got = {r.protein_id: r.emb for r in embeddings.embeddings(df, lambda: Checked(3), budget, ranges).collect()}
        assert set(got) == {p for p, s in rows if s is not None} and all(len(got[p]) == len(s) + 2 for p, s in rows if s is not None)
        used = [got[p][0][0] for p, s in rows if s is not None and len(s) == 1]
        assert ranges != 1 or sum(used) / len(used) > budget * 0.8  # short ones are put together
    assert embeddings.batches_by_tokens([], 5) == [] and embeddings.batches_by_tokens([3, 3, 9, 9], 6) == [(0, 2), (2, 3), (3, 4)]


def test_embedding_draws_a_row_once_and_runs_its_input_once(spark, monkeypatch):
    """The rows of residues that have been met are kept and stay what they were, and dealing takes no sample of the sequences."""
    drawn, real = [], np.random.default_rng
    monkeypatch.setattr(np.random, "default_rng", lambda seed: (drawn.append(seed), real(seed))[1])
    model, texts = embeddings.HashEmbedder(4), ["ACA", "", "CACAC", "ACA" * 50]
    for got, s in zip(model.embed(texts) + model.embed(texts[:1]), [*texts, texts[0]], strict=True):
        padded = f"<{s}>"
        want = [real(zlib.crc32(padded[max(i - 1, 0) : i + 2].encode())).standard_normal(4, np.float32) for i in range(len(padded))]
        assert np.array_equal(got, np.stack(want))
    assert len(drawn) == len(set(drawn)) and model.embed([]) == []
    df = spark.createDataFrame([("p", "AC")], "protein_id string, sequence string")
    assert "rangepartitioning" not in embeddings.embeddings(df, lambda: embeddings.HashEmbedder(2))._jdf.queryExecution().executedPlan().toString()


def test_rows_by_cores(spark):
    rows = spark.createDataFrame([("8", "b"), ("16", "a"), (" 4 ", "c"), ("x", "d"), (None, "e"), ("8", "a")], "cores string, run string")
    assert [(r.cores, r.run) for r in ordering.by_number(rows, "cores", "run").collect()] == [(" 4 ", "c"), ("8", "a"), ("8", "b"), ("16", "a"), ("x", "d"), (None, "e")]
