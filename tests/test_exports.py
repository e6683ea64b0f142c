"""Exports and study helpers."""

import io
import zipfile

from pyspark.sql import functions as F

from helixframe import cli
from helixframe.operators import studies
from helixframe.sources import exports


def test_zip_batches(spark):
    df = spark.createDataFrame([(0, "b", "B"), (0, "a.pdb", "A"), (1, "c", "")], "batch long, protein_id string, pdb_text string")
    got = {r.batch: r for r in exports.zip_batches(df).collect()}
    with zipfile.ZipFile(io.BytesIO(bytes(got[0].archive))) as z:
        assert z.namelist() == ["a.pdb", "b.pdb"] and z.read("b.pdb") == b"B"
    assert (got[0].n, got[1].n) == (2, 1)


def test_codec_sizes(spark, tmp_path):
    df = spark.range(20_000).select(F.concat(F.lit("ATOM "), (F.col("id") % 50).cast("string")).alias("line"))
    sizes = {r.codec: r.bytes for r in exports.codec_sizes(df.coalesce(1), str(tmp_path)).collect()}
    assert set(sizes) == set(exports.CODECS) and min(sizes.values()) > 0


def test_advice(spark):
    rows = spark.createDataFrame([(x,) for x in (1.04, 0.8, 0.93, 1.2, 1.08)], "r double").select(studies.advice(F.col("r"))).collect()
    assert [r[0] for r in rows] == ["either", "new, clearly", "new", "old, clearly", "old"]


def test_command_line(spark, tmp_path, capsys):
    line = "ATOM      1  CA  ALA A   1       1.000   2.000   3.000  1.00 20.00           C  "
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x_A.pdb").write_text(line + "\n" + line.replace("ALA A   1", "GLY A   3") + "\n")
    cli.main(["sequences", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "fa")], spark)
    assert [r[0] for r in spark.read.text(str(tmp_path / "fa")).collect()] == [">x_A", "AXG"]
    (tmp_path / "ids.txt").write_text("x_A\n")
    cli.main(["build", "--root", str(tmp_path / "out"), "--input", str(tmp_path / "in"), "--ids", str(tmp_path / "ids.txt"), "--version", "v1"], spark)
    cli.main(["list", "--root", str(tmp_path / "out")], spark)
    cli.main(["extract", "--root", str(tmp_path / "out"), "--ids", str(tmp_path / "ids.txt"), "--output", str(tmp_path / "ex")], spark)
    assert "PDB-subset--v1" in capsys.readouterr().out
    assert spark.read.text(str(tmp_path / "ex")).where("value <> ''").count() == 2
