"""Unit vectors of sequences, coordinates, ranges, structure lines and mmCIF."""

import pytest
from pyspark.sql import functions as F

from helixframe.functions import text as t
from helixframe.operators import distograms, mmcif, residues

ATOMS = "protein_id string, line_no int, atom_name string, res_name string, res_seq int, x double, y double, z double, occupancy double"
TEN = [("CA", r, i + 1, (9.0 + i + 1, 19.0 + i + 1, 29.0 + i + 1)) for i, r in enumerate(["ALA", "VAL", "LEU", "ILE", "GLY"] * 2)]


def atoms(spark, rows, ranges=None):
    data = [("p", i, a, r, n, *xyz, 1.0) for i, (a, r, n, xyz) in enumerate(rows)]
    df = spark.createDataFrame(data, ATOMS)
    return df if ranges is None else df.withColumn("ranges", F.lit(None).cast(t.RANGES) if ranges == "none" else F.array(*(F.struct(F.lit(a).alias("s"), F.lit(b).alias("e")) for a, b in ranges)).cast(t.RANGES))


def at(x=1.0, y=2.0, z=3.0):
    return (x, y, z)


def both(df, carbon="CA", ranges=None):
    s = residues.sequences(df, carbon, ranges).collect()
    c = sorted(tuple(r)[1:] for r in residues.coordinates(df, carbon, ranges).collect())
    return (s[0]["sequence"] if s else ""), c


@pytest.mark.parametrize(
    "ranges, sequence, n",
    [("none", "AVLIGAVLIG", 10), ([(3, 7)], "LIGAV", 5), ([(1, 3), (8, 10)], "AVLXXXXLIG", 10), ([(2, 3), (7, 8)], "VLXXXVL", 7), ([(8, 15)], "LIG", 3), ([(20, 25)], "", 0), ([], "", 0)],
)
def test_ranges(spark, ranges, sequence, n):
    s, c = both(atoms(spark, TEN, ranges), ranges="ranges")
    assert (s, len(c)) == (sequence, n)
    if ranges == [(1, 3), (8, 10)]:
        assert [r[1] for r in c[3:7]] == [None] * 4


@pytest.mark.parametrize(
    "rows, sequence, known",
    [
        ([], "", []),
        ([("N", "ALA", 1, at()), ("C", "ALA", 1, at())], "A", [False]),
        ([("CA", "ALA", 1, at()), ("N", "PHE", 2, at()), ("CA", "VAL", 4, at())], "AFXV", [True, False, False, True]),
        ([("CA", "ALA", 1, at()), ("CA", "UNK", 2, at()), ("CA", "GLY", 3, at())], "AXG", [True] * 3),
        ([("N", "MET", 1, at()), ("CA", "ALA", 2, at()), ("C", "LYS", 3, at())], "MAK", [False, True, False]),
        ([("CA", "VAL", 3, at()), ("CA", "ALA", 1, at()), ("CA", "GLY", 2, at())], "AGV", [True] * 3),
        ([("N", "UNK", 10, at()), ("C", "XXX", 15, at())], "XXXXXX", [False] * 6),
    ],
)
def test_gaps(spark, rows, sequence, known):
    s, c = both(atoms(spark, rows))
    assert s == sequence and [r[1] is not None for r in c] == known


def test_carbon_choice(spark):
    df = atoms(spark, [("CB", "ALA", 1, (10.0, 11.0, 12.0)), ("CA", "ALA", 1, (1.0, 2.0, 3.0))])
    assert both(df)[1] == [(1, 1.0, 2.0, 3.0)] and both(df, "CB")[1] == [(1, 10.0, 11.0, 12.0)]


def test_range_parsing(spark):
    texts = [" 1 - 403 ; 700 - 712 ", "403", "a-403", "403-1", "", "5-5"]
    rows = spark.createDataFrame([(x,) for x in texts], "s string").select(t.range_error(F.col("s")), t.parse_ranges(F.col("s"))).collect()
    assert [r[0] for r in rows] == [None, "Range must contain '-'", "Range values must be integers", "Range start must be <= end", None, None]
    assert [tuple(x) for x in rows[0][1]] == [(1, 403), (700, 712)] and rows[4][1] is None


def test_distogram(spark):
    df = spark.createDataFrame([("p", 1, 0.0, 0.0, 0.0), ("p", 2, None, None, None), ("p", 3, 3.0, 4.0, 0.0), ("q", 1, 1.0, 1.0, 1.0)], "protein_id string, res_idx int, x double, y double, z double")
    assert sorted((r.i, r.j, r.d) for r in distograms.distogram(df).collect() if r.d is not None) == [(1, 3, 5.0)]
    m = distograms.packed_distogram(df).collect()
    assert len(m) == 1 and m[0].m[0][2] == 5.0 and m[0].m[1][1] == 0.0 and m[0].m[0][1] != m[0].m[0][1]
    assert [r.protein_id for r in distograms.degenerate(df).collect()] == ["q"]


def cif(rows):
    return "loop_\n" + "\n".join(f"_atom_site.{n}" for n in ("group_PDB", "id", "label_atom_id", "label_alt_id", "label_comp_id", "auth_asym_id", "label_seq_id", "pdbx_PDB_ins_code", "Cartn_x", "Cartn_y", "Cartn_z", "occupancy", "B_iso_or_equiv", "type_symbol", "pdbx_formal_charge", "pdbx_PDB_model_num")) + "\n" + rows + "\n#\n"


def test_mmcif(spark):
    rows = """ATOM 1 N . ALA A 1 ? 1.000 2.000 3.000 1.00 20.00 N ? 1
ATOM 2 CA . ASP B 1 ? 4.000 5.000 6.000 0.40 20.00 N ? 1
ATOM 3 CA . ASP B 1 ? 4.500 5.000 6.000 0.60 20.00 N ? 1
ATOM 4 N . ABC C 1 ? 1.000 2.000 3.000 1.00 20.00 N ? 1
ATOM 5 N . MSE A 2 ? 1.000 2.000 3.000 1.00 20.00 N ? 1
ATOM 6 N . GLY A 3 ? 1.000 2.000 3.000 1.00 20.00 N ? 2
ATOM 7 broken"""
    df = spark.createDataFrame([("1xyz", cif(rows))], "file string, text string")
    got = {r.protein_id: r.pdb_text.split("\n") for r in mmcif.chains(df).collect()}
    assert set(got) == {"1xyz_A", "1xyz_B", "1xyz_C"} and got["1xyz_C"] == [""]
    assert len(got["1xyz_A"]) == 2 and "MET" in got["1xyz_A"][1] and len(got["1xyz_B"]) == 1 and "4.500" in got["1xyz_B"][0]
    assert got["1xyz_A"][0].startswith("ATOM      1  N   ALA A   1 ") and len(got["1xyz_A"][0]) == 80
    assert [r.line for r in mmcif.atom_rows(df)[1].collect()] == ["ATOM 7 broken"]


def test_real_lines_survive(spark):
    """A written line is read back with the same fields."""
    s = F.lit
    line = t.pdb_line(s("ATOM"), s("123456"), s("CG"), s("TRP"), s("AB"), s("-12"), s("A"), s("-123.45678"), s("1.0"), s("2.5"), s("1.00"), s("20.123456"), s("C"), s("?"))
    r = spark.range(1).select(t.pdb_fields(line).alias("f")).first().f
    assert (r.serial, r.atom_name, r.res_name, r.chain, r.res_seq, r.icode, r.x, r.b_factor, r.element) == (12345, "CG", "TRP", "B", -12, "A", -123.456, 20.123, "C")


def test_texts_are_split_once(spark):
    """No filter splits a text or makes an array again, and a line is split in one place."""
    texts = spark.createDataFrame([("f", "x")], "file string, text string")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    of = lambda df: [x for x in plan(df) if "split(" in x]
    assert not [x for x in of(mmcif.atom_rows(texts)[0]) if "Filter" in x]
    assert len(of(mmcif.atom_rows(texts)[0])) == 3  # of the text, the first row and a line
    assert len(of(mmcif.atoms_of_text(texts.selectExpr("file AS protein_id", "text AS pdb_text")))) == 1
    assert sum("flatten(" in x for x in plan(residues.coordinates(atoms(spark, TEN)))) == 1


def test_other_white_space_in_rows(spark):
    """Rows are cut at any run of white space, as before."""
    rows = "ATOM  1\tCA . ALA A  1 ?  1.000 2.000\t\t3.000 1.00 20.00 C ? 1"
    text = "loop_\n" + "\n".join(f"_atom_site.{n}" for n in mmcif.FIELDS) + "\n" + rows.replace(" . ", " ") + "\n"
    got = mmcif.atom_rows(spark.createDataFrame([("f", text)], "file string, text string"))[0].collect()
    assert [tuple(r[n] for n in mmcif.FIELDS[:9]) for r in got] == [("ATOM", "1", "CA", "ALA", "A", "1", "?", "1.000", "2.000")]


def test_chains_tell_all(spark):
    """Residues grouped once give the sequences and coordinates of both operators, and count lines whose number can't be read."""
    df = atoms(spark, TEN)
    grouped = residues.chains(df.unionByName(df.limit(2).withColumn("res_seq", F.lit(None).cast("int"))))
    a = F.col("a")
    assert sorted(map(tuple, grouped.select("protein_id", residues.filled_sequence(a, "l")).collect())) == sorted(map(tuple, residues.sequences(df).collect()))
    rows = residues.coordinate_rows(grouped, residues.filled_coordinates(a, "xyz"), "protein_id")
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(map(tuple, residues.coordinates(df).collect()), key=repr)
    assert grouped.agg(F.sum("n"), F.sum("bad")).first() == (df.count() + 2, 2)
