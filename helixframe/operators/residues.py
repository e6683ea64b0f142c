"""Residues of chains: gap-filled sequences and coordinates, conformers, verification against reference sequences.

Input is the atoms table: protein_id, line_no, res_seq, res_name, atom_name, x, y, z, occupancy. All steps group by
protein_id, so one exchange serves them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import in_ranges, letter


def residues(atoms: DataFrame, carbon: str = "CA", ranges: str | None = None) -> DataFrame:
    """One row per residue number: the first residue name in file order, the last matching carbon's coordinates.

    ranges: a column of ranges; only residues within them count.
    """
    rows = atoms if ranges is None else atoms.where(in_ranges(F.col("res_seq"), F.col(ranges)))
    return _counted(rows, carbon).drop("n")


def _counted(atoms: DataFrame, carbon: str) -> DataFrame:
    """Residues with the number of their lines, n."""
    place = F.when(F.col("atom_name") == carbon, F.col("line_no"))
    return atoms.groupBy("protein_id", "res_seq").agg(F.min_by("res_name", "line_no").alias("res_name"), F.max_by(F.struct("x", "y", "z"), place).alias("xyz"), F.count("*").alias("n"))


def chains(atoms: DataFrame, carbon: str = "CA") -> DataFrame:
    """protein_id, a (residues in order: r, l, xyz), n (lines) and bad (lines whose residue number can't be read).

    All that sequences, coordinates and errors need of a chain, so its lines are grouped once for the three.
    """
    one = F.when(F.col("res_seq").isNotNull(), F.struct(F.col("res_seq").alias("r"), letter(F.col("res_name")).alias("l"), "xyz"))
    rows = _counted(atoms, carbon).select("protein_id", one.alias("one"), "n", F.when(F.col("res_seq").isNull(), F.col("n")).otherwise(0).alias("bad"))
    return rows.groupBy("protein_id").agg(F.sort_array(F.collect_list("one")).alias("a"), F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def last_atoms(atoms: DataFrame, name: str) -> DataFrame:
    """protein_id, res_seq, line_no, x, y, z of the last atom of a name in each residue."""
    one = F.max_by(F.struct("line_no", "x", "y", "z"), "line_no")
    return atoms.where(F.col("atom_name") == name).groupBy("protein_id", "res_seq").agg(one.alias("one")).select("protein_id", "res_seq", "one.*")


def _ordered(rows: DataFrame, value: Column) -> DataFrame:
    valued = rows.select("protein_id", F.struct(F.col("res_seq").alias("r"), value.alias("v")).alias("e"))
    return valued.groupBy("protein_id").agg(F.sort_array(F.collect_list("e")).alias("a"))


def filled_sequence(a: Column, value: str) -> Column:
    """The letters (value) of residues in order, X for each number between them."""
    before = lambda e, i: F.when(i > 0, e["r"] - F.get(a, i - 1)["r"] - 1).otherwise(0)
    return F.array_join(F.transform(a, lambda e, i: F.concat(F.repeat(F.lit("X"), before(e, i).cast("int")), e[value])), "")


def filled_coordinates(a: Column, value: str) -> Column:
    """array<struct<r, v>> of residues in order, with a null v for each number between them."""
    none = F.lit(None).cast("struct<x:double,y:double,z:double>")

    def fill(e: Column, i: Column) -> Column:
        last = F.get(a, i - 1)["r"]
        gap = F.when((i > 0) & (e["r"] - last > 1), F.sequence(last + 1, e["r"] - 1)).otherwise(F.array().cast("array<int>"))
        one = lambda r, v: F.struct(r.alias("r"), v.alias("v"))
        return F.concat(F.transform(gap, lambda r: one(r, none)), F.array(one(e["r"], e[value].cast("struct<x:double,y:double,z:double>"))))

    return F.flatten(F.transform(a, fill))


def coordinate_rows(rows: DataFrame, filled: Column, *keep: str) -> DataFrame:
    """A row for each of the filled coordinates: the kept columns, res_idx, x, y, z."""
    # no chain is without a row; outer, as Spark would else make the array once more to see that
    return rows.select(*keep, F.explode_outer(filled).alias("c")).select(*keep, F.col("c.r").alias("res_idx"), F.col("c.v.x").alias("x"), F.col("c.v.y").alias("y"), F.col("c.v.z").alias("z"))


def sequences(atoms: DataFrame, carbon: str = "CA", ranges: str | None = None) -> DataFrame:
    """protein_id and the sequence from its first to its last residue number, X where there is none or an unknown one."""
    a = _ordered(residues(atoms, carbon, ranges), letter(F.col("res_name")))
    return a.select("protein_id", filled_sequence(F.col("a"), "v").alias("sequence"))


def coordinates(atoms: DataFrame, carbon: str = "CA", ranges: str | None = None) -> DataFrame:
    """protein_id, res_idx, x, y, z for every number from the first to the last; nulls for gaps and for residues without the carbon."""
    return coordinate_rows(_ordered(residues(atoms, carbon, ranges), F.col("xyz")), filled_coordinates(F.col("a"), "v"), "protein_id")


def best_conformers(atoms: DataFrame) -> DataFrame:
    """The atom of highest occupancy of each (protein, residue, atom name), the earlier line on ties; numbered by first appearance."""
    one = F.max_by(F.struct("line_no", "res_name", "x", "y", "z", "occupancy"), F.struct(F.col("occupancy"), -F.col("line_no")))
    kept = atoms.groupBy("protein_id", "res_seq", "atom_name").agg(one.alias("one"), F.min("line_no").alias("first_line"))
    return kept.select("protein_id", "res_seq", "atom_name", "first_line", "one.*")


def verify_chains(atoms: DataFrame, references: DataFrame) -> DataFrame:
    """protein_id, n_checked, ok: every residue's letter (the last line's) stands at its number in the reference.

    references: protein_id, sequence. Chains without one are left out; a number beyond the reference is a mismatch.
    """
    last = atoms.groupBy("protein_id", "res_seq").agg(F.max_by(letter(F.col("res_name")), "line_no").alias("l"))
    both = last.join(references, "protein_id")
    at = F.when(F.col("res_seq").between(1, F.length("sequence")), F.substring(F.col("sequence"), F.col("res_seq"), F.lit(1)))
    return both.groupBy("protein_id").agg(F.count("*").alias("n_checked"), F.bool_and(F.coalesce(at == F.col("l"), F.lit(False))).alias("ok"))


def verification_ratio(verified: DataFrame) -> DataFrame:
    return verified.agg(F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("bad"), F.try_divide(F.count_if("ok"), F.count("*")).alias("ratio"))
