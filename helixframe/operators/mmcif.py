"""mmCIF atoms to structure text per chain, all in DataFrame functions.

Input is (file, text). The loop of ``_atom_site`` names its fields in order; rows are split at white space, and those
with another number of fields go to the errors. Only the first row's model counts, only ATOM and HETATM rows as asked.
Modified residues become standard ones; nucleic and unknown ones go. Of several conformers of an atom the one of
highest occupancy stays, at its residue's and atom's first appearance. A chain left without atoms is an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_nucleic, is_residue, pdb_line, substitute

FIELDS = ("group_PDB", "id", "label_atom_id", "label_comp_id", "auth_asym_id", "label_seq_id", "pdbx_PDB_ins_code", "Cartn_x", "Cartn_y", "Cartn_z", "occupancy", "B_iso_or_equiv", "type_symbol", "pdbx_formal_charge", "pdbx_PDB_model_num")


NEEDED = tuple(f for f in FIELDS if f not in ("pdbx_PDB_ins_code", "pdbx_formal_charge", "pdbx_PDB_model_num"))


def atom_rows(files: DataFrame, rows: tuple[str, ...] = ("ATOM", "HETATM")) -> tuple[DataFrame, DataFrame]:
    """Atoms of the first model as text fields (file, line_no, *FIELDS), and lines (file, line_no, line) of another width.

    A text is split once; where its header puts each field and which model is first are told from the split text, so nothing is joined.
    """
    is_row = lambda x: x.startswith("ATOM") | x.startswith("HETATM")
    # cut at single blanks, which needs no regular expression compiled for each line; other white space becomes one first
    fields = lambda x: F.split(F.regexp_replace(F.trim(x), r"\s{2,}|[^\S ]", " "), " ")
    split = files.select("file", F.split("text", r"\r?\n").alias("t"))
    names = F.transform(F.filter("t", lambda x: x.startswith("_atom_site.")), lambda x: F.substring(F.trim(x), 12, 1000))
    # widths are never null and lines are told by an outer explode, as for others Spark would test first, splitting each text again
    headed = split.select("file", "t", names.alias("h")).withColumn("width", F.coalesce(F.size("h"), F.lit(-1)))
    place = lambda n: F.array_position("h", F.lit(n)).cast("int")
    # the first row that fits; those after it aren't split for this
    first = F.aggregate(F.filter("t", is_row), F.lit(None).cast("array<string>"), lambda a, x: F.coalesce(a, F.when(F.size(fields(x)) == F.col("width"), fields(x))))
    headed = headed.select("file", "t", "width", F.struct(*(place(n).alias(n) for n in FIELDS)).alias("at"), first.alias("first"))
    of = lambda f, n: F.when(F.col(f"at.{n}") > 0, F.get(f, F.col(f"at.{n}") - 1))
    model = "pdbx_PDB_model_num"
    lines = headed.withColumn("model", of("first", model)).select("file", "width", "at", "model", F.posexplode_outer("t").alias("line_no", "line")).where(is_row(F.col("line")))
    # an array of one, so that a line is split once and not again in each filter and field
    cut = lines.select("*", F.explode(F.array(fields(F.col("line")))).alias("f"))
    fits = F.size("f") == F.col("width")
    named = cut.where(fits).where(of("f", model).eqNullSafe(F.col("model"))).select("file", "line_no", *(of("f", n).alias(n) for n in FIELDS))
    return named.where(F.col("group_PDB").isin(*rows)), cut.where(~fits).select("file", "line_no", "line")


def chains(files: DataFrame, rows: tuple[str, ...] = ("ATOM", "HETATM"), strict: bool = False) -> DataFrame:
    """protein_id (file_chain) and pdb_text of every chain of the files (file, text).

    strict is for texts from binary files: rows with a residue number that is no integer, or with any field missing, go,
    and of long serial numbers the last digits stay.
    """
    atoms, _ = atom_rows(files, rows)
    if strict:
        atoms = atoms.where(F.col("label_seq_id").try_cast("int").isNotNull()).dropna(subset=list(NEEDED))
    atoms = atoms.withColumn("res", substitute(F.col("label_comp_id"))).withColumn("fine", ~is_nucleic(F.col("res")) & is_residue(F.col("res")))
    name = F.translate("label_atom_id", "'\"", "")
    line = pdb_line(F.col("group_PDB"), F.col("id"), name, F.col("res"), F.col("auth_asym_id"), F.col("label_seq_id"), F.col("pdbx_PDB_ins_code"), F.col("Cartn_x"), F.col("Cartn_y"), F.col("Cartn_z"), F.col("occupancy"), F.col("B_iso_or_equiv"), F.col("type_symbol"), F.coalesce("pdbx_formal_charge", F.lit("?")), strict)
    # rows that go still name their chain: they have no order and no line, so a chain of them alone is an empty text
    one = F.max_by(F.struct("line_no", line.alias("line")), F.when(F.col("fine"), F.struct(F.col("occupancy").try_cast("double"), -F.col("line_no"))))
    dealt = atoms.withColumns({"protein_id": F.concat_ws("_", "file", "auth_asym_id"), "atom_name": name}).repartition("protein_id")  # all that follows is within chains
    kept = dealt.groupBy("protein_id", "label_seq_id", "atom_name").agg(one.alias("one"), F.min(F.when(F.col("fine"), F.col("line_no"))).alias("atom_first"))
    residue = F.min("atom_first").over(Window.partitionBy("protein_id", "label_seq_id")).alias("res_first")
    item = F.when(F.col("one").isNotNull(), F.struct("res_first", "atom_first", F.col("one.line").alias("line")))
    text = kept.select("protein_id", residue, "atom_first", "one").groupBy("protein_id").agg(F.array_sort(F.collect_list(item)).alias("a"))
    return text.select("protein_id", F.array_join(F.transform("a", lambda x: x["line"]), "\n").alias("pdb_text"))


def atoms_of_text(structures: DataFrame, every: bool = False) -> DataFrame:
    """The atoms table of structure texts (protein_id, pdb_text): ATOM lines only, numbered as they stand.

    every: structures without atoms give a row without fields.
    """
    from ..functions.text import pdb_fields

    text = F.split("pdb_text", r"\r?\n")
    if every:
        numbered = F.transform(text, lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
        lines = structures.select("protein_id", F.explode_outer(F.filter(numbered, lambda x: x["line"].startswith("ATOM"))).alias("l"))
    else:  # lines are told and dropped in compiled code; outer, as Spark would else split each text again to see that it has lines
        lines = structures.select("protein_id", F.posexplode_outer(text).alias("line_no", "line")).where(F.col("line").startswith("ATOM")).select("protein_id", F.struct("line_no", "line").alias("l"))
    return lines.select("protein_id", "l.line_no", pdb_fields(F.col("l.line")).alias("f")).select("protein_id", "line_no", "f.*")
