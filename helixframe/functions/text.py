"""Column functions over ids, paths, ranges and fixed-width lines; all stay in the JVM."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .refdata import COLLECTIONS, DATABASES, LETTERS, NUCLEIC, SUBSTITUTIONS

RANGES = "array<struct<s:int,e:int>>"


def _table(values: dict[str, str]) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(values.items())))


def substitute(res_name: Column) -> Column:
    """The standard residue that stands for a modified one; others stay."""
    return F.coalesce(F.try_element_at(_table(SUBSTITUTIONS), res_name), res_name)


def letter(res_name: Column) -> Column:
    """One-letter code, X for unknown names."""
    return F.coalesce(F.try_element_at(_table(LETTERS), res_name), F.lit("X"))


def is_residue(res_name: Column) -> Column:
    return res_name.isin(list(LETTERS))


def is_nucleic(res_name: Column) -> Column:
    return F.trim(res_name).isin(list(NUCLEIC))


def null_text(c: Column) -> Column:
    """The text None is no value."""
    return F.nullif(c, F.lit("None"))


# --- ids and paths ----------------------------------------------------------------------------


def without_last_token(c: Column) -> Column:
    """The text before its last underscore; one without stays. No regular expression, as every id goes through it."""
    return F.when(c.contains("_"), F.left(c, F.length(c) - F.length(F.substring_index(c, "_", -1)) - 1)).otherwise(c)


def double_last_underscore(c: Column) -> Column:
    return F.regexp_replace(c, "_([^_]*)$", "__$1")


def full_id(base: Column, part: Column) -> Column:
    return F.when(part.isNotNull() & (part != "nan"), F.concat_ws("__", base, part)).otherwise(base)


def accession(file_name: Column) -> Column:
    """Accession in the name of a predicted model's file."""
    return F.regexp_replace(F.regexp_replace(file_name, r"-F1-model_v\d+$", ""), "^AF-", "")


def file_stem(name: Column) -> Column:
    return F.replace(F.replace(F.regexp_replace(name, "^.*/", ""), F.lit(".pdb"), F.lit("")), F.lit(".cif"), F.lit(""))


def folder_name(db: Column, collection: Column, slug: Column) -> Column:
    """Name of a dataset's folder."""
    return F.concat(db, F.lit("-"), collection, F.lit("--"), slug)


def folder_identity(name: Column) -> Column:
    """struct(db, collection, slug) of a dataset folder's name; nulls for another name."""
    pattern = f"^({'|'.join(DATABASES)})-({'|'.join(COLLECTIONS)})--(.+)$"
    return F.struct(*(_match(name, pattern, k).alias(n) for k, n in ((1, "db"), (2, "collection"), (3, "slug"))))


def with_folder(path: Column, folder: str) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), path)


def without_folder(path: Column, folder: str) -> Column:
    """The path relative to folder; one that isn't in it stays."""
    head = folder.rstrip("/") + "/"
    return F.when(path.startswith(head), F.substring(path, len(head) + 1, 1 << 20)).otherwise(path)


def lower_ids(c: Column) -> Column:
    return F.lower(F.trim(c))


def cores_of_name(name: Column) -> Column:
    """Number of cores in the name of a run's file, `run_b_64_x.html` or `run_64_x.html`; null if there is none."""
    return _match(name, r"(?:_b_|_)(\d+)_", 1).cast("int")


def times_in(log: Column, label: str) -> Column:
    """All seconds that stand after `label:` in a log, as array<double>."""
    found = F.regexp_extract_all(log, F.lit(label.replace("+", r"\+") + r":\s*([0-9.]+)"), F.lit(1))
    return F.transform(found, lambda x: x.try_cast("double"))


def _match(path: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


# The two layouts of dataset paths and the places of batch numbers in them.
def dataset_identity(path: Column) -> Column:
    """struct(db, collection, slug) of a dataset path in either layout; nulls if it has neither."""
    db, coll = "|".join(DATABASES), "|".join(COLLECTIONS)
    flat, nested = f"({db})-({coll})--([^/]+)", f"(?:^|/)structures/({db})/({coll})_/?([^/]+)/"
    whole = _match(path, flat, 1).isNotNull()
    pick = lambda k: F.when(whole, _match(path, flat, k)).otherwise(_match(path, nested, k))
    return F.struct(pick(1).alias("db"), pick(2).alias("collection"), pick(3).alias("slug"))


def batch_of_path(path: Column, index_type: Column) -> Column:
    """Batch number in a path, as text; both carbons of coordinates count."""
    db, coll = "|".join(DATABASES), "|".join(COLLECTIONS)
    return (
        F.when(index_type.isin("distograms", "embeddings"), _match(path, r"(?:^|/)(?:distograms|embeddings)/[^/]+/batch_(\d+)\.h5$", 1))
        .when(index_type == "coordinates", _match(path, r"(?:^|/)coordinates/[^/]+/batch_(\d+)_(?:ca|cb)\.h5$", 1))
        .when(index_type.isin("dataset", "structures"), _match(path, rf"(?:^|/)structures/(?:{db})/(?:{coll})_/?[^/]+/(\d+)/pdbs\.h5$", 1))
    )


# --- residue ranges ---------------------------------------------------------------------------


# The three messages, which callers compare.
def range_error(text: Column) -> Column:
    """What is wrong with the first bad range of `a-b;c-d`, or null."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda p: F.trim(p)), lambda p: p != "")

    def wrong(p: Column) -> Column:
        cut = F.split(p, "-", 2)
        a, b = F.trim(F.get(cut, F.lit(0))).try_cast("int"), F.trim(F.get(cut, F.lit(1))).try_cast("int")
        return (
            F.when(~p.contains("-"), F.lit("Range must contain '-'"))
            .when(a.isNull() | b.isNull(), F.lit("Range values must be integers"))
            .when(a > b, F.lit("Range start must be <= end"))
        )

    return F.get(F.filter(F.transform(parts, wrong), lambda e: e.isNotNull()), F.lit(0))


def parse_ranges(text: Column) -> Column:
    """array<struct<s,e>> of `a-b;c-d`, null for blank text; call range_error first where text may be bad."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda p: F.trim(p)), lambda p: p != "")

    def cut(p: Column) -> Column:
        x = F.split(p, "-", 2)
        return F.struct(F.trim(F.get(x, F.lit(0))).try_cast("int").alias("s"), F.trim(F.get(x, F.lit(1))).try_cast("int").alias("e"))

    return F.when(F.trim(text) != "", F.transform(parts, cut))


def in_ranges(n: Column, ranges: Column) -> Column:
    """Inclusive, any range; no ranges at all keep everything, an empty list keeps nothing."""
    return ranges.isNull() | F.exists(ranges, lambda r: n.between(r["s"], r["e"]))


# --- fixed-width lines ------------------------------------------------------------------------


def centred(c: Column, width: int) -> Column:
    """The text in the middle of `width`, the odd blank on the right."""
    gap = F.greatest(F.lit(width) - F.length(c), F.lit(0))
    left = F.floor(gap / 2).cast("int")
    return F.concat(F.repeat(F.lit(" "), left), c, F.repeat(F.lit(" "), (gap - left).cast("int")))


def _right(c: Column, width: int) -> Column:
    """Right-justified; longer text is kept."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, " "))


def pdb_line(record, serial, atom_name, res_name, chain_id, res_seq, icode, x, y, z, occupancy, b_factor, element, charge, last_serial: bool = False) -> Column:
    """A structure line from text columns, in the format's columns; values too wide are cut as the format asks.

    Of a serial number over 99999 the first five digits stay, or the last five, as in lines made from binary files.
    """
    cut = lambda c, w: F.lpad(c, w, " ")  # noqa: E731  right-justified; of longer text the first letters stay
    five = F.right(serial, F.lit(5)) if last_serial else serial
    left = lambda c, w: F.when(F.length(c) >= w, c).otherwise(F.rpad(c, w, " "))
    return F.concat(
        left(record, 6), cut(five, 5), F.lit(" "), centred(atom_name, 4), F.lit(" "), _right(res_name, 3), F.lit(" "),
        F.right(chain_id, F.lit(1)), cut(F.right(res_seq, F.lit(4)), 4), F.when(icode == "?", F.lit(" ")).otherwise(left(icode, 1)), F.lit("   "),
        *(cut(c, 8) for c in (x, y, z)), *(cut(c, 6) for c in (occupancy, b_factor)),
        F.lit(" " * 10), _right(element, 2), F.when(charge == "?", F.lit("  ")).otherwise(_right(charge, 2)),
    )


def pdb_fields(line: Column) -> Column:
    """The fields of a structure line; what can't be read is null."""
    part = lambda at, n: F.trim(F.substring(line, at + 1, n))
    return F.struct(
        part(0, 6).alias("record"),
        part(6, 5).try_cast("int").alias("serial"),
        part(12, 4).alias("atom_name"),
        part(17, 3).alias("res_name"),
        F.substring(line, 22, 1).alias("chain"),
        part(22, 4).try_cast("int").alias("res_seq"),
        F.substring(line, 27, 1).alias("icode"),
        *(part(at, 8).try_cast("double").alias(n) for n, at in (("x", 30), ("y", 38), ("z", 46))),
        part(54, 6).try_cast("double").alias("occupancy"),
        part(60, 6).try_cast("double").alias("b_factor"),
        part(76, 2).alias("element"),
    )


# --- study helpers ----------------------------------------------------------------------------


def seconds_of_duration(text: Column) -> Column:
    """Seconds of texts such as `1h 2m 3s` or `4ms`."""
    unit = lambda u, f: F.coalesce(F.try_element_at(F.regexp_extract_all(text, F.lit(rf"(\d+(?:\.\d+)?)\s*{u}\b"), F.lit(1)), F.lit(1)).try_cast("double"), F.lit(0.0)) * f
    return unit("h", 3600) + unit("m", 60) + unit("s", 1) + unit("ms", 0.001)


def percent_difference(a: Column, b: Column) -> Column:
    return F.try_divide(b - a, a) * 100


def readable_seconds(seconds: Column) -> Column:
    """`1h 2m 3s 4ms`, without the parts that are zero."""
    ms = F.round(seconds * 1000).cast("long")
    parts = [(F.floor(ms / 3_600_000), "h"), (F.floor(ms / 60_000) % 60, "m"), (F.floor(ms / 1000) % 60, "s"), (ms % 1000, "ms")]
    return F.concat_ws(" ", *(F.when(v > 0, F.concat(v.cast("string"), F.lit(u))) for v, u in parts))
