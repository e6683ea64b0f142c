"""Readers: id lists, range files, FASTA, JSON indexes, structure files and archives; and the writers that match them."""

from __future__ import annotations

import io
import tarfile
import zipfile
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import file_stem, full_id, lower_ids, parse_ranges, range_error
from ..operators.catalog import containing
from .staging import written


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, lines as they are."""
    return spark.read.text(path).withColumnRenamed("value", "protein_id")


def simple_csv(spark: SparkSession, path: str, column: int = 0, header: bool = True) -> DataFrame:
    """Trimmed ids of one column, without empty cells; a row that is too short is an error."""
    names = spark.read.csv(path, header=header).columns
    if column >= len(names):
        raise ValueError(f"the file has {len(names)} columns, column {column} was asked for")
    # the reader gives null for an empty cell and for one that isn't there; only a row with the latter counts as corrupt
    schema = ", ".join(f"c{i} string" for i in range(len(names))) + ", corrupt string"
    rows = spark.read.option("columnPruning", "false").csv(path, header=header, schema=schema, columnNameOfCorruptRecord="corrupt")
    short = F.col(f"c{column}").isNull() & F.col("corrupt").isNotNull()
    value = F.when(short, F.raise_error(F.lit(f"a row has no column {column}"))).otherwise(F.trim(f"c{column}"))
    return rows.select(value.alias("protein_id")).where("protein_id <> ''")


def has_ranges(spark: SparkSession, path: str) -> bool:
    """Whether the first five lines look like ids with chains or residue ranges; a comma alone doesn't, so tables of several columns keep their header."""
    head = spark.read.text(path).limit(5).where(F.col("value").contains("__") | F.col("value").rlike(r",\s*(\d+\s*-\s*\d+.*)?$"))
    return not head.isEmpty()


def parse_range_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (line_no, base_id, chain, ranges, full_id) of lines (line_no, line), and bad lines with what is wrong.

    Blank lines and lines without a comma are skipped; a chain `nan` is none.
    """
    cut = F.split("line", ",", 2)
    name, text = F.trim(F.get(cut, F.lit(0))), F.trim(F.get(cut, F.lit(1)))
    parts = F.split(name, "__", 2)
    chain = F.nullif(F.trim(F.get(parts, F.lit(1))), F.lit("nan"))
    rows = lines.where((F.trim("line") != "") & F.col("line").contains(",")).select("line_no", "line", F.trim(F.get(parts, F.lit(0))).alias("base_id"), chain.alias("chain"), text.alias("text")).withColumn("error", range_error(F.col("text")))
    good = rows.where("error IS NULL").select("line_no", "base_id", "chain", parse_ranges(F.col("text")).alias("ranges"), full_id(F.col("base_id"), F.col("chain")).alias("full_id"))
    return good, rows.where("error IS NOT NULL").select("line_no", "line", "error")


def first_of_equal_ranges(entries: DataFrame) -> DataFrame:
    """Entries without those whose ranges, in any order, an earlier one has, whatever its id; entries without ranges all stay.

    The first line of each set of ranges is found by aggregation, so a set that many entries share is combined before it is sent.
    """
    keyed = entries.withColumn("_k", F.array_sort("ranges"))
    first = keyed.where("_k IS NOT NULL").groupBy("_k").agg(F.min("line_no").alias("line_no"))
    kept = keyed.join(first, ["_k", "line_no"], "left_semi")
    return kept.unionByName(keyed.where("_k IS NULL")).drop("_k")


def range_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Distinct entries and bad lines of a CSV file with residue ranges. Such a file is an id list of a person's making; it is read whole so that lines keep their order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))
    good, bad = parse_range_lines(lines)
    return first_of_equal_ranges(good), bad


#: Lines of a block that carries its header on its own.
BLOCK_LINES = 100_000


def parse_fasta(lines: DataFrame, block: Column | None = None) -> DataFrame:
    """protein_id and sequence of FASTA lines (file, line_no, line): the header's first word, the lines up to the next header joined.

    Files are cut into blocks of lines (block: a number that never falls with line_no; line_no / BLOCK_LINES where none is given). A block carries
    its own headers; what stands before its first one belongs to the last header of the blocks before it, which a running
    maximum over a row per block tells. So no task reads more than a block, however large the file; only pieces of sequences are put together.
    """
    cut = lines.withColumn("block", F.floor(F.col("line_no") / BLOCK_LINES) if block is None else block)
    begins = F.col("line").startswith(">")
    header = F.when(begins, F.struct("line_no", F.regexp_extract("line", r"^>(\S*)", 1).alias("protein_id")))
    carried = cut.withColumn("h", F.last(header, ignorenulls=True).over(Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)))
    body = F.when(~begins, F.struct("line_no", F.regexp_replace("line", r"\s", "").alias("s")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda p: p["s"]), "")
    pieces = carried.groupBy("file", "block", "h").agg(text.alias("s"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy("file", "block").agg(F.max(header).alias("last")).select("file", "block", F.last("last", ignorenulls=True).over(before).alias("earlier"))
    whole = pieces.join(ends, ["file", "block"]).select("file", F.coalesce("h", "earlier").alias("h"), F.struct("block", "s").alias("p")).where("h IS NOT NULL")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["s"]), "")
    return whole.groupBy("file", "h").agg(joined.alias("sequence")).select(F.col("h.protein_id").alias("protein_id"), "sequence")


def fasta(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Records of FASTA files; the reader cuts at headers, so files of any size are split. wanted: protein_id to keep."""
    records = spark.read.option("lineSep", "\n>").text(path)
    head = F.regexp_extract("value", r"^>?([^\s]*)", 1)
    rows = records.select(head.alias("protein_id"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "").alias("sequence")).where("protein_id <> ''")
    return rows if wanted is None else rows.join(wanted, "protein_id", "left_semi")


def write_fasta(sequences: DataFrame, path: str) -> None:
    sequences.select(F.concat(F.lit(">"), "protein_id", F.lit("\n"), "sequence")).write.mode("overwrite").text(path)


def json_index(spark: SparkSession, path: str, reverse: bool = False, lines: bool = False) -> DataFrame:
    """(protein_id, path) of a JSON index: an object, a list of pairs, or a reversed object of lists; lines: one of them on each line."""
    text = spark.read.text(path, wholetext=not lines)
    return index_items(text.withColumnRenamed("value", "json"), reverse)


def index_items(rows: DataFrame, reverse: bool = False, keep: tuple[str, ...] | str = ()) -> DataFrame:
    """(protein_id, path) of JSON indexes in column json, with the columns to keep."""
    more = [keep] if isinstance(keep, str) else list(keep)
    if reverse:
        flat = rows.select(*more, F.explode(F.from_json("json", "map<string,array<string>>")).alias("path", "ids"))
        return flat.select(*more, F.explode("ids").alias("protein_id"), "path")
    listed = F.col("json").rlike(r"^\s*\[")
    pairs = rows.where(listed).select(*more, F.explode(F.from_json("json", "array<array<string>>")).alias("p")).select(*more, F.get("p", F.lit(0)).alias("protein_id"), F.get("p", F.lit(1)).alias("path"))
    return rows.where(~listed).select(*more, F.explode(F.from_json("json", "map<string,string>")).alias("protein_id", "path")).unionByName(pairs)


def structure_files(spark: SparkSession, folder: str) -> DataFrame:
    """stem, kind and text of the *.pdb and *.cif files in a folder and its subfolders, one per stem: direct before nested, cif before pdb."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{pdb,cif}").text(folder, wholetext=True)
    at = F.col("_metadata.file_path")
    rows = files.select(at.alias("path"), "value").withColumn("stem", file_stem(F.col("path"))).withColumn("kind", F.regexp_extract("path", r"\.(\w+)$", 1))
    return prefer(rows.withColumn("depth", F.size(F.split("path", "/"))))


def prefer(rows: DataFrame) -> DataFrame:
    """stem, kind, text: of files (path, value, stem, kind, depth) of one stem cif wins over pdb, then the less deep, then the first path.

    The choice is made among names alone; texts are only kept or left out.
    """
    rank = F.struct(F.when(F.col("kind") == "cif", 0).otherwise(1), "depth", "path")
    best = rows.groupBy("stem").agg(F.min_by("path", rank).alias("path"))
    return rows.join(best, ["stem", "path"], "left_semi").select("stem", "kind", F.col("value").alias("text"))


def _open(path: str):
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    return system.open_input_file(at)


#: How a member lies in its archive: as it is, deflated, in another zip coding, or behind a compressed tar's stream.
STORED, DEFLATED, CODED, STREAMED = range(4)
LISTED = "path string, name string, at long, size long, packing int"
#: Bytes of an archive whose members one task reads together.
STRETCH = 64 << 20


def member_table(file) -> list[tuple[str, int, int, int]]:
    """(name, at, size, packing) of each file in a zip or tar archive, from its directory or its headers alone.

    A tar's headers stand before the members' bytes, which are leapt over. A compressed tar has to be read through.
    """
    if zipfile.is_zipfile(file):
        packing = {zipfile.ZIP_STORED: STORED, zipfile.ZIP_DEFLATED: DEFLATED}
        return [(i.filename, i.header_offset, i.compress_size, CODED if i.flag_bits & 1 else packing.get(i.compress_type, CODED)) for i in zipfile.ZipFile(file).infolist() if not i.is_dir()]
    file.seek(0)
    try:
        plain = tarfile.open(fileobj=file, mode="r:")
    except tarfile.ReadError:
        file.seek(0)
        return [(m.name, m.offset_data, m.size, STREAMED) for m in tarfile.open(fileobj=file, mode="r|*") if m.isfile()]
    return [(m.name, m.offset_data, m.size, CODED if m.sparse else STORED) for m in plain if m.isfile()]


def _is_zip(file) -> bool:
    file.seek(0)
    return file.read(2) == b"PK"


def _content(file, name: str, at: int, size: int, packing: int, is_zip: bool) -> bytes:
    """A member's bytes: read where it lies, whatever the archive's size."""
    if packing == CODED:
        if zipfile.is_zipfile(file):
            return zipfile.ZipFile(file).read(name)
        file.seek(0)
        return tarfile.open(fileobj=file).extractfile(name).read()
    file.seek(at)
    if is_zip:
        data = file.read(30 + len(name.encode()) + size)  # the local header, then the name and an extra field of their own lengths
        lo = 30 + int.from_bytes(data[26:28], "little") + int.from_bytes(data[28:30], "little")
        if lo + size > len(data):
            data += file.read(lo + size - len(data))
        data = data[lo : lo + size]
    else:
        data = file.read(size)
    return zlib.decompress(data, -15) if packing == DEFLATED else data


def _together(members):
    """(path, name, content) of members as record batches of a few megabytes; a larger member is one on its own."""
    held, size = [], 0
    for m in members:
        held.append(m)
        size += len(m[2])
        if size > 4 << 20 or len(held) == 1000:
            yield _members_batch(held)
            held, size = [], 0
    if held:
        yield _members_batch(held)


def _members_batch(held: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), (pa.string(), pa.string(), pa.binary()))], names=["path", "name", "content"])


def _listed(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with _open(path) as f:
                rows = member_table(f)
            for lo in range(0, len(rows), 10_000):
                names, *numbers = zip(*rows[lo : lo + 10_000])
                columns = [pa.array([path] * len(names)), pa.array(names), *(pa.array(n, pa.int64()) for n in numbers[:2]), pa.array(numbers[2], pa.int32())]
                yield pa.record_batch(columns, names=["path", "name", "at", "size", "packing"])


def _ranged(batches):
    """Rows are sorted by path and place, so an archive is opened once a task and read forwards."""
    held = file = None
    for batch in batches:
        for path, name, at, size, packing in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if path != held:
                if file is not None:
                    file.close()
                held, file = path, _open(path)
                is_zip = _is_zip(file)
            yield path, name, _content(file, name, at, size, packing, is_zip)


def _through(batches):
    """Members of compressed tars: all rows of an archive are in one task, which reads it through once."""
    wanted: dict[str, set[str]] = {}
    for batch in batches:
        for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            wanted.setdefault(path, set()).add(name)
    for path, names in wanted.items():
        with _open(path) as f:
            t = tarfile.open(fileobj=f, mode="r|*")
            for m in t:
                if m.name in names and m.isfile():
                    yield path, m.name, t.extractfile(m).read()


def _whole(batches):
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            file, is_zip = io.BytesIO(content), content[:2] == b"PK"
            for row in member_table(file):
                if row[3] == STREAMED:
                    file.seek(0)
                    yield path, row[0], tarfile.open(fileobj=file).extractfile(row[0]).read()
                else:
                    yield path, row[0], _content(file, *row, is_zip)


def _read(batches):
    return _together(_ranged(batches))


def _streamed(batches):
    return _together(_through(batches))


def _unpacked(batches):
    return _together(_whole(batches))


KINDS = ("pdb", "cif", "bcif")


def archives(spark: SparkSession, path: str, choose: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """path, stem, kind, content (bytes) of the structure files in zip and tar archives; choose tells which stems (stem) to read.

    Members are listed first, with where they lie, by reading an archive's directory or headers; then many tasks read each its
    own stretch of the archive. Only a compressed tar is read through, by one task. Stores that pyarrow.fs doesn't know are
    read whole by Spark: there a task unpacks an archive, and it must be under 2 GiB.
    """
    found = spark.read.format("binaryFile").load(path)
    kind = F.lower(F.substring_index("name", ".", -1))
    stem = F.regexp_replace(F.substring_index("name", "/", -1), r"\.(pdb|cif|bcif)", "")
    told = ["path", stem.alias("stem"), kind.alias("kind"), "content"]
    content = "path string, name string, content binary"
    first = found.select("path").first()
    try:
        if first is not None:
            _open(first["path"]).close()
    except (OSError, ValueError, ImportError, NotImplementedError):
        every = found.select("path", "content").mapInArrow(_unpacked, content).where(kind.isin(*KINDS)).select(*told)
        return every if choose is None else every.join(choose(every.select("stem").distinct()), "stem", "left_semi")
    # listed once; what chooses, what reads and whether there is a compressed tar are told from the list
    names = written(found.select("path").mapInArrow(_listed, LISTED).where(kind.isin(*KINDS)).withColumn("stem", stem), "members")
    compressed = not names.where(F.col("packing") == STREAMED).isEmpty()
    if choose is not None:
        names = names.join(choose(names.select("stem")), "stem", "left_semi")
    names = names.select(*(c.split()[0] for c in LISTED.split(", ")))
    ranged = names.where(F.col("packing") != STREAMED).repartition("path", F.floor(F.col("at") / STRETCH)).sortWithinPartitions("path", "at").mapInArrow(_read, content)
    if compressed:
        ranged = ranged.unionByName(names.where(F.col("packing") == STREAMED).repartition("path").mapInArrow(_streamed, content))
    return ranged.select(*told)


def lookup_entries(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """id, name of the entries of a compressed database's lookup file, second field of each line; entries of .cif files without a .pdb go.

    wanted (id): only entries whose name contains one of them.
    """
    lines = spark.read.text(path).where(~F.col("value").contains(".cif") | F.col("value").contains(".pdb"))
    names = lines.select(F.get(F.split(F.trim("value"), r"\s+"), F.lit(1)).alias("id")).where("id IS NOT NULL")
    return names if wanted is None else containing(names, wanted)


# Entry types that hold protein.
PROTEIN_TYPES = ("prot", "prot-nuc")


def of_entry_types(lines: DataFrame, types: tuple[str, ...] = PROTEIN_TYPES) -> DataFrame:
    """protein_id, in lower case, of lines (value) `id type ...` of a type file; lines of one field are left out."""
    f = F.split(F.trim("value"), r"\s+")
    return lines.where((F.size(f) >= 2) & F.get(f, F.lit(1)).isin(*types)).select(lower_ids(F.get(f, F.lit(0))).alias("protein_id"))


def entry_types(spark: SparkSession, path: str, types: tuple[str, ...] = PROTEIN_TYPES) -> DataFrame:
    return of_entry_types(spark.read.text(path), types)


def write_json_index(index: DataFrame, path: str, order: tuple[str, ...] = (), each: int = 10_000) -> None:
    """The index (protein_id, path) as JSON objects of some `each` ids, one on a line, and reversed beside it; json_index reads both with lines=True.

    Of rows with one id the last in `order` counts, then the greatest path, forwards and reversed alike.
    """
    rows = index.where("protein_id IS NOT NULL").groupBy("protein_id").agg(F.max_by("path", F.struct(*order, "path")).alias("path"))
    parts = max(1, rows.count() // each)
    pair = lambda k, v: F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v))))).alias("value")
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))
    rows.groupBy(part("protein_id")).agg(pair("protein_id", "path")).select("value").write.mode("overwrite").text(f"{path}.idx")
    back = rows.where("path IS NOT NULL").groupBy("path").agg(F.array_sort(F.collect_set("protein_id")).alias("ids"))
    back.groupBy(part("path")).agg(pair("path", "ids")).select("value").write.mode("overwrite").text(f"{path}_reversed.idx")


def write_structures(structures: DataFrame, path: str) -> None:
    """Structures as Parquet, a folder per dataset; a rerun replaces only its own datasets."""
    structures.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("dataset_id").parquet(path)


def read_structures(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if wanted is None else rows.join(wanted, "protein_id", "left_semi")
