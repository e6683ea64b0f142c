"""The catalog of what datasets hold: index tables, reuse of what exists, work lists and statistics.

An index is a table (dataset_id, index_type, protein_id, path); its reverse is derived.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import null_text, without_last_token
from ..sources.staging import written
from .ordering import numbered


def newest_wins(index: DataFrame, key: str = "protein_id", value: str = "path", order: tuple[str, ...] = ("created_at", "dataset_id")) -> DataFrame:
    """For each key the value of the newest dataset; combines partially before the exchange."""
    return index.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def present_missing(requested: DataFrame, index: DataFrame, key: str = "protein_id") -> tuple[DataFrame, DataFrame]:
    """Requested keys with their path, and those that no dataset has."""
    held = index.select(key, "path")
    return requested.join(held, key), requested.join(held.select(key), key, "left_anti")


def expand_prefixes(requested: DataFrame, index: DataFrame, key: str = "protein_id") -> DataFrame:
    """requested (its key renamed `asked`), matched key and path: a short code stands for all its chains, an id with a chain for itself."""
    asked = requested.select(F.col(key).alias("asked")).distinct()
    exact = asked.join(index, F.col("asked") == F.col(key)).select("asked", key, "path")
    short = asked.where(~F.col("asked").contains("_"))
    chains = index.where(F.col(key).contains("_")).withColumn("code", without_last_token(F.col(key)))
    return exact.unionByName(short.join(chains, F.col("asked") == F.col("code")).select("asked", key, "path"))


def merge_right(old: DataFrame, new: DataFrame, key: str = "protein_id", value: str = "path") -> DataFrame:
    """old and new together; where both have a key, new counts."""
    both = old.select(key, value, F.lit(0).alias("_p")).unionByName(new.select(key, value, F.lit(1).alias("_p")))
    return both.groupBy(key).agg(F.max_by(value, "_p").alias(value))


def reverse_index(index: DataFrame, key: str = "protein_id", value: str = "path") -> DataFrame:
    return index.groupBy(value).agg(F.array_sort(F.collect_set(key)).alias(f"{key}s"))


def batches(ids: DataFrame, key: str, size: int, offset: int = 0) -> DataFrame:
    """ids with a batch number: chunks of `size` in order of key, counted from offset."""
    return numbered(ids, key, name="_rank").withColumn("batch", F.floor(F.col("_rank") / size) + offset).drop("_rank")


def batch_count(names: DataFrame) -> int:
    """How many folder names (name) are batch numbers."""
    return names.where(F.col("name").rlike("^[0-9]+$")).count()


def of_database(names: DataFrame, db: str, separator: str = "-", column: str = "name") -> DataFrame:
    """Dataset names of a database."""
    return names.where(F.col(column).startswith(db + separator))


def distinct_files(index: DataFrame) -> DataFrame:
    return index.select("path").distinct()


def missing_to_files(missing: DataFrame, files: DataFrame, key: str = "protein_id") -> tuple[DataFrame, DataFrame]:
    """The file (path) of each missing key, and the keys that have none, which a caller may take as an error."""
    held = files.select(key, "path")
    return missing.select(key).join(held, key), missing.select(key).join(held, key, "left_anti")


def grouped_missing(missing_files: DataFrame, key: str = "protein_id") -> DataFrame:
    """path and the sorted keys to be made from it: the work list of the next stage."""
    return missing_files.groupBy("path").agg(F.array_sort(F.collect_set(key)).alias(f"{key}s"))


class Plan(NamedTuple):
    """What a stage reuses (key, path), what it must make (key, path of its input), and keys without an input."""

    present: DataFrame
    work: DataFrame
    lost: DataFrame


def plan(requested: DataFrame, index: DataFrame, inputs: DataFrame, overwrite: bool = False, key: str = "protein_id") -> Plan:
    """Requested keys against what any dataset has and the inputs of those that none has; overwrite asks for everything anew."""
    present, missing = present_missing(requested.select(key).distinct(), index, key)
    if overwrite:
        present, missing = present.limit(0), requested.select(key).distinct()
    return Plan(present, *missing_to_files(missing, inputs, key))


def applies(index_type: Column, same_embedder: Column, same_carbon: Column, same_input: Column) -> Column:
    """Whether an index of a dataset can serve another with these settings alike."""
    return (
        F.when(index_type == "embeddings", same_embedder & same_carbon & same_input)
        .when(index_type.isin("coordinates", "sequences", "distograms"), same_carbon & same_input)
        .otherwise(same_input)
    )


def alike(a: Column, b: Column) -> Column:
    """Equal settings; the text None and null are the same."""
    return null_text(a).eqNullSafe(null_text(b))


def file_numbers(index: DataFrame) -> DataFrame:
    """path and file, a number from 0 without gaps, of each distinct path, in their order."""
    return numbered(index.where("path IS NOT NULL").select("path").distinct(), "path", name="file")


def file_bitmaps(index: DataFrame, files: DataFrame) -> DataFrame:
    """index_type, slug, batch, bucket, proteins and bits: which numbers of files (path, file) a group refers to, 32,768 to a row.

    Rows of other runs with the same numbers may be added: proteins add up, and bits are or-ed.
    """
    rows = index.withColumn("batch", F.coalesce(F.col("batch").cast("string"), F.lit("-"))).join(files, "path", "left")
    at = F.col("file")
    grouped = rows.groupBy("index_type", "slug", "batch", F.bitmap_bucket_number(at).alias("bucket"))
    return grouped.agg(F.count("protein_id").alias("proteins"), F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def bitmap_stats(bitmaps: DataFrame) -> DataFrame:
    """Proteins and distinct files of the groups of file_bitmaps at the four levels of index_stats."""
    out = None
    for level, by in enumerate((["index_type"], ["index_type", "slug"], ["index_type", "slug", "batch"], ["slug"])):
        once = bitmaps.groupBy(*by, "bucket").agg(F.sum("proteins").alias("proteins"), F.bitmap_count(F.bitmap_or_agg("bits")).alias("files"))
        sums = once.groupBy(*by).agg(F.sum("proteins").alias("proteins"), F.sum(F.when(F.col("bucket").isNotNull(), F.col("files")).otherwise(0)).alias("files"))
        names = [F.col(c) if c in by else F.lit(None).cast("string").alias(c) for c in ("index_type", "slug", "batch")]
        rows = sums.select(F.lit(level).alias("level"), *names, "proteins", "files")
        out = rows if out is None else out.unionByName(rows)
    return out


def index_stats(index: DataFrame) -> DataFrame:
    """Proteins and files by type, by type and dataset, by type, dataset and batch, and by dataset.

    index: index_type, slug, batch, path, protein_id. level is 0 to 3 in that order; a batch without number is `-`. Distinct files are
    counted exactly on bitmaps of file numbers, written once and merged from level to level, so rows aren't multiplied by levels.
    """
    return bitmap_stats(written(file_bitmaps(index, file_numbers(index)), "bitmaps"))


def referenced(index: DataFrame, own: str | None = None) -> DataFrame:
    """slug, files, proteins and is_self of each dataset that an index refers to; is_self is null until the own dataset is known."""
    is_self = F.lit(None).cast("boolean") if own is None else F.col("slug") == own
    return index.groupBy("slug").agg(F.countDistinct("path").alias("files"), F.count("protein_id").alias("proteins")).withColumn("is_self", is_self)


def top_referenced(index: DataFrame, n: int = 50, own: str | None = None) -> DataFrame:
    """The n datasets with most files, then proteins, then by name."""
    return referenced(index, own).orderBy(F.desc("files"), F.desc("proteins"), "slug").limit(n)


#: Wanted keys of an automaton, and their letters together.
AUTOMATON_KEYS, AUTOMATON_LETTERS = 200_000, 8_000_000


def _automaton(words: Iterable[str]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for w in words:
        a.add_word(w, True)
    a.make_automaton()
    return a


def _holds(a, texts: Iterable[str | None]) -> list[bool]:
    return [t is not None and next(a.iter(t), None) is not None for t in texts]


def containing(candidates: DataFrame, wanted: DataFrame, key: str = "id", keys: int = AUTOMATON_KEYS) -> DataFrame:
    """Candidates whose key contains any wanted key; empty wanted keys are none.

    Each candidate is read once by an automaton of the wanted keys. So many as fit one go with the task that reads the candidates.
    More are dealt over several automata by their first letters, and a candidate goes only to those whose letters it holds.
    """
    wanted = wanted.select(F.col(key).cast("string").alias("word")).where("word <> ''").distinct()
    n, letters, least = wanted.agg(F.count("*"), F.coalesce(F.sum(F.length("word")), F.lit(0)), F.min(F.length("word"))).first()
    if not n:
        return candidates.limit(0)
    parts = max(-(-n // keys), -(-letters // AUTOMATON_LETTERS))
    if parts == 1:
        words = [r[0] for r in wanted.collect()]  # no more than fit one automaton
        column = candidates.columns.index(key)

        def run(batches):
            a = _automaton(words)
            for batch in batches:
                yield batch.filter(pa.array(_holds(a, batch.column(column).to_pylist()), pa.bool_()))

        return candidates.mapInArrow(run, candidates.schema)
    return candidates.join(_dealt_hits(candidates.select(F.col(key).alias("word")).where("word IS NOT NULL").distinct(), wanted, parts, min(least, 8)).withColumnRenamed("word", key), key, "left_semi")


def _dealt_hits(candidates: DataFrame, wanted: DataFrame, parts: int, gram: int) -> DataFrame:
    """The candidates (word) that contain any of the wanted (word). A part of the wanted has its own automaton, in several tasks that share the part's candidates."""
    salts = max(1, int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")) // parts)
    part = lambda g: F.pmod(F.xxhash64(g), F.lit(parts))
    word = F.col("word")
    grams = F.transform(F.sequence(F.lit(1), F.length(word) - gram + 1), lambda i: part(F.substring(word, i, F.lit(gram))))
    asked = candidates.where(F.length(word) >= gram).select(F.explode(F.array_distinct(grams)).alias("part"), F.pmod(F.xxhash64(word), F.lit(salts)).alias("salt"), F.lit(1).alias("kind"), "word")
    given = wanted.select(part(F.left(word, F.lit(gram))).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), F.lit(0).alias("kind"), "word")
    # wanted keys come first, then the candidates stream past their automaton
    sorted_ = given.unionByName(asked).repartition("part", "salt").sortWithinPartitions("part", "salt", "kind")

    def run(batches):
        at, words, a = None, [], None
        for batch in batches:
            hits = []
            for p, s, kind, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (p, s) != at:
                    at, words, a = (p, s), [], None
                if kind == 0:
                    words.append(text)
                elif words:
                    a = a or _automaton(words)
                    hits += [text] if _holds(a, [text])[0] else []
            yield pa.record_batch([pa.array(hits, pa.string())], names=["word"])

    return sorted_.mapInArrow(run, "word string").distinct()


def match_inputs(requested: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requested ids (protein_id) with the stem of the file that holds them, and those without one.

    A file serves its own id and, where it names no chain, every chain of its code; its own id goes first.
    """
    stems = files.select("stem").distinct()
    keys = requested.select("protein_id", F.posexplode(F.array_distinct(F.array("protein_id", without_last_token(F.col("protein_id"))))).alias("p", "stem"))
    found = keys.join(stems, "stem").groupBy("protein_id").agg(F.min_by("stem", "p").alias("stem"))
    return found, requested.join(found, "protein_id", "left_anti")


def dataset_names(names: DataFrame, separator: str = "-") -> DataFrame:
    """db, collection, proteome, version of dataset folder names (name); other names are left out."""
    quoted = "".join("\\" + c for c in separator)
    parts = F.split("name", quoted, 4)
    rows = names.where(F.col("name").rlike(f"^[^{quoted}]*{quoted}.*{quoted}.*{quoted}.*$"))
    return rows.select("name", *(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(("db", "collection", "proteome", "version"))))
