"""Mixing sources to target weights by pivotal dependent rounding.

Sources in order of code point (null last) weigh 1, 2, 3, repeating, and share all words; no source is
taken more than ``most_repeats`` times, what is above goes to the others by weight. A document is to
be copied target/size times: the whole part always, the fraction by pivotal rounding. Two documents with
fractional probabilities p, q and sizes a, b trade words: one gains d/a, the other loses d/b, the way drawn
so that expectations stay, until one probability is 0 or 1. Words of a source are thus kept to one document's size.

First every bucket of documents (hash of the id) is rounded by itself and leaves one fractional document at most; these
residuals meet in a tree of `fan_in` buckets a node. Nothing else of a source is gathered anywhere.

Defined cases: null or empty text has size 0 and is taken 0 words; a null source is one source; rows with equal ids are
separate documents; an empty table gives no rows; extra columns are kept by ``mix`` and ignored by ``plan``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize
from .textkernels import Words, byte_column, chunks

WEIGHTS = (1.0, 2.0, 3.0)
MOST_REPEATS = 3.0
BUCKET_ROWS = 2_000
FAN_IN = 64


def word_count(batches):
    """Adds the number of white-space separated words of `text` to the other columns, which stay as they are."""
    import pyarrow as pa

    for batch in batches:
        data, off = byte_column(batch, "text")
        sizes = np.zeros(len(batch), np.int64)
        for lo, hi in chunks(off):
            sizes[lo:hi] = np.diff(Words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]).doc_off)
        rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
        yield pa.record_batch([*rest, pa.array(sizes)], names=[*(n for n in batch.schema.names if n != "text"), "size"])


def doc_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_bytes, text_hash and size of each document."""
    cols = docs.select(F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"), F.col("text").cast("binary").alias("text"))
    return cols.mapInArrow(word_count, "text_hash long, doc_id long, source string, n_bytes int, size long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target by water filling: sources fill up at equal words per weight until their cap.

    One row per source goes through the window; the corpus is summed before.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(MOST_REPEATS)
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").cast("binary").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = (
        per.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
        # the first source, in order of cap/weight, whose cap lies above the level sets it for all
        .withColumn("final", F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"])
    )
    return filled.select("source", "source_size", "source_docs", F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("final"))).alias("target"))


def pivotal(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Rounds p in order by pairs; at most one entry stays fractional. draw: a uniform number per entry."""
    p = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1) & (size > 0))
    if not len(open_):
        return p
    values, sizes, draws = p[open_].tolist(), size[open_].tolist(), draw[open_].tolist()
    i, x, a = 0, values[0], sizes[0]
    for j in range(1, len(open_)):
        y, b = values[j], sizes[j]
        up = min((1 - x) * a, y * b)  # words that x can gain from y
        down = min(x * a, (1 - y) * b)
        if draws[j] * (up + down) < down:
            full, empty = up == (1 - x) * a, up == y * b
            x, y = (1.0 if full else x + up / a), (0.0 if empty else y - up / b)
        else:
            empty, full = down == x * a, down == (1 - y) * b
            x, y = (0.0 if empty else x - down / a), (1.0 if full else y + down / b)
        if 0 < x < 1:
            values[j] = y
        else:
            values[i], i, x, a = x, j, y, b
    values[i] = x
    p[open_] = values
    return p


def _uniform(*cols: Column) -> Column:
    return (F.xxhash64(*cols).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).cast("double")


def _round(pdf: pd.DataFrame) -> pd.DataFrame:
    # large documents first: what stays open after them trades with ever smaller ones, so little is left over
    pdf = pdf.assign(down=-pdf["size"]).sort_values(["down", "order", "doc_id", "copy"], kind="stable").drop(columns="down")
    pdf["p"] = pivotal(pdf["p"].to_numpy(), pdf["size"].to_numpy(), pdf["draw"].to_numpy())
    return pdf


def round_copies(rows: DataFrame, n_buckets: int, seed: int = 7) -> DataFrame:
    """Replaces the fraction `p` of each row by 0 or 1. rows: source, doc_id, size, copy, p, and source_docs."""
    schema = "source string, doc_id long, size long, copy long, p double, node long, order long, draw double"
    names = [x.split()[0] for x in schema.split(", ")]

    def level(df: DataFrame, k: int) -> DataFrame:
        df = df.withColumn("draw", _uniform(F.col("doc_id"), F.col("copy"), F.col("size"), F.lit(seed + k)))
        return df.select(*names).groupBy("source", "node").applyInPandas(_round, schema)

    node = F.pmod(F.xxhash64("doc_id", "copy", F.lit(seed)), F.greatest(F.lit(1), F.ceil(F.col("source_docs") / BUCKET_ROWS)))
    state = rows.withColumn("node", node.cast("long")).withColumn("order", F.xxhash64("doc_id", F.lit(seed + 99)))
    state = materialize(level(state, 0), "pivotal")
    done, k = [state.where("p in (0, 1)")], 1
    state = state.where("p not in (0, 1)")
    while n_buckets > 1:
        n_buckets = -(-n_buckets // FAN_IN)
        state = state.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long")).withColumn("order", F.xxhash64("doc_id", F.lit(seed + 99 + k)))
        state = materialize(level(state, k), "pivotal")
        done.append(state.where("p in (0, 1)"))
        state, k = state.where("p not in (0, 1)"), k + 1
    # one document of a source may stay fractional: it is drawn by itself
    last = state.withColumn("p", (_uniform(F.col("doc_id"), F.col("copy"), F.lit(seed - 1)) < F.col("p")).cast("double"))
    for part in done:
        last = last.unionByName(part)
    return last.select("source", "doc_id", "size", "copy", "p")


def _source_key(name: str = "source") -> Column:
    """Equal for equal sources, nulls included."""
    return F.struct(F.col(name).isNull(), F.coalesce(F.col(name), F.lit("")))


def _split_ratio(df: DataFrame) -> DataFrame:
    """Whole and fractional copies of each word; within 1e-12 of a whole number counts as whole."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ratio = F.when(F.abs(ratio - F.round(ratio)) < 1e-12, F.round(ratio)).otherwise(ratio)
    return df.withColumn("whole", F.floor(ratio).cast("long")).withColumn("p", ratio - F.floor(ratio))


def _numbered(df: DataFrame, name: str, n_bytes: Column, text_hash: Column) -> DataFrame:
    """Numbers rows of equal ids by length, source and a hash of the text, so that reruns agree."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy("doc_id").orderBy(n_bytes, "source", text_hash)).cast("long"))


def plan(docs: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, source, copy, size, source_size, target, copies, taken of each document.

    copy tells rows with equal ids apart.
    """
    sizes = materialize(_numbered(doc_sizes(docs), "copy", F.col("n_bytes"), F.col("text_hash")).drop("n_bytes", "text_hash"), "sizes")
    goal = materialize(_split_ratio(targets(sizes)), "targets")
    most = goal.agg(F.max("source_docs")).first()[0] or 0
    goal = goal.withColumn("k", _source_key())
    # goal has a row per source: adaptive execution broadcasts it if it is small and splits hot sources if not
    wide = sizes.join(goal.drop("source"), _source_key() == F.col("k")).withColumn("p", F.when(F.col("size") > 0, F.col("p")).otherwise(F.lit(0.0)))
    rounded = round_copies(wide, max(1, -(-most // BUCKET_ROWS)), seed)
    rounded = rounded.join(goal.drop("source", "p"), _source_key() == F.col("k"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("p").cast("long")).otherwise(F.lit(0).cast("long"))
    return rounded.withColumn("copies", copies).select("doc_id", "source", "copy", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mixed corpus: each row of docs as often as the plan takes it; documents without words are left out."""
    taken = plan(docs, seed).where("copies > 0").groupBy(F.col("doc_id").alias("__id")).agg(F.map_from_entries(F.collect_list(F.struct("copy", "copies"))).alias("__copies"))
    numbered = _numbered(docs, "__copy", F.coalesce(F.octet_length("text"), F.lit(0)), F.xxhash64(F.col("text").cast("string")))
    times = numbered.join(taken, F.col("doc_id").eqNullSafe(F.col("__id"))).withColumn("__n", F.try_element_at("__copies", F.col("__copy"))).where("__n > 0")
    return times.withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*docs.columns)
