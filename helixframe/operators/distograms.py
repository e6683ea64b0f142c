"""Distances within chains: long form, packed matrices, histograms and box-plot bins."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import numbered

BINS = 100
#: Residue numbers of a block; a tile of the matrix is two blocks.
TILE = 256


#: Blocks of a stretch: a chain's residues are sent by stretches, and tiles are made of two where they meet.
STRETCH = 16


def _tiles(coords: DataFrame, tile: int, stretch: int = STRETCH) -> DataFrame:
    """protein_id, tile_i <= tile_j, and the residues of both blocks in order (rows, columns): array<struct<res_idx, x, y, z>> each.

    A chain is cut into blocks of `tile` residue numbers and stretches of `stretch` blocks. Every two stretches of it are one keyed group, so what
    a task holds is bounded by two stretches whatever the chain's length, and a residue is sent once for each stretch of its chain: once for a
    chain of one. The tiles of a group are made where it lies.
    """
    block, chain = lambda n: F.floor(n / tile).cast("int"), Window.partitionBy("protein_id")
    rows = coords.select("protein_id", F.floor(F.col("res_idx") / (tile * stretch)).cast("int").alias("own"), F.struct("res_idx", "x", "y", "z").alias("r"))
    # all up to the deal is within chains, so one exchange of rows serves it; the window is over stretches, not residues
    stretches = rows.repartition("protein_id").groupBy("protein_id", "own").agg(F.sort_array(F.collect_list("r")).alias("r"))
    ends = stretches.withColumns({"_lo": F.min("own").over(chain), "_hi": F.max("own").over(chain), "_b": F.array_distinct(F.transform("r", lambda x: block(x["res_idx"])))})
    cut = F.transform("_b", lambda b: F.named_struct(F.lit("block"), b, F.lit("a"), F.filter("r", lambda x: block(x["res_idx"]) == b)))
    dealt = ends.select("protein_id", "own", cut.alias("s"), F.explode(F.sequence("_lo", "_hi")).alias("other"))
    low, high = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    met = dealt.select("protein_id", low, high, F.struct("own", "s").alias("s")).repartition("protein_id", "i", "j").groupBy("protein_id", "i", "j").agg(F.array_sort(F.collect_list("s")).alias("b"))
    # stretches without residues leave a group with one stretch, unless it is the stretch's own
    both = met.where((F.size("b") == 2) | (F.col("i") == F.col("j"))).select("protein_id", F.get("b", F.lit(0))["s"].alias("rows"), F.element_at("b", -1)["s"].alias("columns"))
    pairs = both.select("protein_id", F.explode("rows").alias("p"), "columns").select("protein_id", "p", F.explode("columns").alias("q")).where("p.block <= q.block")
    return pairs.select("protein_id", F.col("p.block").alias("tile_i"), F.col("q.block").alias("tile_j"), F.col("p.a").alias("rows"), F.col("q.a").alias("columns"))


def _distance(a: str, b: str):
    return F.sqrt(sum(((F.col(f"{a}.{c}") - F.col(f"{b}.{c}")) * (F.col(f"{a}.{c}") - F.col(f"{b}.{c}")) for c in "xyz"), start=F.lit(0.0)))


def distogram(coords: DataFrame, max_distance: float | None = None, tile: int = TILE) -> DataFrame:
    """protein_id, i, j, d for i < j: Euclidean distance, null beside a gap. Chains of one residue give no pair.

    Pairs are made tile by tile. With max_distance, only pairs at most so far apart, found by cells of space (see contacts).
    """
    if max_distance is not None and max_distance < float("inf"):
        return contacts(coords, max_distance)
    pairs = _tiles(coords, tile).select("protein_id", F.explode("rows").alias("a"), "columns").select("protein_id", "a", F.explode("columns").alias("b")).where("a.res_idx < b.res_idx")
    rows = pairs.select("protein_id", F.col("a.res_idx").alias("i"), F.col("b.res_idx").alias("j"), _distance("a", "b").alias("d"))
    return rows if max_distance is None else rows.where(F.col("d") <= max_distance)


def contacts(coords: DataFrame, max_distance: float) -> DataFrame:
    """protein_id, i, j, d of the pairs at most max_distance apart.

    Space is cut into cells three times as wide. A residue is sent to its own cell and, on each axis, also to the cell below where that is near
    enough, so some two or three times instead of once for each neighbour. Two residues meet in the lower of their cells on every axis, and only there
    are they compared. The work grows with the residues and their neighbours, not with the square of a chain.
    """
    near = max(max_distance, 1e-3) * (1 + 1e-6)  # rounding never moves a pair beyond it
    cell = lambda c: F.floor(c / (3 * near))
    placed = coords.where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL").select("protein_id", "res_idx", "x", "y", "z", F.lit(0).alias("below"))
    for k, c in enumerate("xyz"):
        here, low = cell(F.col(c)), cell(F.col(c) - near)
        at = lambda v, below: F.struct(v.alias("v"), F.lit(below).alias("below"))
        spread = placed.select("*", F.explode(F.when(here == low, F.array(at(here, 0))).otherwise(F.array(at(here, 0), at(low, 1 << k)))).alias("_e"))
        placed = spread.select("protein_id", "res_idx", "x", "y", "z", F.col("below").bitwiseOR(F.col("_e.below")).alias("below"), *(f"_{d}" for d in "xyz"[:k]), F.col("_e.v").alias(f"_{c}"))
    keys = ("protein_id", "_x", "_y", "_z")
    a, b = placed.alias("a"), placed.alias("b")  # alike, so they are sent once
    met = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]).where((F.col("a.res_idx") < F.col("b.res_idx")) & (F.col("a.below").bitwiseAND(F.col("b.below")) == 0))
    return met.select("a.protein_id", F.col("a.res_idx").alias("i"), F.col("b.res_idx").alias("j"), _distance("a", "b").alias("d")).where(F.col("d") <= max_distance)


def tiled_distogram(coords: DataFrame, tile: int = TILE) -> DataFrame:
    """The symmetric matrix in tiles on and above the diagonal: protein_id, tile_i, tile_j, i and j (residue numbers of its rows and columns), d (by rows).

    Distances are 32-bit, zero on the diagonal and NaN beside gaps; chains of one residue are left out. No row holds more than tile^2 of them.
    """

    def pack(batches):
        for batch in batches:
            held, cells = [], 0
            for p, ti, tj, *sides in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3), batch.column(4)):
                (i, a), (j, b) = ((_numbers(s, "res_idx"), np.stack([_numbers(s, c) for c in "xyz"], axis=1)) for s in sides)
                m = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2)).astype(np.float32)
                m[i[:, None] == j[None]] = 0.0
                held.append((p, ti, tj, i.astype(np.int32), j.astype(np.int32), m.ravel()))
                cells += m.size
                if cells > 1 << 21:
                    yield _told(held)
                    held, cells = [], 0
            if held:
                yield _told(held)

    rows = _tiles(coords, tile).where((F.size("rows") > 1) | (F.size("columns") > 1) | (F.col("tile_i") != F.col("tile_j")))
    return rows.mapInArrow(pack, "protein_id string, tile_i int, tile_j int, i array<int>, j array<int>, d array<float>")


def _numbers(side: pa.Scalar, field: str) -> np.ndarray:
    """A field of a block's residues; what is absent is NaN. Coordinates go through 32 bits, as stored ones do."""
    found = side.values.field(field).to_numpy(zero_copy_only=False)
    return found if field == "res_idx" else found.astype(np.float32).astype(np.float64)


def _told(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float32())]
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["protein_id", "tile_i", "tile_j", "i", "j", "d"])


def packed_distogram(coords: DataFrame) -> DataFrame:
    """protein_id and the symmetric matrix as array<array<float>>: zero diagonal, NaN beside gaps; chains of one residue are left out.

    A matrix is one row, so this is for chains of ordinary length; tiled_distogram serves any.
    """

    def pack(batches):
        for pdf in batches:
            out = []
            for p, x, y, z in zip(pdf["protein_id"], pdf["x"], pdf["y"], pdf["z"]):
                v = np.stack([np.asarray(c, np.float32) for c in (x, y, z)], axis=1).astype(np.float64)
                m = np.sqrt(((v[:, None] - v[None]) ** 2).sum(axis=2)).astype(np.float32)
                np.fill_diagonal(m, 0.0)
                out.append((p, list(m)))
            yield pd.DataFrame(out, columns=["protein_id", "m"])

    rows = coords.groupBy("protein_id").agg(F.array_sort(F.collect_list(F.struct("res_idx", "x", "y", "z"))).alias("a")).where(F.size("a") > 1)
    one = lambda c: F.transform("a", lambda r: F.coalesce(r[c], F.lit(float("nan"))).cast("float")).alias(c)
    return rows.select("protein_id", one("x"), one("y"), one("z")).mapInPandas(pack, "protein_id string, m array<array<float>>")


def degenerate(coords: DataFrame) -> DataFrame:
    """Chains too short for a distogram."""
    return coords.groupBy("protein_id").agg(F.count("*").alias("n_res")).where("n_res <= 1")


def degenerate_matrices(proteins: DataFrame, coords: DataFrame) -> DataFrame:
    """protein_id and m of the proteins (protein_id) too short for a distogram: [[0]] without coordinates, [[1]] with one row."""
    n = proteins.select("protein_id").distinct().join(coords.groupBy("protein_id").agg(F.count("*").alias("n")), "protein_id", "left")
    only = lambda v: F.array(F.array(F.lit(v).cast("float")))
    return n.where("n IS NULL OR n <= 1").select("protein_id", F.when(F.col("n").isNull(), only(0)).otherwise(only(1)).alias("m"))


def by_max_distance(distances: DataFrame) -> DataFrame:
    """protein_id, max_d and place (from 0) of each protein in the order of its largest distance, then of its id; those without any are last."""
    largest = distances.groupBy("protein_id").agg(F.max("d").alias("max_d")).withColumn("_none", F.col("max_d").isNull())
    return numbered(largest, "_none", "max_d", "protein_id", name="place").drop("_none")


def _share(value: str, low: str, high: str, bins: int):
    return F.floor((F.col(value) - F.col(low)) / (F.col(high) - F.col(low)) * bins)


def histogram(distances: DataFrame, bins: int = BINS) -> DataFrame:
    """protein_id, bin, n, max_distance over equal bins from least to largest; the last is closed. All equal values fall into bin 0."""
    known = distances.where("d IS NOT NULL")
    spread = known.join(known.groupBy("protein_id").agg(F.min("d").alias("lo"), F.max("d").alias("hi")), "protein_id")
    b = F.when(F.col("hi") > F.col("lo"), F.least(_share("d", "lo", "hi", bins), F.lit(bins - 1))).otherwise(0).cast("long")
    return spread.groupBy("protein_id", b.alias("bin")).agg(F.count("*").alias("n"), F.max("hi").alias("max_distance"))


def box_bins(values: DataFrame, bins: int = 10) -> DataFrame:
    """bin, n, mean of half-open equal bins over all of column v; the largest value is in none.

    The bounds are one row, attached to every value.
    """
    ends = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    inside = values.crossJoin(F.broadcast(ends)).where("v < hi")
    return inside.groupBy(_share("v", "lo", "hi", bins).cast("long").alias("bin")).agg(F.count("*").alias("n"), F.avg("v").alias("mean"))
