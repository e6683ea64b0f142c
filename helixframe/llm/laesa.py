"""Vector code compression: product quantisation whose assignments are pruned by LAESA pivots.

Vectors become integers floor(1024 * x) and are cut into equal parts; each part position has a codebook of its own. A few
entries of each starting codebook, far from each other, are the position's pivots and stay fixed. The distance of every part
to its pivots is computed once and stored beside it. In each round only the distances between pivots and entries are new:
by the triangle inequality the largest difference of a part's and an entry's distances to a pivot bounds their distance from
below. Entries are taken in the order of that bound, and once the bound exceeds the best exact distance the rest of a part's
entries are never looked at. Distances that decide are exact integers, so pruning changes no result; bounds leave room for rounding.

A round is one pass over the stored parts: every task sums its parts by entry, and those sums (parts x 256 rows a task,
whatever its rows) are added by Spark. What the driver holds is the codebooks and those sums, of a size that depends on the dimension alone.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped, as are vectors not of the
commonest dimension; that dimension must be a multiple of the number of parts (else ValueError), and components
must lie within +-65536 (else an error, as sums wouldn't be exact). Repeated rows all count, in the starting codebook too;
with fewer than 256 rows the codebooks are as small. Null ids come last when the codebook starts. Null labels are one label.
Equal distances go to the lower index. An empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .vectors import finite_vectors, scaled

SCALE, MOST = 1024, 1 << 26
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Pivots of a part position.
PIVOTS = 16
#: Parts that a task looks at together, and how many entries are evaluated at a time, in the order of their bounds.
TOGETHER, STEPS = 4096, (2, 6, 16, 40, 64)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances between all rows of two small integer matrices."""
    d = x[:, None] - c[None]
    return (d * d).sum(axis=2)


def choose_pivots(book: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Entries of a codebook far from each other: each next one is farthest from those before, the first from the mean; ties to the lower index."""
    if not len(book):
        return book
    far = _squares(book, (book.sum(axis=0) // len(book))[None])[:, 0]
    chosen = [int(far.argmax())]
    near = _squares(book, book[chosen])[:, 0]
    while len(chosen) < min(count, len(book)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _squares(book, book[chosen[-1:]])[:, 0])
    return book[chosen]


def nearest_entries(x: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and exact squared distance of the nearest entry of each part, ties to the lower index; and how many exact distances that took.

    x: parts as integers; to_pivots: their stored distances to the pivots, as 32-bit floats.
    """
    from_entries = np.sqrt(_squares(book, pivots).astype(np.float64))
    # what rounding may have added to a bound
    slack = to_pivots.astype(np.float64).max(axis=1, initial=0) * 2.0**-22 + from_entries.max(initial=0) * 2.0**-40
    bound = np.zeros((len(x), len(book)))
    for p in range(pivots.shape[0]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - from_entries[None, :, p]), out=bound)
    bound = np.maximum(bound - slack[:, None], 0) ** 2 * (1 - 2.0**-40)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    best, index, live = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(book)), np.arange(len(x))
    done = lo = 0
    for step in (*STEPS, len(book)):
        hi = min(lo + step, len(book))
        if lo >= hi:
            break
        live = live[bound[live, lo] <= best[live]]
        if not len(live):
            break
        some = order[live, lo:hi]
        d = book[some] - x[live, None]
        d = np.einsum("ijk,ijk->ij", d, d)
        done += d.size
        least = d.min(axis=1)
        at = np.where(d == least[:, None], some, len(book)).min(axis=1)
        old, was = best[live], index[live]
        better = (least < old) | ((least == old) & (at < was))
        best[live], index[live] = np.where(better, least, old), np.where(better, at, was)
        lo = hi
    return index, best, done


def _parts(batch: pa.RecordBatch, at: int, parts: int, kind) -> np.ndarray:
    """A binary column as (rows, parts, values)."""
    return np.frombuffer(b"".join(batch.column(at).to_pylist()), kind).reshape(len(batch), parts, -1)


def with_pivot_distances(rows: DataFrame, dim: int, pivots: list[np.ndarray]) -> DataFrame:
    """vec_id, label, x (parts as 32-bit integers) and to_pivots (32-bit floats, by part and pivot) of the vectors, computed once."""
    parts, most = len(pivots), max(len(p) for p in pivots)

    def run(batches):
        for batch in batches:
            x = scaled(batch.column(2), dim, SCALE, MOST)
            held = np.zeros((len(x), parts, most), "<f4")
            for part, p in enumerate(np.split(x, parts, axis=1)):
                for k, pivot in enumerate(pivots[part]):
                    d = p - pivot
                    held[:, part, k] = np.sqrt(np.einsum("ij,ij->i", d, d).astype(np.float64))
            yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array([r.tobytes() for r in a], pa.binary()) for a in (x.astype("<i4"), held))], names=["vec_id", "label", "x", "to_pivots"])

    kind = dict(rows.dtypes)
    return rows.select("vec_id", "label", "vec").mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, x binary, to_pivots binary")


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], pivots: list[np.ndarray]):
    """For stretches of a batch: parts (rows, position, values), the entry of each part and its squared distance."""
    for lo in range(0, len(batch), TOGETHER):
        some = batch.slice(lo, TOGETHER)
        x, held = _parts(some, 2, len(books), "<i4").astype(np.int64), _parts(some, 3, len(books), "<f4")
        found = [nearest_entries(x[:, p], held[:, p, : len(pivots[p])], books[p], pivots[p]) for p in range(len(books))]
        yield x, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _entry_sums(books: list[np.ndarray], pivots: list[np.ndarray]):
    """Per task: count and sums of the parts of each entry in use."""
    width = books[0].shape[1]

    def run(batches):
        counts = np.zeros((len(books), len(books[0])), np.int64)
        sums = np.zeros((*counts.shape, width), np.int64)
        for batch in batches:
            for x, index, _ in _assigned(batch, books, pivots):
                for p in range(len(books)):
                    counts[p] += np.bincount(index[:, p], minlength=counts.shape[1])
                    for i in range(width):  # doubles hold the sums of so few exactly
                        sums[p, :, i] += np.bincount(index[:, p], x[:, p, i], minlength=counts.shape[1]).astype(np.int64)
        part, entry = np.nonzero(counts)
        columns = [part.astype(np.int32), entry.astype(np.int32), counts[part, entry], *sums[part, entry].T]
        yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

    return run


def starting_books(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """Per part position, that part of the vectors with the smallest ids; equal ids go by their vectors."""
    first = rows.select("vec_id", "vec").orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    x = scaled(pa.array([r["vec"] for r in first], pa.list_(pa.float64())), dim, SCALE, MOST)
    return np.split(x, parts, axis=1)


def _next_books(held: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round; entries without parts stay. As many rows reach the driver as the codebooks have entries."""
    sums = [f"s{i}" for i in range(books[0].shape[1])]
    told = held.mapInArrow(_entry_sums(books, pivots), "part int, entry int, n long, " + ", ".join(f"{s} long" for s in sums))
    new = [b.copy() for b in books]
    for r in told.groupBy("part", "entry").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", *sums))).collect():
        new[r["part"]][r["entry"]] = [int(r[s]) // int(r["n"]) for s in sums]
    return new


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code (bytes in part order) and error of the vectors (vec_id, embedding, label), and the codebooks by part."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index must fit one byte")
    rows, dim = finite_vectors(df, "vec_id", "label")
    kind = dict(rows.dtypes)
    schema = f"vec_id {kind['vec_id']}, label {kind['label']}, code binary, error long"
    if not dim:
        return df.sparkSession.createDataFrame([], schema), [np.zeros((0, 0), np.int64)] * parts
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    books = starting_books(rows, dim, parts, entries)
    pivots = [choose_pivots(b) for b in books]
    held = materialize(with_pivot_distances(rows, dim, pivots), "parts")
    for _ in range(rounds):
        books = _next_books(held, books, pivots)

    def encode(batches):
        for batch in batches:
            lo = 0
            for _, index, error in _assigned(batch, books, pivots):
                some, lo = batch.slice(lo, len(index)), lo + len(index)
                yield pa.record_batch([some.column(0), some.column(1), pa.array([r.tobytes() for r in index.astype(np.uint8)], pa.binary()), pa.array(error.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    return held.mapInArrow(encode, schema), books


def reconstruct(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id and approx (array<double>): the vectors that the codes stand for, in the original scale."""
    kind = dict(codes.dtypes)["vec_id"]

    def run(batches):
        for batch in batches:
            index = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(batch), -1)
            x = np.concatenate([b[index[:, p]] for p, b in enumerate(books)], axis=1) / SCALE
            yield pa.record_batch([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["vec_id", "approx"])

    return codes.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, approx array<double>")


def coded(df: DataFrame) -> DataFrame:
    """vec_id, code in hex, error, label_error and codebooks_sha256 of each vector that takes part."""
    codes, books = compress(df)
    codes = materialize(codes, "codes")
    label = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    rows = codes.join(label, F.col("label").eqNullSafe(F.col("__label")))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same rows without pruning: distances to all entries, in doubles that hold these integers exactly."""
    text = [
        "kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"parts AS MATERIALIZED (SELECT r, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x FROM kept, range({parts}) t(p))",
        f"book0 AS (SELECT p, r AS e, x AS c FROM parts WHERE r < {entries})",
    ]
    for k in range(rounds + 1):
        text.append(
            f"near{k} AS MATERIALIZED (SELECT parts.r, parts.p, any_value(x) AS x, min({{'d': list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), 'e': e}}) AS m FROM parts JOIN book{k} b ON parts.p = b.p GROUP BY parts.r, parts.p)"
        )
        if k < rounds:
            text.append(
                f"mean{k} AS (SELECT p, e, list(s ORDER BY i) AS c FROM (SELECT p, m.e AS e, i, floor(sum(x[i]) / count(*)) AS s FROM near{k}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) GROUP BY ALL) GROUP BY ALL)"
            )
            text.append(f"book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} n USING (p, e))")
    text.append(f"coded AS (SELECT r, string_agg(lower(printf('%02x', m.e)), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM near{rounds} GROUP BY r)")
    text.append(f"told AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS h FROM (SELECT p, e, array_to_string(list_transform(c, lambda v: v::BIGINT), ',') AS t FROM book{rounds}))")
    return f"WITH {', '.join(text)} SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256 FROM coded JOIN kept USING (r), told"
