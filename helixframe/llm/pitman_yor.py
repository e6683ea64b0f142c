"""Language-model scores by a hierarchical Pitman-Yor model.

A token is drawn in the restaurant of the word before it; all these restaurants share one parent, over all
words, whose own base is uniform. Every word that stands before a training token has a restaurant; after other words the
parent is all there is. Customers are the training tokens. In a sweep of Gibbs sampling the customers of every dish leave their restaurant
and are seated anew given all who stay there and in the parent; the predictive probabilities are averaged over the sweeps that follow the burn-in.
Which customers share a table doesn't matter to a probability, only the number of tables does: its conditional is the number of arrangements (a generalised
Stirling number) times the chances of the tables, and is drawn from as it is. One half of the dishes moves at a time, all dishes of a half at once.

Layout: texts are cut into blocks of documents. A block keeps its tokens as numbers of its distinct words. Words go to
fragments by their 64-bit hashes. A fragment first numbers its words, most frequent first, adds up their training tokens,
which are also the customers of their restaurants, and gives both back to the blocks; the number and the fragment make the id
of a word. Then the distinct (context, word) pairs go, packed, to the fragments of their words, where all customers of a word
are seated. The fragments give the seating back to the blocks, and the tables
of each restaurant to the fragment of its context, which adds them up for the blocks. Blocks then score their documents.
The pairs of a word with very many tokens are spread over several fragments by their contexts; only those words, at most
one per HOT_TOKENS, and the sums of the parent reach the driver.

Tables of a restaurant in other fragments are taken in proportion to its customers (within 5 %) while seating, and so are the
tables of a spread word; sums are exact when scoring. A dish's tables in the parent stay as they are while one restaurant's tables are drawn.
Customers of a dish beyond EXACT_CUSTOMERS in one restaurant are seated in order with the limit of that conditional (means within 5 % of it).

Defined cases: null and empty texts are the end token alone; rows with equal ids are separate documents; a null id counts as
training; without training documents the model is the uniform base; an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize
from .textkernels import U64, Words, byte_column, chunks, mix

BLOCK_TOKENS = 2_000_000
FRAGMENT_BYTES = 24_000_000
#: A word is spread over one more fragment for each so many training tokens.
HOT_TOKENS = 1_000_000
#: Customers of a dish in a restaurant up to whom their tables are drawn from the exact conditional.
EXACT_CUSTOMERS = 255
END = mix(np.array([0xE0D], U64))[0]


class Settings(NamedTuple):
    discount: float = 0.8  # of the context restaurants
    strength: float = 2.0
    root_discount: float = 0.6
    root_strength: float = 10.0
    burn_in: int = 2
    sweeps: int = 3
    seed: int = 11


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


class _Tokens:
    """Tokens of a run of documents: words by hash, each document closed by END."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        w = Words(data, off)
        self.tokens = np.insert(w.hashes(), w.doc_off[1:], END)
        self.sizes = np.diff(w.doc_off) + 1


def _runs(batches, most: int):
    """Documents in runs of about `most` tokens: ids, tokens, sizes."""
    ids, parts, n = [], [], 0
    for batch in batches:
        data, off = byte_column(batch, "text")
        names = batch.column(0).to_pylist()
        for lo, hi in chunks(off):
            t = _Tokens(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            ids += names[lo:hi]
            parts.append(t)
            n += len(t.tokens)
            if n >= most:
                yield ids, np.concatenate([x.tokens for x in parts]), np.concatenate([x.sizes for x in parts])
                ids, parts, n = [], [], 0
    if parts:
        yield ids, np.concatenate([x.tokens for x in parts]), np.concatenate([x.sizes for x in parts])


def _pack(a: np.ndarray) -> bytes:
    """Compressed byte by byte of the numbers: first all lowest bytes."""
    return zstandard.ZstdCompressor(3).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _unpack(b: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _home(words: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of each word; rises with the hash."""
    return (((words >> U64(32)) * U64(fragments)) >> U64(32)).astype(np.int64)


class Hot(NamedTuple):
    ids: np.ndarray  # sorted
    counts: np.ndarray
    parts: np.ndarray

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words are hot, and their numbers here."""
        if not len(self.ids):
            return np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return self.ids[at] == ids, at


def _pairs(stream: np.ndarray, n_words: int):
    """Word and context of each distinct pair of a block, by word, and the pair of each token."""
    w = stream.astype(np.int64)
    before = np.empty_like(w)
    before[0], before[1:] = w[-1], w[:-1]  # the last token is END, which also stands before a document
    pair, pairs = np.unique(w * n_words + before, return_inverse=True)
    of_word, context = np.divmod(pair, n_words)
    return of_word, context, pairs


def _deal(ids: np.ndarray, of_word: np.ndarray, context: np.ndarray, hot: Hot, fragments: int):
    """Order of a block's pairs by fragment; where each word of each fragment begins in it; the words and fragments that begin there."""
    frag = (ids % fragments)[of_word]
    is_hot, at = hot.find(ids)
    if is_hot.any():
        mine = np.flatnonzero(is_hot[of_word])
        part = mix(ids[context[mine]].astype(U64)) % hot.parts[at[of_word[mine]]].astype(U64)
        frag[mine] = (frag[mine] + part.astype(np.int64)) % fragments
        order = np.argsort(frag, kind="stable")
    else:
        order = np.arange(len(frag))
    f, w = frag[order], of_word[order]
    first = np.flatnonzero(np.concatenate(([True], (f[1:] != f[:-1]) | (w[1:] != w[:-1]))))
    return order, first, w[first], f[first]


BLOCKS = "block long, frag int, ids binary, sizes binary, tokens binary, words binary, uses binary"


def _blocks(fragments: int):
    """A row per block (frag null): documents and their tokens; a row per block and fragment: words and their training tokens."""
    schema = pa.schema([("block", pa.int64()), ("frag", pa.int32()), *((x, pa.binary()) for x in ("ids", "sizes", "tokens", "words", "uses"))])

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for ids, tokens, sizes in _runs(batches, BLOCK_TOKENS):
            words, w = np.unique(tokens, return_inverse=True)
            uses = np.bincount(w, np.repeat(np.array([not held_out(d) for d in ids]), sizes), minlength=len(words)).astype("<u4")
            blank = np.array([d is None for d in ids])
            known = np.array([0 if d is None else d for d in ids], "<i8")
            yield pa.RecordBatch.from_pylist([{"block": number, "ids": known.tobytes() + blank.tobytes(), "sizes": sizes.astype("<u4").tobytes(), "tokens": _pack(w.astype("<u4"))}], schema=schema)
            cut = np.searchsorted(_home(words, fragments), np.arange(fragments + 1))
            rows = [{"block": number, "frag": f, "words": words[a:b].astype("<u8").tobytes(), "uses": _pack(uses[a:b])} for f, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if a < b]
            for lo in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[lo : lo + 64], schema=schema)
            number += 1

    return run


def _documents(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, whether it is null, and number of tokens of the documents of a block."""
    n = len(row["sizes"]) // 4
    return np.frombuffer(row["ids"][: 8 * n], "<i8"), np.frombuffer(row["ids"][8 * n :], bool), np.frombuffer(row["sizes"], "<u4").astype(np.int64)


def _held(ids: np.ndarray, blank: np.ndarray) -> np.ndarray:
    return np.array([not b and held_out(int(d)) for d, b in zip(ids, blank)], bool)


def _column(values: tuple, kind: str) -> pd.Series:
    """Integers stay integers where some are missing."""
    if kind not in ("int", "long"):
        return pd.Series(values, dtype="float64" if kind == "double" else "object")
    missing = np.array([v is None for v in values], bool)
    return pd.Series(pd.arrays.IntegerArray(np.array([0 if v is None else v for v in values], np.int64), missing))


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    kinds = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pd.DataFrame({name: _column(c, kind) for (name, kind), c in zip(kinds, columns)})


KNOWN = "block long, frag int, ranks binary, known binary, id long, n long, distinct long"


def _count(hot_tokens: int, fragments: int):
    """In one fragment: numbers and training tokens of its words for each block, sums of all (id null), and the hot words."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        frag = int(pdf["frag"].iloc[0])
        parts = [np.frombuffer(x, "<u8") for x in pdf["words"]]
        word, w = np.unique(np.concatenate(parts), return_inverse=True)
        n = np.bincount(w, np.concatenate([_unpack(x, "<u4") for x in pdf["uses"]]), minlength=len(word)).astype(np.int64)
        rank = np.empty(len(word), np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(word))
        rows, a = [], 0
        for block, ws in zip(pdf["block"], parts):
            mine = w[a : a + len(ws)]
            rows.append((block, frag, _pack(rank[mine].astype("<u4")), _pack(n[mine].astype("<u4")), None, None, None))
            a += len(ws)
        rows.append((-1, frag, None, None, None, int(n.sum()), int((n > 0).sum())))
        rows += [(-1, frag, None, None, int(rank[i]) * fragments + frag, int(n[i]), None) for i in np.flatnonzero(n >= hot_tokens)]
        return _frame(rows, KNOWN)

    return run


def _words(known: pd.DataFrame, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and training tokens of a block's words, from its rows in the order of fragments."""
    ids = [_unpack(r, "<u4").astype(np.int64) * fragments + int(f) for f, r in zip(known["frag"], known["ranks"])]
    return np.concatenate(ids), np.concatenate([_unpack(x, "<u4") for x in known["known"]])


PARTS = "block long, frag int, words binary, spread binary, contexts binary, customers binary, counts binary"


def _parts(hot: Hot, fragments: int):
    """The pairs of a block for each fragment: words, pairs of each, contexts with their restaurants' customers in eighths of an octave, counts."""

    def run(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = []
        ids, n = _words(known.sort_values("frag"), fragments)
        octaves = np.where(n > 0, 1 + np.rint(7.9 * np.log2(np.maximum(n, 1))), 0).astype(np.uint8)
        for _, row in docs.iterrows():
            doc_ids, blank, sizes = _documents(row)
            of_word, context, pairs = _pairs(_unpack(row["tokens"], "<u4"), len(ids))
            counts = np.bincount(pairs, np.repeat(~_held(doc_ids, blank), sizes), minlength=len(of_word)).astype("<u4")
            order, first, dealt, frag = _deal(ids, of_word, context, hot, fragments)
            context, counts = context[order], counts[order]
            ends = np.append(first, len(order))
            cut = np.searchsorted(frag, np.arange(fragments + 1))
            for f, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                if a < b:
                    x, y = ends[a], ends[b]
                    rows.append((row["block"], f, _pack(ids[dealt[a:b]]), _pack(np.diff(ends[a : b + 1]).astype("<u4")), _pack(ids[context[x:y]]), _pack(octaves[context[x:y]]), _pack(counts[x:y])))
        return _frame(rows, PARTS)

    return run


@lru_cache(4)
def _log_stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: weights of all arrangements of c customers at t tables, for c up to EXACT_CUSTOMERS."""
    out = np.full((EXACT_CUSTOMERS + 1, EXACT_CUSTOMERS + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, EXACT_CUSTOMERS):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            stays = out[c, 1 : c + 2] + np.log(np.maximum(c - discount * t, 0))
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], stays)
    return out


class Others(NamedTuple):
    """What stays when all customers of a dish leave a restaurant, for each dish."""

    opens: np.ndarray  # strength + discount * tables of the other dishes
    base: float  # what the dish gets in the parent beside its customers
    above: np.ndarray | None = None  # customers of the dish in the parent, without those of these tables; None: base is all
    taken: np.ndarray | None = None  # discounts of its tables there
    total: np.ndarray | None = None  # all of the parent, without these tables

    def after(self, rows: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What opens a table, without those of the dish, and the parent's probability of it, for rows and numbers of tables before."""
        of = lambda x: x[rows].reshape(-1, 1)
        above = self.base if self.above is None else (np.maximum(of(self.above) + k - of(self.taken), 0) + self.base) / (of(self.total) + k)
        return of(self.opens), above


def _later(n, c: np.ndarray, t, growth: np.ndarray, discount: float) -> np.ndarray:
    """What is to come after n of c customers with t tables weighs about so many times as much with a table more; the solution where n is large."""
    shift = discount * t + (1 + discount) / 2
    return 1 / (growth + (1 - growth) * ((c - shift) / (n - shift)) ** discount)


def reseat(c: np.ndarray, others: Others, discount: float, rng: np.random.Generator, exact: int = EXACT_CUSTOMERS) -> np.ndarray:
    """Tables of c customers of each dish, who leave their restaurant together and are seated anew given all who stay there and in the parent.

    A draw from the conditional probabilities themselves for up to `exact` customers. Of more, so many are drawn like this with what is to come
    in mind and the rest follows in order, groups of a 32nd of those seated at once.
    """
    t = np.minimum(c, 1).astype(float)
    arrangements = _log_stirling(discount)
    order = np.argsort(c, kind="stable")
    cut = np.append(np.searchsorted(c[order], np.arange(2, exact + 2)), len(c))
    for n, (lo, hi) in enumerate(zip(cut[:-1], cut[1:]), 2):
        many, n = n > exact, min(n, exact)
        step, k = max(1, 500_000 // n), np.arange(n)
        for at in range(lo, hi, step):
            rows = order[at : min(at + step, hi)]
            opens, above = others.after(rows, k)
            weight = (opens + discount * k) * above
            if many:
                slope = weight[:, 1] - weight[:, 0]
                growth = np.clip(slope / discount, 0, 1)
                weight = weight * _later(n, c[rows], 1, growth, discount).reshape(-1, 1)
            p = arrangements[n, 1 : n + 1] + np.cumsum(np.log(weight), axis=1)
            p = np.cumsum(np.exp(p - p.max(axis=1, keepdims=True)), axis=1)
            t[rows] = 1 + (p < rng.random((len(rows), 1)) * p[:, -1:]).sum(axis=1)
            if many:
                t[rows] = _follow(n, t[rows], c[rows], opens[:, 0] * (above[:, 0] if np.ndim(above) else above), growth, discount, rng)
    return t


def _follow(seated: int, t: np.ndarray, c: np.ndarray, first: np.ndarray, growth: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of c customers of each dish, of whom the first sit at t tables; a table beside t weighs first + growth * discount * t."""
    n = np.full(len(c), float(seated))
    open_ = np.arange(len(c))
    while len(open_):
        size, tables = n[open_], t[open_]
        group = np.minimum(np.maximum(np.floor(size / 32), 1), c[open_] - size)
        weight = (first[open_] + growth[open_] * discount * tables) * _later(size + 1, c[open_], tables, growth[open_], discount)
        t[open_] += rng.binomial(group.astype(np.int64), np.clip(weight / (weight + size - discount * tables), 0, 1))
        n[open_] += group
        open_ = open_[n[open_] < c[open_]]
    return t


SEATING = "block long, frag int, source int, root binary, own binary, contexts binary, tables binary, id long, c0 double, t0 double"
FOR_CONTEXTS, FOR_HOT, FOR_ROOT = -1, -2, -3  # in place of the block


def _restaurants(hot: Hot, total: int, distinct: int, fragments: int, s: Settings):
    """In one fragment: seat the customers of its pairs; give blocks the seating, fragments of contexts their tables, and the driver the sums of the parent."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        frag = int(pdf["frag"].iloc[0])
        parts = [[_unpack(x, kind) for x in pdf[name]] for name, kind in (("words", "<i8"), ("spread", "<u4"), ("contexts", "<i8"), ("customers", "u1"), ("counts", "<u4"))]
        words, spread, contexts, restaurant, counts = (np.concatenate(p) for p in parts)
        word, w = np.unique(words, return_inverse=True)
        contexts, x = np.unique(contexts, return_inverse=True)
        customers = np.zeros(len(contexts))
        customers[x] = np.where(restaurant > 0, np.rint(2 ** ((restaurant - 1.0) / 7.9)), 0)
        pair, k = np.unique(np.repeat(w, spread) * len(contexts) + x, return_inverse=True)
        c = np.bincount(k, counts, minlength=len(pair))
        of_word, ctx = np.divmod(pair, len(contexts))
        known = np.bincount(of_word, c, minlength=len(word))
        is_hot, at = hot.find(word)
        whole = np.ones(len(word))  # customers of a word anywhere to those here
        share = np.ones(len(word))  # of a word that counts as being here
        if is_hot.any():
            whole[is_hot] = hot.counts[at[is_hot]] / np.maximum(known[is_hot], 1)
            share[is_hot] = 1 / hot.parts[at[is_hot]]
        scale = np.maximum(customers / np.maximum(np.bincount(ctx, c, minlength=len(contexts)), 1), 1.0)
        beyond = distinct / max(float(share[known > 0].sum()), 1e-9)
        rng = np.random.default_rng([s.seed, frag])
        t = np.minimum(c, 1.0)
        t0 = np.minimum(known, 1.0)
        mean_own, mean_c0, mean_t0, tables = np.zeros(len(pair)), np.zeros(len(word)), np.zeros(len(word)), np.zeros(len(contexts))
        open_ = (s.root_strength + s.root_discount * distinct) / (distinct + 1)
        halves = rng.integers(0, 2, len(pair))
        for sweep in range(s.burn_in + s.sweeps):
            for half in (0, 1):  # the dishes of one half move given where the other half's customers sit now
                mine = np.flatnonzero(halves == half)
                c0 = np.bincount(of_word, t, minlength=len(word))
                all0 = max(c0.sum() / max(known.sum(), 1.0) * total, 1.0)
                own, w_, x_ = t[mine], of_word[mine], ctx[mine]
                room = (np.bincount(ctx, t, minlength=len(contexts)) * scale)[x_] - own
                above = np.maximum((c0 * whole)[w_] - own, 0)
                taken = s.root_discount * np.maximum(np.minimum(t0[w_], above), 1)
                others = Others(s.strength + s.discount * room, open_, above, taken, s.root_strength + np.maximum(all0 - own, 0))
                t[mine] = reseat(c[mine].astype(np.int64), others, s.discount, rng)
            c0 = np.bincount(of_word, t, minlength=len(word))
            tables0 = s.root_strength + s.root_discount * np.maximum((t0 * share).sum() * beyond - t0, 0)
            t0 = reseat(np.round(c0 * whole).astype(np.int64), Others(tables0, 1 / (distinct + 1)), s.root_discount, rng)
            if sweep >= s.burn_in:
                mean_own += (c - s.discount * t) / s.sweeps
                mean_c0 += c0 / s.sweeps
                mean_t0 += t0 / s.sweeps
                tables += np.bincount(ctx, t, minlength=len(contexts)) / s.sweeps
        root = (mean_c0 - s.root_discount * mean_t0).astype("<f4")
        rows, a, i = [], 0, 0
        for block, ws, cs in zip(pdf["block"], parts[0], parts[2]):
            b, j = a + len(ws), i + len(cs)
            rows.append((block, frag, frag, _pack(root[w[a:b]]), _pack(mean_own[k[i:j]].astype("<f4")), None, None, None, None, None))
            a, i = b, j
        rank, home = np.divmod(contexts, fragments)
        seen = np.flatnonzero(tables > 0)
        seen = seen[np.argsort(home[seen], kind="stable")]
        cut = np.searchsorted(home[seen], np.arange(fragments + 1))
        for f, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if a < b:
                rows.append((FOR_CONTEXTS, f, frag, None, None, _pack(rank[seen[a:b]].astype("<u4")), _pack(tables[seen[a:b]].astype("<f4")), None, None, None))
        for i in np.flatnonzero(is_hot & (known > 0)):
            rows.append((FOR_HOT, frag, frag, None, None, None, None, int(word[i]), mean_c0[i], mean_t0[i]))
        rows.append((FOR_ROOT, frag, frag, None, None, None, None, None, mean_c0[~is_hot].sum(), mean_t0[~is_hot].sum()))
        return _frame(rows, SEATING)

    return run


TABLES = "block long, frag int, tables binary"


def _add_tables(seating: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """In one fragment: the tables of its words' restaurants, over all fragments, for each block with such words."""
    tables, asked = np.zeros(0), [_unpack(x, "<u4") for x in known["ranks"]]
    seating = seating.sort_values("source")
    if asked:
        tables = np.zeros(1 + max(int(x.max()) for x in asked))
        for contexts, t in zip(seating["contexts"], seating["tables"]):
            tables[_unpack(contexts, "<u4")] += _unpack(t, "<f4")
    return _frame([(block, frag, _pack(tables[x].astype("<f4"))) for block, frag, x in zip(known["block"], known["frag"], asked)], TABLES)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class Root(NamedTuple):
    customers: float
    tables: float
    of_hot: np.ndarray  # customers less the discounts of the tables, of each hot word


def _score(hot: Hot, root_sums: Root, total: int, distinct: int, fragments: int, s: Settings):
    base_of = 1.0 / (distinct + 1)

    def run(docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        replies = replies.sort_values("frag")
        ids, known = _words(replies[replies["known"].notna()], fragments)
        known = known.astype(float)
        tables, roots, own_dealt = (np.concatenate([_unpack(x, "<f4") for x in replies[name].dropna()]).astype(float) for name in ("tables", "root", "own"))
        for _, row in docs.iterrows():
            doc_ids, blank, sizes = _documents(row)
            of_word, ctx, pairs = _pairs(_unpack(row["tokens"], "<u4"), len(ids))
            order, _, dealt, _ = _deal(ids, of_word, ctx, hot, fragments)
            own, root = np.empty(len(ctx)), np.empty(len(ids))
            own[order], root[dealt] = own_dealt, roots
            is_hot, at = hot.find(ids)
            if is_hot.any():
                root[is_hot] = root_sums.of_hot[at[is_hot]]
            p0 = (root + (s.root_strength + s.root_discount * root_sums.tables) * base_of) / (s.root_strength + root_sums.customers)
            p = (own + (s.strength + s.discount * tables[ctx]) * p0[of_word]) / (s.strength + known[ctx])
            plain = np.log10((known + 0.5) / (total + 0.5 * (distinct + 1)))
            start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            add = lambda per_pair: np.add.reduceat(per_pair[pairs], start)
            out.append(pd.DataFrame({
                "doc_id": pd.Series(doc_ids).astype("Int64").where(~blank), "held_out": _held(doc_ids, blank), "n_tokens": sizes,
                "n_known": add((known > 0).astype(np.int64)[of_word]), "train_tokens": int(total), "base_score": add(plain[of_word]), "score": add(np.log10(p)),
            }))
        return pd.concat(out) if out else pd.DataFrame(columns=[f.split()[0] for f in SCORES.split(", ")])

    return run


def scores(docs: DataFrame, settings: Settings = Settings(), fragment_bytes: int = FRAGMENT_BYTES, hot_tokens: int = HOT_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    fragments = max(16, -(-size // fragment_bytes))
    blocks = materialize(texts.mapInArrow(_blocks(fragments), BLOCKS), "blocks", "zstd")
    asked = blocks.where("frag IS NOT NULL").select("block", "frag", "words", "uses")
    held = blocks.where("frag IS NULL").select("block", "ids", "sizes", "tokens")
    known = materialize(asked.groupBy("frag").applyInPandas(_count(hot_tokens, fragments), KNOWN), "known", "zstd")
    sums = known.where("block < 0 AND id IS NULL").agg(F.sum("n").alias("n"), F.sum("distinct").alias("distinct")).first()
    total, distinct = sums["n"] or 0, sums["distinct"] or 0
    found = np.array(sorted(map(tuple, known.where("id IS NOT NULL").select("id", "n").collect())), np.int64).reshape(-1, 2)
    hot = Hot(found[:, 0], found[:, 1], np.minimum(-(-found[:, 1] // hot_tokens), fragments))
    known = known.where("block >= 0").select("block", "frag", "ranks", "known")
    parts = held.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(_parts(hot, fragments), PARTS)
    seating = materialize(parts.groupBy("frag").applyInPandas(_restaurants(hot, total, distinct, fragments, settings), SEATING), "seating", "zstd")
    rest = sorted(map(tuple, seating.where(F.col("block") == FOR_ROOT).select("frag", "c0", "t0").collect()))
    of_hot = {}
    for i, _, c0, t0 in sorted(map(tuple, seating.where(F.col("block") == FOR_HOT).select("id", "source", "c0", "t0").collect())):
        of_hot.setdefault(i, []).append((c0, t0))
    c0, t0 = (np.array([f([x[k] for x in of_hot[int(i)]]) for i in hot.ids], float) for k, f in enumerate((np.sum, np.mean)))
    root = Root(sum(r[1] for r in rest) + c0.sum(), sum(r[2] for r in rest) + t0.sum(), c0 - settings.root_discount * t0)
    given = seating.where(F.col("block") == FOR_CONTEXTS).select("frag", "source", "contexts", "tables")
    tables = given.groupBy("frag").cogroup(known.select("block", "frag", "ranks").groupBy("frag")).applyInPandas(_add_tables, TABLES)
    replies = seating.where("block >= 0").select("block", "frag", "root", "own").unionByName(known, True).unionByName(tables, True)
    return held.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(_score(hot, root, total, distinct, fragments, settings), SCORES)
