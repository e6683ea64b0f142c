"""Suffix-array deduplication: every byte within a string that starts at two places is removed.

A rule says what counts: strings of ``least`` symbols, which are bytes or words (A-Z lower-cased, white space doesn't
matter), with the second place in another document or the same. ``BYTES`` is 400 bytes, ``PASSAGES`` 50 words.

Places to compare are found by anchors: in each window of ``least`` symbols the gram with the smallest hash is one, so
equal windows have the same anchor at the same offset. Anchors whose gram occurs once are dropped. An anchor's
context holds every window around it; equal contexts (by hash) match throughout. Where contexts of one gram
differ, one of each kind is fetched as bytes and put into an enhanced suffix array: the suffixes from the gram on, sorted, with
their common prefixes. A stack scan gives the common-prefix interval tree; in every interval the left
sides, sorted by their reversed symbols, show where a common string can't be extended to the left for
all, which makes it a maximal repeat with all its occurrences. Those of ``least`` symbols and more cover what goes.

Work per gram is linear in its distinct contexts times the depth of its tree. Grams with more than ``ARRAY_CONTEXTS`` of them
(the ends of a passage that very many documents share) would fill one task; their suffix array is sorted by
range over many tasks, once by right and once by left sides. In either order each context is held against its ``NEARBY`` neighbours
on both sides, and the common prefix where these end tells how much any other could still give. Contexts for which
that is more than was found are rare; all windows of their grams are hashed and counted, which gives the same bytes.

Defined cases: null and empty texts lose nothing; equal rows, also with equal ids, are repeats of each other and are both
removed where long enough; null ids stay; an empty table gives no rows; extra columns are
dropped by ``removed_bytes`` and kept by ``without_repeats``.
"""

from __future__ import annotations

from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, materialize
from .textkernels import U64, Words, byte_column, chunks, prefix_sums, symbol_sums, window_hash


class Rule(NamedTuple):
    """Which strings count as repeated: of at least so many symbols, found by grams of so many."""

    least: int
    gram: int
    words: bool = False

    @property
    def width(self) -> int:
        """Bytes of a symbol in a suffix array: a word stands there as its hash."""
        return 8 if self.words else 1


BYTES = Rule(400, 64)
PASSAGES = Rule(50, 8, words=True)
#: Distinct contexts of a gram up to which one task builds their suffix array.
ARRAY_CONTEXTS = 4096
#: Neighbours on either side that a context of a larger gram is held against.
NEARBY = 16
#: Sorted contexts that are compared at a time.
RUN_ROWS = 4096
#: Bits of a position in a chunk; a text has less than 2 GiB.
_POS = U64((1 << 31) - 1)


def of_bytes(least: int) -> Rule:
    return Rule(least, min(BYTES.gram, max(1, least // 4)))


class _Symbols:
    """The symbols of a chunk of texts: hash sums, where each text begins, and the bytes where each symbol begins and ends."""

    def __init__(self, data: np.ndarray, off: np.ndarray, rule: Rule):
        if rule.words:
            w = Words(data, off)
            self.sums, self.off, self._words = symbol_sums(w.hashes()), w.doc_off, w
        else:
            self.sums, self.off, self._words = prefix_sums(data), off, None

    def begin(self, at: np.ndarray) -> np.ndarray:
        return at if self._words is None else self._words.start[at]

    def end(self, at: np.ndarray) -> np.ndarray:
        """Of the symbol before each place."""
        return at if self._words is None else self._words.end[at - 1]


def anchors(sums: np.ndarray, off: np.ndarray, least: int, gram: int) -> np.ndarray:
    """Positions of the anchors of texts laid end to end, as symbols; no window crosses texts."""
    n = len(sums) - gram
    span = least - gram + 1
    if n < span:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    x = (window_hash(sums, at, at + gram) & ~_POS) | at.astype(U64)
    pad = -n % span
    blocks = np.concatenate((x, np.full(pad, ~U64(0), U64))).reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least_in = np.minimum(back[: n - span + 1], ahead[span - 1 : n])
    valid = np.zeros(n - span + 1, bool)
    sizes = np.diff(off)
    for a, m in zip(off[:-1][sizes >= least].tolist(), sizes[sizes >= least].tolist()):
        valid[a : a + m - least + 1] = True
    chosen = (least_in & _POS).astype(np.int64)[valid]
    return np.unique(chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))]) if len(chosen) else chosen


OCCURRENCES = "key long, gram long, context long, n int, pos int, before int, after int, spans array<struct<start:int,end:int>>"


def _occurrences(rule: Rule):
    """A row per text, gram and context: how often, the first place, the context's sides, and the merged spans of all its places, in bytes.

    A periodic text has one context at very many places, which are one row and one span here.
    """
    least, gram = rule.least, rule.gram
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, off = byte_column(batch, "text")
            for lo, hi in chunks(off):
                o = off[lo : hi + 1] - off[lo]
                symbols = _Symbols(data[off[lo] : off[hi]], o, rule)
                p = anchors(symbols.sums, symbols.off, least, gram)
                doc = np.searchsorted(symbols.off, p, "right") - 1
                left, right = np.minimum(p - symbols.off[doc], least - gram), np.minimum(symbols.off[doc + 1] - p, least)
                context = window_hash(symbols.sums, p - left, p + right) + (left * 1000 + right).astype(U64) * U64(0x9E3779B97F4A7C15)
                seed = window_hash(symbols.sums, p, p + gram)
                order = np.lexsort((p, context, seed, doc))
                doc, seed, context, p, left, right = (x[order] for x in (doc, seed, context, p, left, right))
                new = np.ones(len(p), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (seed[1:] != seed[:-1]) | (context[1:] != context[:-1])
                opens = new.copy()
                opens[1:] |= p[1:] - left[1:] > p[:-1] + right[:-1]
                first, begin = np.flatnonzero(new), np.flatnonzero(opens)
                last = np.append(begin[1:], len(p))[: len(begin)] - 1
                at = symbols.begin(p) - o[doc]
                from_, to = symbols.begin(p - left) - o[doc], symbols.end(p + right) - o[doc]
                spans = pa.StructArray.from_arrays([pa.array(from_[begin].astype(np.int32)), pa.array(to[last].astype(np.int32))], fields=list(span))
                lists = pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(begin, first), len(begin)).astype(np.int32)), spans)
                cols = [keys[lo:hi][doc[first]], seed[first].view(np.int64), context[first].view(np.int64), np.diff(np.append(first, len(p))).astype(np.int32), at[first].astype(np.int32), (at - from_)[first].astype(np.int32), (to - at)[first].astype(np.int32)]
                yield pa.record_batch([*(pa.array(c) for c in cols), lists], names=["key", "gram", "context", "n", "pos", "before", "after", "spans"])

    return run


def _common(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of rows."""
    m = np.minimum(la, lb)
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, m)


def _matrix(rows: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)


def _neighbours(group: np.ndarray, rows: list[bytes], unit: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, bytes) and, for each place in it, the common prefix with the place before in symbols (-1 at a new group)."""
    width = max(map(len, rows), default=1) or 1
    order = np.array(sorted(range(len(rows)), key=lambda i: (group[i], rows[i])), np.int64)
    size = np.array([len(rows[i]) for i in order], np.int64)
    common = np.full(len(order), -1, np.int64)
    for lo in range(1, len(order), 4096):
        hi = min(lo + 4096, len(order))
        m = _matrix([rows[i] for i in order[lo - 1 : hi]], width)
        common[lo:hi] = _common(m[1:], m[:-1], size[lo:hi], size[lo - 1 : hi - 1]) // unit
    g = group[order]
    common[1:][g[1:] != g[:-1]] = -1
    return order, common


def maximal_repeats(group: np.ndarray, left: list[bytes], right: list[bytes], least: int, unit: int = 1) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(right length, members, left lengths) of the maximal repeats of at least `least` symbols around a common point.

    left and right are what stands before and from each point on, in symbols of `unit` bytes; only members of one group are
    compared. A repeat is found at the deepest interval of the tree that has it; for a member, what a longer left side already gave isn't given again.
    """
    order, lcp = _neighbours(group, right, unit)
    back, lcs = _neighbours(group, [x[::-1] for x in left], unit)
    rank = np.empty(len(back), np.int64)
    rank[back] = np.arange(len(back))
    rank = rank[order]  # by place in the suffix array
    best = np.full(len(order), -1, np.int64)  # longest left side given so far, by place
    out = []

    def close(lo: int, hi: int, depth: int) -> None:
        r = rank[lo:hi]
        by_left = np.argsort(r, kind="stable")
        r = r[by_left]
        if r[-1] - r[0] == len(r) - 1:
            between = lcs[r[0] + 1 : r[-1] + 1]
        else:
            cuts = np.stack((r[:-1] + 1, r[1:] + 1), axis=1).ravel()
            between = np.minimum.reduceat(np.append(lcs, -1), cuts)[::2]
        # a side is as long as the closer of the two neighbours allows
        side = np.maximum(np.append(between, -1), np.insert(between, 0, -1))
        places = lo + by_left
        new = (side + depth >= least) & (side > best[places])
        if new.any():
            best[places[new]] = side[new]
            out.append((depth, order[places[new]], side[new]))

    stack: list[list[int]] = []  # open intervals: first place, depth
    values = np.append(lcp[1:], -1).tolist()
    for i, d in enumerate(values):
        first = i
        while stack and stack[-1][1] > d:
            first, depth = stack.pop()
            close(first, i + 1, depth)
        if d >= 0 and (not stack or stack[-1][1] < d):
            stack.append([first, d])
    return out


def _by_word(texts: list[bytes]) -> tuple[list[bytes], list[np.ndarray], list[np.ndarray]]:
    """Each text as hashes of its words, and where its words begin and end."""
    off = np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)
    w = Words(np.frombuffer(b"".join(texts), np.uint8), off)
    h = w.hashes()
    cut = list(zip(w.doc_off[:-1].tolist(), w.doc_off[1:].tolist()))
    return [h[a:b].tobytes() for a, b in cut], [w.start[a:b] - o for (a, b), o in zip(cut, off)], [w.end[a:b] - o for (a, b), o in zip(cut, off)]


FETCHED = "gram", "key", "pos", "left", "right"


def _match(rule: Rule):
    """Spans of contexts that stand sorted by gram; a gram's rows may lie in several batches."""
    schema = pa.schema([("key", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def solve(rows: list[tuple]):
        rows = list({(r[0], r[1], r[2]): r for r in rows}.values())
        gram = np.array([r[0] for r in rows], np.int64)
        left, right = [r[3] for r in rows], [r[4] for r in rows]
        if rule.words:
            left, begin, _ = _by_word(left)
            right, _, end = _by_word(right)
        found = maximal_repeats(gram, left, right, rule.least, rule.width)
        key, start, stop = [], [], []
        for depth, members, side in found:
            for i, s in zip(members.tolist(), side.tolist()):
                key.append(rows[i][1])
                before, after = s, depth
                if rule.words:
                    before, after = len(rows[i][3]) - int(begin[i][-s]) if s else 0, int(end[i][depth - 1])
                start.append(rows[i][2] - before)
                stop.append(rows[i][2] + after)
        return pa.record_batch([pa.array(key, pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], schema=schema)

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            held += list(zip(*(batch.column(i).to_pylist() for i in range(5))))
            if len(held) >= 20_000:
                last = held[-1][0]
                cut = len(held)
                while cut and held[cut - 1][0] == last:
                    cut -= 1
                if cut:
                    yield solve(held[:cut])
                    held = held[cut:]
        if held:
            yield solve(held)

    return run


PLACED = "gram long, key long, pos int, near binary, far binary, part int, first boolean, last boolean"


def _placed(rule: Rule, by_right: bool):
    """Both sides of contexts as symbols, left ones backwards: near is the side to sort by."""

    def run(batches):
        for batch in batches:
            left, right = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            if rule.words:
                left, right = _by_word(left)[0], _by_word(right)[0]
            left = [x[::-1] for x in left]
            near, far = (right, left) if by_right else (left, right)
            yield pa.record_batch([*(batch.column(i) for i in range(3)), pa.array(near, pa.binary()), pa.array(far, pa.binary())], names=["gram", "key", "pos", "near", "far"])

    return run


def _edges(batches):
    """Rows of a sorted partition with its number; the first and last NEARBY are marked."""
    part, n, held = TaskContext.get().partitionId(), 0, None

    def told(rows: pa.Table, last: bool):
        nonlocal n
        at = n + np.arange(len(rows))
        n += len(rows)
        flags = [pa.array(np.full(len(rows), part, np.int32)), pa.array(at < NEARBY), pa.array(np.full(len(rows), last))]
        return pa.Table.from_arrays([*(rows.column(i) for i in range(5)), *flags], names=[f.split()[0] for f in PLACED.split(", ")]).combine_chunks().to_batches()

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if len(held) > NEARBY:
            yield from told(held.slice(0, len(held) - NEARBY), False)
            held = held.slice(len(held) - NEARBY)
    if held is not None:
        yield from told(held, True)


FOUND = "gram long, key long, pos int, near_most int, far_most int, bound int"


def _nearby(rule: Rule, parts: int):
    """For each context of a part, against its neighbours in order: the longest near and far sides of strings that it has in common with any,
    and the longest near side that it can have in common with contexts that it wasn't held against."""
    schema = pa.schema([(f.split()[0], {"long": pa.int64(), "int": pa.int32()}[f.split()[1]]) for f in FOUND.split(", ")])

    def solve(rows: list[tuple], skip: int, opens: bool, closes: bool):
        """skip: rows of the run before; opens and closes: whether the run is the part's first and last."""
        gram = np.array([r[0] for r in rows], np.int64)
        near, far = [r[3] for r in rows], [r[4] for r in rows]
        own = np.array([r[6] for r in rows], bool)
        own[:skip] = False
        if not closes:
            own[len(rows) - NEARBY - 1 :] = False
        n, part = len(rows), rows[0][5]
        size = lambda side: np.array([len(x) for x in side], np.int64)
        wide = lambda side: max(map(len, side), default=1) or 1
        a, b, la, lb = _matrix(near, wide(near)), _matrix(far, wide(far)), size(near), size(far)
        step = _common(a[1:], a[:-1], la[1:], la[:-1]) // rule.width
        step[gram[1:] != gram[:-1]] = -1
        near_most, far_most, bound = np.full(n, -1), np.full(n, -1), np.full(n, -1)
        common = np.full(n, 1 << 30)  # of each row with the one k before
        for k in range(1, NEARBY + 2):
            if k >= n:
                break
            common = np.minimum(common[1:], step[: n - k]) if k > 1 else step.copy()
            met = np.flatnonzero(common >= 0)
            if not len(met):
                break
            if k == NEARBY + 1:
                np.maximum.at(bound, met, common[met])
                np.maximum.at(bound, met + k, common[met])
                break
            other = _common(b[met], b[met + k], lb[met], lb[met + k]) // rule.width
            fits = common[met] + other >= rule.least
            for at in (met[fits], met[fits] + k):
                near_most[at] = np.maximum(near_most[at], common[met][fits])
                far_most[at] = np.maximum(far_most[at], other[fits])
        # rows whose neighbours end with what this part can see: no row beyond has more in common than the last one seen
        if opens and part > 0:
            reach = np.minimum.accumulate(np.concatenate(([1 << 30], step)))[: NEARBY + 1]
            bound[: len(reach)] = np.maximum(bound[: len(reach)], np.minimum(reach, a.shape[1]))
        if closes and part < parts - 1:
            reach = np.minimum.accumulate(np.concatenate((step, [1 << 30]))[::-1])[: NEARBY + 1][::-1]
            bound[n - len(reach) :] = np.maximum(bound[n - len(reach) :], np.minimum(reach, a.shape[1]))
        kept = [rows[i] for i in np.flatnonzero(own)]
        cols = [[r[0] for r in kept], [r[1] for r in kept], [r[2] for r in kept], *(x[own].astype(np.int32) for x in (near_most, far_most, bound))]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    def run(batches):
        held: list[tuple] = []
        skip, opens = 0, True
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if held and held[-1][5] != r[5]:
                    yield solve(held, skip, opens, True)
                    held, skip, opens = [], 0, True
                elif len(held) >= RUN_ROWS + 2 * (NEARBY + 1):
                    yield solve(held, skip, opens, False)
                    # the last NEARBY + 1 rows wait for their neighbours, and as many before them are theirs
                    held, skip, opens = held[-2 * (NEARBY + 1) :], NEARBY + 1, False
                held.append(r)
        if held:
            yield solve(held, skip, opens, True)

    return run


def _sorted_sides(hot: DataFrame, rule: Rule, by_right: bool) -> DataFrame:
    """What _nearby finds for contexts in one order."""
    sides = hot.select(*FETCHED).mapInArrow(_placed(rule, by_right), "gram long, key long, pos int, near binary, far binary")
    order = "gram", "near", "far", "key", "pos"
    rows = sides.repartitionByRange(1 + hot.count() // (4 * RUN_ROWS), *order).sortWithinPartitions(*order).mapInArrow(_edges, PLACED)
    rows = materialize(rows, "sorted", "zstd")
    parts = sorted(r[0] for r in rows.select("part").distinct().collect())  # one number per task
    rank = F.array_position(F.array(*map(F.lit, parts)), F.col("part")).cast("int") - 1
    ranked = rows.withColumn("part", rank)
    see = lambda df, shift, own: df.withColumn("part", F.col("part") + shift).select("gram", "key", "pos", "near", "far", "part", F.lit(own).alias("own"))
    seen = see(ranked, 0, True).unionByName(see(ranked.where("last"), 1, False)).unionByName(see(ranked.where("first"), -1, False))
    found = seen.repartition(max(len(parts), 1), "part").sortWithinPartitions("part", *order).mapInArrow(_nearby(rule, len(parts)), FOUND)
    found = materialize(found, "nearby")
    discard(rows)
    return found


def _extents(rule: Rule):
    """Spans, in bytes, of contexts with the symbols before and after their points."""

    def run(batches):
        for batch in batches:
            key, pos, before, after = (batch.column(i).to_numpy() for i in (0, 1, 4, 5))
            if rule.words:
                texts = batch.column(2).to_pylist()
                begin, end = _by_word(texts)[1], _by_word(batch.column(3).to_pylist())[2]
                before = np.array([len(x) - int(b[-s]) if s else 0 for x, b, s in zip(texts, begin, before.tolist())], np.int64)
                after = np.array([int(e[s - 1]) if s else 0 for e, s in zip(end, after.tolist())], np.int64)
            yield pa.record_batch([pa.array(key), pa.array((pos - before).astype(np.int32)), pa.array((pos + after).astype(np.int32))], names=["key", "start", "end"])

    return run


def _matched_by_range(hot: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Spans of the contexts of large grams, the contexts of grams for which this isn't sure to be all, and the tables used."""
    place = ["gram", "key", "pos"]
    by_left, by_right = (_sorted_sides(hot, rule, x) for x in (False, True))
    left = by_left.select(*place, F.col("near_most").alias("l1"), F.col("far_most").alias("r1"), F.col("bound").alias("left_bound"))
    right = by_right.select(*place, F.col("near_most").alias("r2"), F.col("far_most").alias("l2"), F.col("bound").alias("right_bound"))
    both = left.join(right, place).select(*place, F.greatest("l1", "l2").alias("before"), F.greatest("r1", "r2").alias("after"), "left_bound", "right_bound")
    both = materialize(both, "extents")
    # what was seen in neither order has no more in common on each side than the bounds, and counts only where both make up a string
    open_ = (F.col("left_bound") + F.col("right_bound") >= rule.least) & ((F.col("left_bound") > F.col("before")) | (F.col("right_bound") > F.col("after")))
    rest = hot.join(both.where(open_).select("gram").distinct(), "gram", "left_semi")
    spans = hot.join(both.where("before >= 0"), place).select("key", "pos", "left", "right", "before", "after").mapInArrow(_extents(rule), "key long, start int, end int")
    return spans, rest, [by_left, by_right, both]


WINDOWS = "gram long, window long, key long, start int, end int"


def _windows(rule: Rule):
    """Every window of every context by its hash and place."""

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.slice(lo, 1024)
                gram, key, pos = (part.column(i).to_numpy() for i in range(3))
                left, right = part.column(3).to_pylist(), part.column(4).to_pylist()
                off = np.concatenate(([0], np.cumsum([len(a) + len(b) for a, b in zip(left, right)]))).astype(np.int64)
                symbols = _Symbols(np.frombuffer(b"".join(x for pair in zip(left, right) for x in pair), np.uint8), off, rule)
                n = np.maximum(np.diff(symbols.off) - rule.least + 1, 0)
                row = np.repeat(np.arange(len(n)), n)
                at = symbols.off[row] + np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
                window = window_hash(symbols.sums, at, at + rule.least)
                zero = off[row] + np.array([len(x) for x in left], np.int64)[row] - pos[row]  # where the text would begin
                cols = [gram[row], window.view(np.int64), key[row], (symbols.begin(at) - zero).astype(np.int32), (symbols.end(at + rule.least) - zero).astype(np.int32)]
                yield pa.record_batch([pa.array(c) for c in cols], names=[f.split()[0] for f in WINDOWS.split(", ")])

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """docs with a key of each row; rows with equal ids and texts share one, and everything else."""
    return docs.withColumn("__key", F.xxhash64("doc_id", "text"))


def repeat_spans(docs: DataFrame, rule: Rule = BYTES) -> DataFrame:
    """(key, start, end), in bytes, of strings in docs that must go, overlaps included; a table in the shared folder."""
    texts = keyed(docs).select(F.col("__key").alias("key"), F.col("text").cast("binary").alias("text")).where(F.octet_length("text") >= rule.least)
    every = materialize(texts.mapInArrow(_occurrences(rule), OCCURRENCES), "anchors", "zstd")
    again = every.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    seen = materialize(every.join(again, "gram", "left_semi"), "repeated", "zstd")
    discard(every)
    # one row per distinct context of a gram, however often it occurs
    kinds = seen.groupBy("gram", "context").agg(F.sum("n").alias("n"), F.min(F.struct("key", "pos", "before", "after")).alias("one"))
    kinds = materialize(kinds, "contexts", "zstd")
    full = seen.join(kinds.where("n > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    full = full.select("key", F.explode("spans").alias("s")).select("key", "s.start", "s.end")
    several = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    chosen = kinds.join(several, "gram").select("gram", "kinds", "one.*")
    side = lambda start, size: F.substring("text", start, F.col(size))
    fetched = chosen.join(texts, "key").select("gram", "key", "pos", side(F.col("pos") - F.col("before") + 1, "before").alias("left"), side(F.col("pos") + 1, "after").alias("right"), "kinds")
    fetched = materialize(fetched, "fetched")
    partial = fetched.where(F.col("kinds") <= ARRAY_CONTEXTS).select(*FETCHED).repartition("gram").sortWithinPartitions("gram").mapInArrow(_match(rule), "key long, start int, end int")
    full, used = full.unionByName(partial), [seen, kinds, fetched]
    hot = fetched.where(F.col("kinds") > ARRAY_CONTEXTS)
    if not hot.isEmpty():
        spans, many, more = _matched_by_range(hot, rule)
        full, used = full.unionByName(spans), used + more
    if not hot.isEmpty() and not many.isEmpty():
        windows = materialize(many.select(*FETCHED).mapInArrow(_windows(rule), WINDOWS), "windows")
        place = F.struct("key", "start")
        twice = windows.groupBy("gram", "window").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("gram", "window")
        full = full.unionByName(windows.join(twice, ["gram", "window"], "left_semi").select("key", "start", "end"))
        used.append(windows)
    spans = materialize(full.distinct(), "spans")
    discard(*used)
    return spans


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _with_spans(docs: DataFrame, rules: dict[str, tuple[Rule, ...]]) -> DataFrame:
    """docs with a column of spans for each name, by its rules."""
    out = keyed(docs)
    for name, some in rules.items():
        spans = repeat_spans(docs, some[0])
        for rule in some[1:]:
            spans = spans.unionByName(repeat_spans(docs, rule))
        per = spans.groupBy(F.col("key").alias("__k")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(name))
        out = out.join(per, F.col("__key") == F.col("__k"), "left").drop("__k")
    return out.drop("__key")


def _cut(text: bytes, spans) -> tuple[bytes, int]:
    merged = merge_spans([(s["start"], s["end"]) for s in spans or []])
    at, kept = 0, []
    for s, e in merged:
        kept.append(text[at:s])
        at = e
    kept.append(text[at:])
    return b"".join(kept), len(merged)


def _words_within(text: bytes, spans) -> tuple[int, int]:
    """Words in spans, and the runs that they make."""
    merged = merge_spans([(s["start"], s["end"]) for s in spans or []])
    joined = sum(text[a[1] : b[0]].isspace() for a, b in zip(merged, merged[1:]))
    return sum(len(text[a:b].split()) for a, b in merged), len(merged) - joined


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long, n_passages long"


def removed_bytes(docs: DataFrame, rule: Rule = BYTES, passages: Rule = PASSAGES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document by the rule; words in passages that stand elsewhere too, and their number."""

    def run(batches):
        for batch in batches:
            rows = []
            for d, t, spans, shared in zip(*(batch.column(i).to_pylist() for i in range(4))):
                t = t or b""
                kept, n = _cut(t, spans)
                rows.append((d, len(t), len(t) - len(kept), n, sha256(kept).hexdigest(), *_words_within(t, shared)))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.int64()] * 2
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in REMOVED.split(", ")])

    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = _with_spans(few, {"__spans": (rule,), "__shared": (passages,)}).select("doc_id", F.col("text").cast("binary").alias("text"), "__spans", "__shared")
    return rows.mapInArrow(run, REMOVED)


def without_repeats(docs: DataFrame, *rules: Rule) -> DataFrame:
    """docs with what repeats by any of the rules cut from the text (what a cut leaves of a character goes too) and n_chars, if there, counted anew."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            spans = batch.column(batch.schema.get_field_index("__spans")).to_pylist()
            texts = [t if not s else _cut(t.encode(), s)[0].decode("utf-8", "ignore") for t, s in zip(batch.column(at).to_pylist(), spans)]
            cols = [pa.array(texts, batch.schema.field(at).type) if i == at else batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "__spans"]
            yield pa.record_batch(cols, names=[n for n in batch.schema.names if n != "__spans"])

    out = _with_spans(docs, {"__spans": rules or (BYTES,)}).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
