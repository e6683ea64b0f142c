"""Maximal repeat groups: each string of ``least`` bytes or more that can't be extended on either side for all its places, with all of them.

Where a group can begin is told by the anchors of ``repeats``: windows of ``least`` bytes with one text have the same anchor at the same
offset, and what stands before them differs where the sorted left sides of an anchor's gram branch (or a document begins). Only
these windows are looked at; a window that always has the same byte before it begins no group.

The places of such a window are the suffixes of a class. What follows is fetched in chunks that double, so a suffix costs
at most a few times what it has in common with another. Equal chunks of a class are one row; the sorted distinct ones with their
common prefixes are an enhanced suffix array, and a stack scan of it gives the common-prefix interval tree. An interval with more than one byte
before its places is a group. Places whose whole chunk is equal go on as a class of their own, unless they all have the same byte before
them. A class with too many distinct chunks for one task is split by aggregation: the common prefix of all is that of the least and the greatest,
and places go on by the byte after it, one node a round.

Defined cases: the ends of a text differ from everything. Null, empty and short texts have no places; equal rows, also with equal
ids, are different places. In a periodic run, a place whose window stands again less than ``least`` bytes before it in
the text is left out, so a run is one place, its first. An empty table gives no rows; extra columns are dropped. 64-bit hashes stand for windows and chunks.
"""

from __future__ import annotations

from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .repeats import ARRAY_CONTEXTS, BYTES, Rule, anchors
from .storage import discard, materialize
from .textkernels import byte_column, chunks, prefix_sums, window_hash

#: Distinct chunks of a class, and their bytes together, up to which one task builds the class's tree.
CLASS_CHUNKS, CLASS_BYTES = 4096, 16 << 20
#: Bytes of a chunk at most.
MOST_CHUNK = 1 << 20

ANCHORED = "key long, gram long, context long, pos int, before int, after int"


def _anchored(rule: Rule):
    """Every anchor with a hash of what stands around it: the bytes of any window that it is the anchor of, and one before."""
    least, gram = rule.least, rule.gram

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, off = byte_column(batch, "text")
            for lo, hi in chunks(off):
                o = off[lo : hi + 1] - off[lo]
                sums = prefix_sums(data[off[lo] : off[hi]])
                p = anchors(sums, o, least, gram)
                doc = np.searchsorted(o, p, "right") - 1
                left, right = np.minimum(p - o[doc], least - gram + 1), np.minimum(o[doc + 1] - p, least)
                context = window_hash(sums, p - left, p + right) + (left * 1000 + right).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                cols = [keys[lo:hi][doc], window_hash(sums, p, p + gram).view(np.int64), context.view(np.int64), *(x.astype(np.int32) for x in (p - o[doc], left, right))]
                yield pa.record_batch([pa.array(c) for c in cols], names=[f.split()[0] for f in ANCHORED.split(", ")])

    return run


def _intervals(lcp: list[int]):
    """(first, last + 1, depth) of the intervals of a suffix array with these common prefixes with the place before (the first is -1), inner ones first."""
    stack: list[list[int]] = []
    for i, d in enumerate([*lcp[1:], -1]):
        first = i
        while stack and stack[-1][1] > d:
            first, depth = stack.pop()
            yield first, i + 1, depth
        if d >= 0 and (not stack or stack[-1][1] < d):
            stack.append([first, d])


def _prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)) if a[:n] != b[:n] else ()
    return int(differ[0]) if len(differ) else n


def _groups_of(batches, column: int, columns: int):
    """Lists of rows with equal values of a column, by which the rows are sorted."""
    held: list[tuple] = []
    for batch in batches:
        for r in zip(*(batch.column(i).to_pylist() for i in range(columns))):
            if held and held[-1][column] != r[column]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


STARTS = "gram long, context long, delta int, window long, prev int"


def _starts(rule: Rule, every: bool):
    """Windows around the contexts of a gram (gram, context, left, right) that may have different bytes before them; all of them if `every`."""
    least, most = rule.least, rule.least - rule.gram

    def around(rows: list[tuple]) -> list[set[int]]:
        back = [r[2][::-1] for r in rows]
        order = sorted(range(len(rows)), key=lambda i: back[i])
        lcs = [-1] + [_prefix(back[i], back[j]) for i, j in zip(order, order[1:])]
        out = [{len(b)} for b in back]
        for lo, hi, depth in _intervals(lcs):
            if depth <= most:
                for i in order[lo:hi]:
                    out[i].add(depth)
        return out

    def told(rows: list[tuple], deltas):
        cols: tuple[list, ...] = ([], [], [], [], [])
        for (gram, context, left, right), some in zip(rows, deltas):
            d = np.array(sorted(x for x in some if least - len(right) <= x <= min(most, len(left))), np.int64)
            if not len(d):
                continue
            text = np.frombuffer(left + right, np.uint8)
            at = len(left) - d
            window = window_hash(prefix_sums(text), at, at + least).view(np.int64)
            before = np.where(at > 0, text[np.maximum(at - 1, 0)].astype(np.int32), -1)
            for col, v in zip(cols, ([gram] * len(d), [context] * len(d), d.tolist(), window.tolist(), before.tolist())):
                col.extend(v)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in STARTS.split(", ")])

    def run(batches):
        if every:
            for batch in batches:
                rows = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
                for lo in range(0, len(rows), 1024):
                    yield told(rows[lo : lo + 1024], [range(most + 1)] * 1024)
        else:
            for rows in _groups_of(batches, 0, 4):
                yield told(rows, around(rows))

    return run


NODES = "class long, chunk_hash long, group long, length long, n long"


def _tree(batches):
    """The groups of classes, whose distinct chunks (class, depth, chunk, ended, chunk_hash, n, low, high) stand sorted; a row per chunk and group."""
    for rows in _groups_of(batches, 0, 8):
        lcp = [-1] + [_prefix(a[2], b[2]) for a, b in zip(rows, rows[1:])]
        n, low, high = (np.array([r[i] for r in rows], np.int64) for i in (5, 6, 7))
        cols: tuple[list, ...] = ([], [], [], [], [])

        def group(lo: int, hi: int, depth: int) -> None:
            least = low[lo:hi].min()
            if n[lo:hi].sum() > 1 and (least < high[lo:hi].max() or least < 0):
                name, start, text = rows[lo][0], rows[lo][1], rows[lo][2]
                id_ = int.from_bytes(blake2b(text[:depth], digest_size=8, key=f"{name} {start}".encode()).digest(), "little", signed=True)
                for col, v in zip(cols, (name, None, id_, start + depth, int(n[lo:hi].sum()))):
                    col.extend([v] * (hi - lo) if v is not None else [r[4] for r in rows[lo:hi]])

        for i, r in enumerate(rows):  # texts that end alike
            if r[3] and len(r[2]) > max(lcp[i], lcp[i + 1] if i + 1 < len(rows) else -1):
                group(i, i + 1, len(r[2]))
        for lo, hi, depth in _intervals(lcp):
            group(lo, hi, depth)
        yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=[f.split()[0] for f in NODES.split(", ")])


def _common_of_two(batches):
    """class, common prefix of the least and the greatest chunk."""
    for batch in batches:
        shared = [_prefix(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.record_batch([batch.column(0), pa.array(shared, pa.int32())], names=["class", "shared"])


_DIVERSE = "n > 1 AND (low < high OR low < 0)"


def _alive(places: DataFrame) -> DataFrame:
    """Places of classes with several places and bytes before them."""
    some = places.groupBy("class").agg(F.count("*").alias("n"), F.min("prev").alias("low"), F.max("prev").alias("high")).where(_DIVERSE)
    return places.join(some.select("class"), "class", "left_semi")


def _first_places(texts: DataFrame, rule: Rule) -> DataFrame:
    """(class, key, start, prev): the places of windows with several bytes before them, runs by their first."""
    found = materialize(texts.select("key", "text").mapInArrow(_anchored(rule), ANCHORED), "anchored", "zstd")
    kinds = found.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("key", "pos", "before", "after")).alias("one"))
    kinds = materialize(kinds, "contexts", "zstd")
    grams = kinds.groupBy("gram").agg(F.sum("n").alias("places"), F.count("*").alias("kinds")).where("places > 1")
    # contexts that are all alike have nothing different before them, unless a text begins within
    chosen = kinds.join(grams, "gram").where((F.col("kinds") > 1) | (F.col("one.before") <= rule.least - rule.gram)).select("gram", "context", "kinds", "one.*")
    side = lambda start, size: F.substring("text", start, F.col(size))
    sides = chosen.join(texts, "key").select("gram", "context", side(F.col("pos") - F.col("before") + 1, "before").alias("left"), side(F.col("pos") + 1, "after").alias("right"), "kinds")
    sides = materialize(sides, "sides", "zstd")
    columns = "gram", "context", "left", "right"
    few = sides.where(F.col("kinds") <= ARRAY_CONTEXTS).select(*columns).repartition("gram").sortWithinPartitions("gram")
    starts = few.mapInArrow(_starts(rule, False), STARTS).unionByName(sides.where(F.col("kinds") > ARRAY_CONTEXTS).select(*columns).mapInArrow(_starts(rule, True), STARTS))
    starts = materialize(starts, "starts", "zstd")
    counted = starts.join(kinds.select("gram", "context", "n"), ["gram", "context"])
    several = counted.groupBy("window").agg(F.sum("n").alias("n"), F.min("prev").alias("low"), F.max("prev").alias("high")).where(_DIVERSE)
    kept = starts.join(several.select("window"), "window", "left_semi")
    places = found.join(kept, ["gram", "context"]).select(F.col("window").alias("class"), "key", (F.col("pos") - F.col("delta")).alias("start"), "prev").distinct()
    last = F.lag("start").over(Window.partitionBy("class", "key").orderBy("start"))
    places = places.withColumn("last", last).where(F.col("last").isNull() | (F.col("start") - F.col("last") >= rule.least)).drop("last")
    places = materialize(_alive(materialize(places, "places", "zstd")), "places", "zstd")
    discard(found, kinds, sides, starts)
    return places


def _round(places: DataFrame, texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Groups that end within the next chunk of each class, by place, and the places that go on."""
    size = F.least(F.greatest(F.col("depth"), F.lit(least)), F.lit(MOST_CHUNK))
    chunk = F.substring("text", F.col("start") + F.col("depth") + 1, size)
    fetched = places.join(texts.select("key", "text"), "key").select("class", "depth", "key", "start", "prev", chunk.alias("chunk"), size.alias("size"))
    fetched = fetched.withColumn("ended", F.octet_length("chunk") < F.col("size")).withColumn("chunk_hash", F.xxhash64("chunk"))
    fetched = materialize(fetched, "chunks", "zstd")
    kinds = fetched.groupBy("class", "depth", "chunk_hash").agg(F.min("chunk").alias("chunk"), F.min("ended").alias("ended"), F.count("*").alias("n"), F.min("prev").alias("low"), F.max("prev").alias("high"))
    kinds = materialize(kinds, "kinds", "zstd")
    sizes = kinds.groupBy("class").agg(F.count("*").alias("chunks"), F.sum(F.octet_length("chunk")).alias("bytes"), F.sum("n").alias("total"))
    large = materialize(sizes.where((F.col("chunks") > max(CLASS_CHUNKS, 1)) | ((F.col("chunks") > 2) & (F.col("bytes") > CLASS_BYTES))), "large")
    small = kinds.join(large, "class", "left_anti").select("class", "depth", "chunk", "ended", "chunk_hash", "n", "low", "high")
    nodes = materialize(small.repartition("class").sortWithinPartitions("class", "chunk").mapInArrow(_tree, NODES), "nodes", "zstd")
    told = fetched.join(nodes, ["class", "chunk_hash"]).select("group", "length", "n", "key", "start")
    go_on = kinds.join(large, "class", "left_anti").where(~F.col("ended")).where(_DIVERSE).select("class", "chunk_hash")
    onward = fetched.join(go_on, ["class", "chunk_hash"], "left_semi")
    after = onward.select(F.xxhash64("class", "depth", "chunk_hash").alias("class"), (F.col("depth") + F.col("size")).alias("depth"), "key", "start", "prev")
    if not large.isEmpty():
        ends = kinds.join(large, "class", "left_semi").groupBy("class").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"))
        shared = ends.mapInArrow(_common_of_two, "class long, shared int").join(large.select("class", "total"), "class")
        split = fetched.join(shared, "class")
        told = told.unionByName(split.select(F.xxhash64("class", "depth", "shared").alias("group"), (F.col("depth") + F.col("shared")).cast("long").alias("length"), F.col("total").alias("n"), "key", "start"))
        head = F.substring("chunk", F.lit(1), F.col("shared") + 1)
        beyond = split.where(F.octet_length("chunk") > F.col("shared"))
        after = after.unionByName(beyond.select(F.xxhash64("class", "depth", head).alias("class"), (F.col("depth") + F.col("shared") + 1).alias("depth"), "key", "start", "prev"))
    told = materialize(told, "groups", "zstd")
    rest = materialize(_alive(after), "places", "zstd")
    discard(fetched, kinds, large, nodes)
    return told, rest


def repeat_groups(docs: DataFrame, rule: Rule = BYTES) -> DataFrame:
    """group, length, n (its places), doc_id, row (tells rows with equal ids apart), start: a row per maximal repeat and place, in bytes."""
    if rule.words:
        raise ValueError("groups are made of bytes")
    # numbered once, in a table, so that tasks that run again see the same numbers
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = materialize(rows.where(F.octet_length("text") >= rule.least), "texts", "zstd")
    places = _first_places(texts, rule).withColumn("depth", F.lit(rule.least))
    found = []
    while not places.isEmpty():
        told, places = _round(places, texts, rule.least)
        found.append(told)
    if not found:
        return texts.limit(0).select(*(F.lit(0).cast("long").alias(x) for x in ("group", "length", "n")), "doc_id", F.col("key").alias("row"), F.lit(0).alias("start"))
    every = reduce(DataFrame.unionByName, found)
    return every.join(texts.select("key", "doc_id"), "key").select("group", "length", "n", "doc_id", F.col("key").alias("row"), "start")
