"""N-gram Jaccard join by vertical partitioning.

A document's set holds the hashes of its distinct 5-word shingles. The global order of shingles is cut into
fragments; every set is cut with it, and each fragment gets the pieces of all sets, packed. In a fragment the
document frequencies are counted; only shingles that two different sets hold can overlap, and they alone
go on, with how often each occurs. Shingles in a fixed share of all documents are found first and go on at once. Summed per set over the fragments, they tell which sets can
reach the threshold with any other; of those, the rarest shingles (as many as a partner must meet
one of) index the set. Pairs that meet there have their partial overlaps counted part by part and summed.

Equal sets are one node throughout, under a hash of the whole set. Within a bucket of the index, sets are first
held against one centre, the set whose shingles are most frequent, so large groups of near copies give pairs in
proportion to their size. Where a centre's sets are of several components after that, they are compared with
each other in blocks, and only links leave a block, so no link is lost and no group's pairs are written out.

Hashes are 64 bits wide for words, shingles and sets, within fragments as well.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing; fewer than five
words are one shingle; equal rows link; rows with equal ids are separate documents; empty tables give no rows;
extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .components import components
from .storage import materialize, small_batches
from .textkernels import U64, byte_column, chunks, mix, shingle_sets

#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles of a fragment on average.
FRAGMENT_SHINGLES = 2_000_000
#: Shingles that a task cuts together.
RUN_SHINGLES = 1_000_000
#: Parts in which overlaps are counted.
PARTS = 4
#: Shingles in this share of all documents, and in so many at least, don't go to a fragment; see common_shingles.
COMMON_SHARE, COMMON_DOCS = 1e-3, 1000
#: Sets of a block when sets around one centre are compared.
BLOCK = 1024


def _signatures(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One hash of each set; the order of its elements doesn't matter."""
    s = np.concatenate((np.zeros(1, U64), np.cumsum(mix(h * U64(3) + U64(11)), dtype=U64)))
    return mix(s[off[1:]] - s[off[:-1]] + np.diff(off).astype(U64) * U64(0x9E3779B97F4A7C15))


def _describe(k: int):
    def run(batches):
        for batch in batches:
            data, off = byte_column(batch, "text")
            n, sig = np.zeros(len(batch), np.int64), np.zeros(len(batch), U64)
            for lo, hi in chunks(off):
                h, at = shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], k)
                n[lo:hi], sig[lo:hi] = np.diff(at), _signatures(h, at)
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(sig.view(np.int64))], names=["doc_id", "n_shingles", "sig"])

    return run


def _pack(group: np.ndarray, owner: np.ndarray, sig: np.ndarray, n: np.ndarray, cols: list[np.ndarray]):
    """Entries sorted by (group, owner), as one row of bytes per group: sigs, entries of each, set sizes, and the columns."""
    if not len(group):
        return
    change = np.concatenate(([True], (group[1:] != group[:-1]) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(change)
    counts = np.diff(np.append(first, len(group))).astype("<u4")
    g, o = group[first], owner[first]
    cut = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(g)]):
        lo, hi = first[a], first[b] if b < len(g) else len(group)
        yield (int(g[a]), sig[o[a:b]].tobytes(), counts[a:b].tobytes(), n[o[a:b]].astype("<u4").tobytes(), *(c[lo:hi].tobytes() for c in cols))


CUT = "frag int, sigs binary, counts binary, ns binary, low binary"
SHARED = "bucket int, frag int, sigs binary, counts binary, ns binary, low binary, df binary"
ACTIVE = "sig long, n long, shared long, score float, part int, keys binary, prefix array<long>"


def _runs(batches, k: int):
    """Distinct sets in runs of about RUN_SHINGLES shingles: hashes, the set of each, set hashes, set sizes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush():
        h = np.concatenate([x for x, _ in held])
        n = np.concatenate([np.diff(at) for _, at in held])
        sig = _signatures(h, np.concatenate(([0], np.cumsum(n))))
        owner = np.repeat(np.arange(len(n)), n)
        once = np.zeros(len(n), bool)
        once[np.unique(sig, return_index=True)[1]] = True
        keep = once[owner]
        return h[keep], owner[keep], sig, n

    size = 0
    for batch in batches:
        data, off = byte_column(batch, "text")
        for lo, hi in chunks(off):
            held.append(shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], k))
            size += len(held[-1][0])
            if size > RUN_SHINGLES:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def _tell(rows: list[tuple], names: str):
    schema = pa.schema([(x.split()[0], pa.int32() if x.endswith(" int") else pa.binary()) for x in names.split(", ")])
    for lo in range(0, len(rows), 64):
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[lo : lo + 64]), schema)], schema=schema)


def _cut(k: int, fragments: int, common: np.ndarray):
    """Sets by fragment, without the common shingles."""

    def run(batches):
        for h, owner, sig, n in _runs(batches, k):
            rare = ~_among(h, common)[0]
            h, owner = h[rare], owner[rare]
            frag = ((h >> U64(32)) * U64(fragments)) >> U64(32)
            order = np.argsort(frag.astype(np.uint16 if fragments < 65536 else np.uint32), kind="stable")
            yield from _tell(list(_pack(frag[order].astype(np.int64), owner[order], sig, n, [h[order].astype("<u8")])), CUT)

    return run


def _among(h: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are in a sorted array, and where."""
    at = np.minimum(np.searchsorted(common, h), max(len(common) - 1, 0))
    return (common[at] == h if len(common) else np.zeros(len(h), bool)), at


def _frequent(k: int, share: float):
    def run(batches):
        for h, owner, _, _ in _runs(batches, k):
            found, counts = np.unique(h, return_counts=True)
            keep = counts >= max(2, share * len(np.unique(owner)))
            yield pa.record_batch([pa.array(found[keep].view(np.int64)), pa.array(counts[keep])], names=["shingle", "n"])

    return run


def common_shingles(texts: DataFrame, n_docs: int, k: int, share: float | None = None, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles that occur in the given share of documents, sorted, and the level of each.

    A shingle with that share of all documents has it in some run, so runs send no others. At most (mean set size) / share
    shingles reach the driver, whatever the corpus: they alone would make a fragment grow with the documents.
    """
    least = max(COMMON_DOCS if least is None else least, (share or COMMON_SHARE) * n_docs)
    rows = texts.mapInArrow(_frequent(k, share or COMMON_SHARE), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least).collect()
    found = np.array([r["shingle"] for r in rows], np.int64).view(U64)
    order = np.argsort(found)
    return found[order], _level(np.array([r["n"] for r in rows], float))[order]


def _level(df: np.ndarray) -> np.ndarray:
    """Document frequency on a scale of one byte."""
    return np.minimum(255, np.log2(np.maximum(df, 1)) * 8).astype(np.uint8)


def _known(k: int, fragments: int, common: np.ndarray, levels: np.ndarray):
    """The common shingles of each set, as if from one more fragment."""

    def run(batches):
        for h, owner, sig, n in _runs(batches, k):
            hit, at = _among(h, common)
            owner, at = owner[hit], at[hit]
            bucket = (sig[owner] % U64(fragments)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            packed = _pack(bucket[order], owner[order], sig, n, [common[at[order]].astype("<u8"), levels[at[order]]])
            yield from _tell([(b, fragments, *rest) for b, *rest in packed], SHARED)

    return run


def _unpack(pdf: pd.DataFrame):
    sig = np.frombuffer(b"".join(pdf["sigs"]), U64)
    counts = np.frombuffer(b"".join(pdf["counts"]), "<u4").astype(np.int64)
    n = np.frombuffer(b"".join(pdf["ns"]), "<u4").astype(np.int64)
    low = np.frombuffer(b"".join(pdf["low"]), "<u8")
    return sig, counts, n, low


def _fragment(buckets: int):
    """In one fragment: keep the shingles that two sets hold, with their document frequency, dealt by set."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sig, counts, n, low = _unpack(pdf)
        frag = int(pdf["frag"].iloc[0])
        once = np.zeros(len(sig), bool)
        once[np.unique(sig, return_index=True)[1]] = True
        owner = np.repeat(np.arange(len(sig)), counts)
        keep = once[owner]
        low, owner = low[keep], owner[keep]
        order = np.argsort(low, kind="stable")
        s = low[order]
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        df = np.empty(len(s), np.int64)
        df[order] = np.repeat(np.diff(np.append(first, len(s))), np.diff(np.append(first, len(s))))
        shared = df >= 2
        low, owner, df = low[shared], owner[shared], df[shared]
        level = _level(df)
        bucket = (sig[owner] % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rows = [(b, frag, *rest) for b, *rest in _pack(bucket[order], owner[order], sig, n, [low[order], level[order]])]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in SHARED.split(", ")])

    return run


def _activate(percent: int, fragments: int):
    """In one bucket of sets: those whose shared shingles can reach the threshold, their shared shingles by part, and their index entries."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sig, counts, n, low = _unpack(pdf)
        df = np.frombuffer(b"".join(pdf["df"]), np.uint8)
        frag = np.repeat(pdf["frag"].to_numpy(), [len(x) // 8 for x in pdf["sigs"]])
        # runs may have the same set, each with its common shingles
        first = np.zeros(len(sig), bool)
        first[np.unique(np.stack((sig, frag.astype(U64))), axis=1, return_index=True)[1]] = True
        keep = np.repeat(first, counts)
        low, df, sig, n, frag, counts = low[keep], df[keep], sig[first], n[first], frag[first], counts[first]
        ids, who = np.unique(sig, return_inverse=True)
        size = np.zeros(len(ids), np.int64)
        size[who] = n
        shared = np.bincount(who, counts, minlength=len(ids)).astype(np.int64)
        need = -(-percent * size // 100)
        active = shared >= need
        level = np.bincount(np.repeat(who, counts), df, minlength=len(ids)) / np.maximum(size, 1)
        owner = np.repeat(who, counts)
        keep = active[owner]
        owner, key, df = owner[keep], low[keep].view(np.int64), df[keep]
        cuts = np.linspace(-(2**63), 2**63, PARTS + 1)[1:-1].astype(np.int64)
        out = []
        order = np.lexsort((key, df, owner))
        owner, key = owner[order], key[order]
        cut = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, int)
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(owner)]):
            o = owner[a]
            prefix = key[a : a + int(shared[o] - need[o]) + 1]
            keys = np.sort(key[a:b])
            at = np.concatenate(([0], np.searchsorted(keys, cuts), [len(keys)]))
            for part in range(PARTS):
                out.append((int(ids[o].astype(np.int64)), int(size[o]), int(shared[o]), float(level[o]), part, keys[at[part] : at[part + 1]].astype("<i8").tobytes(), prefix.tolist() if part == 0 else None))
        return pd.DataFrame(out, columns=["sig", "n", "shared", "score", "part", "keys", "prefix"])

    return run


def _overlaps(batches):
    """Partial overlaps of pairs in one part; keys are sorted and distinct."""
    for batch in batches:
        out = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if not x or not y:
                out.append(0)
                continue
            both = np.concatenate((np.frombuffer(x, "<i8"), np.frombuffer(y, "<i8")))
            both.sort(kind="stable")
            out.append(int((both[1:] == both[:-1]).sum()))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.int64())], names=["a", "b", "part_overlap"])


def links_of(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, na, nb) that reach the threshold: partial overlaps by part, summed per pair."""
    left = sets.select(F.col("sig").alias("a"), "part", F.col("keys").alias("keys_a"))
    right = sets.select(F.col("sig").alias("b"), "part", F.col("keys").alias("keys_b"))
    rows = pairs.select("a", "b").join(right, "b").join(left, ["a", "part"]).select("a", "b", "keys_a", "keys_b")
    partial = rows.mapInArrow(_overlaps, "a long, b long, part_overlap long")
    total = partial.groupBy("a", "b").agg(F.sum("part_overlap").alias("overlap")).join(pairs, ["a", "b"])
    return total.where(F.lit(100) * F.col("overlap") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("overlap")))


def _may_link(percent: int, x: str, y: str):
    """Whether columns n and shared of two sets, with suffixes x and y, leave room for the threshold: what both share is at most what either shares with anyone."""
    most = F.least(F.col(f"shared{x}"), F.col(f"shared{y}"), F.col(f"n{x}"), F.col(f"n{y}"))
    return F.lit(100) * most >= F.lit(percent) * (F.col(f"n{x}") + F.col(f"n{y}") - most)


def _as(df: DataFrame, suffix: str, *more) -> DataFrame:
    return df.select(*more, *(F.col(c).alias(f"{c}{suffix}") for c in ("sig", "n", "shared")))


def similar_sets(docs: DataFrame, k: int = 5, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, sig) of each document, and (node, component) of the sets that hang together by links."""
    return _joined(docs, k, percent)[:2]


def _joined(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As similar_sets, and the (sig, part, keys) of the sets that can link."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    described = materialize(texts.mapInArrow(_describe(k), "doc_id long, n_shingles long, sig long"), "sets")
    n_docs, total = described.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    fragments = max(16, -(-total // FRAGMENT_SHINGLES))
    texts = texts.select("text")
    common, levels = common_shingles(texts, n_docs, k)
    shared = texts.mapInArrow(_cut(k, fragments, common), CUT).groupBy("frag").applyInPandas(_fragment(fragments), SHARED)
    if len(common):
        shared = shared.unionByName(texts.mapInArrow(_known(k, fragments, common, levels), SHARED))
    active = materialize(shared.groupBy("bucket").applyInPandas(_activate(percent, fragments), ACTIVE), "active")
    sets = active.select("sig", "part", "keys")
    postings = active.where("part = 0").select("sig", "n", "shared", "score", F.explode("prefix").alias("key"))
    # the set of a bucket whose shingles are most frequent is most like the others: it is the centre
    centre = postings.groupBy("key").agg(F.max(F.struct("score", "n", "sig", "shared")).alias("c"), F.count("*").alias("m")).where("m > 1").select("key", "c.n", "c.sig", "c.shared")
    met = _as(postings, "_a", F.col("key").alias("key_a")).join(_as(centre, "_b", "key"), (F.col("key_a") == F.col("key")) & (F.col("sig_a") != F.col("sig_b")))
    around = materialize(met.select("key", "sig_a", "sig_b", "n_a", "n_b", "shared_a", "shared_b"), "around")
    first = F.col("sig_a") < F.col("sig_b")
    near = around.where(_may_link(percent, "_a", "_b"))
    pairs = near.select(F.least("sig_a", "sig_b").alias("a"), F.greatest("sig_a", "sig_b").alias("b"), F.when(first, F.col("n_a")).otherwise(F.col("n_b")).alias("na"), F.when(first, F.col("n_b")).otherwise(F.col("n_a")).alias("nb")).distinct()
    links = materialize(links_of(materialize(pairs, "pairs"), sets, percent).select("a", "b"), "found")
    label = components(links)
    rest = _rest(around, label, sets, percent)
    return described, components(links.unionByName(materialize(rest, "found"))), sets


def _rest(around: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components among the sets that share a bucket, as many as it takes to join them.

    Buckets with one centre are taken together: their sets meet in blocks, every two blocks in one group, and are compared
    there; only links leave the group.
    """
    name = label.select(F.col("node").alias("sig"), "component")
    members = around.select(F.col("sig_b").alias("centre"), F.col("sig_a").alias("sig"), F.col("n_a").alias("n")).unionByName(around.select(F.col("sig_b").alias("centre"), F.col("sig_b").alias("sig"), F.col("n_b").alias("n"))).distinct()
    members = members.join(name, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    mixed = members.groupBy("centre").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("m")).where("c0 <> c1").select("centre", F.ceil(F.col("m") / BLOCK).alias("blocks"))
    members = members.join(mixed, "centre").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("blocks")))
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("centre", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "sig", "n", "component")
    dealt = materialize(dealt.withColumn("call", F.xxhash64("centre", "x", "y")), "dealt")
    # small groups share a call, and calls grow with the sets
    calls = 4096 + dealt.count() // BLOCK
    dealt = dealt.withColumn("call", F.pmod("call", F.lit(calls)))
    return dealt.join(sets, "sig").groupBy("call").applyInPandas(_compare(percent), "a long, b long")


def _linked(group: pd.DataFrame, percent: int):
    """The sets of a group, and for each which of those after it link with it: first the group with a row per set, then (place, places)."""
    one = group.drop_duplicates("sig").sort_values("sig")
    yield one
    sig, n = one["sig"].to_numpy(), one["n"].to_numpy()
    row = np.searchsorted(sig, group["sig"].to_numpy())
    keys = np.concatenate([np.frombuffer(k, "<i8") for k in group["keys"]])
    owner = np.repeat(row, [len(k) // 8 for k in group["keys"]])
    # parts hold different keys, so their overlaps add up when the keys of all stand side by side
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(begin, len(keys)))
    rank = np.repeat(np.arange(len(begin)), size)
    mine = np.argsort(owner, kind="stable")
    at = np.searchsorted(owner[mine], np.arange(len(sig) + 1))
    for a in range(len(sig)):
        k = rank[mine[at[a] : at[a + 1]]]
        m = size[k]
        met = owner[np.repeat(begin[k] - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(m.sum())]
        overlap = np.bincount(met, minlength=len(sig))
        good = 100 * overlap >= percent * (n[a] + n - overlap)
        good[: a + 1] = False
        yield a, np.flatnonzero(good)


def _compare(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        for _, group in pdf.groupby(["centre", "x", "y"]):
            found = _linked(group, percent)
            one, parent = next(found), {}
            sig, component = one["sig"].to_numpy(), one["component"].to_numpy()

            def find(c):
                while parent.get(c, c) != c:
                    c = parent[c]
                return c

            for a, partners in found:
                for b in partners[component[partners] != component[a]].tolist():
                    u, v = find(component[a]), find(component[b])
                    if u != v:
                        parent[u] = v
                        out.append((int(sig[a]), int(sig[b])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _all_links(docs: DataFrame, k: int, percent: int, of_group, kind: str) -> tuple[DataFrame, DataFrame]:
    """Documents, and what of_group makes of all links (it gets the sets, and the places of both ends of links, by groups); every link is in one group.

    Linked sets are of one component; a component's sets meet in blocks, every two blocks in one group.
    """
    described, label, sets = _joined(docs, k, percent)
    nodes = described.where("n_shingles > 0").groupBy("sig").agg(F.min("n_shingles").alias("n"), F.count("*").alias("copies"))
    members = nodes.join(label.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    blocks = members.groupBy("component").agg(F.count("*").alias("m")).where("m > 1").select("component", F.ceil(F.col("m") / BLOCK).alias("blocks"))
    members = members.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("blocks")))
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("component", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "sig", "n", "copies")
    dealt = materialize(dealt.withColumn("call", F.xxhash64("component", "x", "y")), "dealt")

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, x, y), group in batch.groupby(["component", "x", "y"]):
            found = _linked(group, percent)
            one = next(found)
            own = one["own"].to_numpy()
            # two sets of one block meet with every other block too, and count where the block meets itself
            ends = [(np.full(len(b), a), b) for a, partners in found if len(b := partners[(own[partners] != own[a]) | (x == y)])]
            if ends:
                out.append(of_group(one, *(np.concatenate(e) for e in zip(*ends))))
        return pd.concat(out) if out else pd.DataFrame(columns=[f.split()[0] for f in kind.split(", ")], dtype="int64")

    # small groups share a call, and calls are as many as large groups ask for
    calls = 4096 + dealt.count() // BLOCK
    dealt = dealt.withColumn("call", F.pmod("call", F.lit(calls)))
    return described, dealt.join(sets, "sig").groupBy("call").applyInPandas(run, kind)


def linked_sets(docs: DataFrame, k: int = 5, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, sig) of each document, and every link (a, b), a < b, between different sets, once; documents of one set all link too."""

    def pairs(one, a, b):
        sig = one["sig"].to_numpy()
        return pd.DataFrame({"a": sig[a], "b": sig[b]})

    return _all_links(docs, k, percent, pairs, "a long, b long")


def link_counts(docs: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id and n_links, the number of other documents over the threshold, of each document; no pairs leave the groups."""

    def sums(one, a, b):
        copies = one["copies"].to_numpy()
        n = np.bincount(a, copies[b], minlength=len(one)) + np.bincount(b, copies[a], minlength=len(one))
        return pd.DataFrame({"sig": one["sig"].to_numpy(), "links": n.astype(np.int64)})

    described, links = _all_links(docs, k, percent, sums, "sig long, links long")
    links = links.groupBy("sig").agg(F.sum("links").alias("links"))
    full = described.where("n_shingles > 0")
    nodes = full.groupBy("sig").agg(F.count("*").alias("copies")).join(links, "sig", "left")
    counted = full.join(nodes.select("sig", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "sig").select("doc_id", "n_links")
    return counted.unionByName(described.where("n_shingles = 0").select("doc_id", F.lit(0).cast("long").alias("n_links")))


def representatives(docs: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each class: that of the smallest doc_id, then of the smallest set hash. Rows with empty sets all stay."""
    described, label = similar_sets(docs, k, percent)
    own = described.where("n_shingles > 0").groupBy("sig").agg(F.min(F.struct("doc_id", "sig")).alias("least"))
    own = own.join(label.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    kept = own.groupBy("component").agg(F.min("least").alias("k")).select(F.col("k.doc_id").alias("__id"), F.col("k.sig").alias("__kept"))

    def sign(batches):
        for batch in batches:
            data, off = byte_column(batch, "text")
            for lo, hi in chunks(off):  # rows leave with their texts, a megabyte at a time
                h, at = shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], k)
                sig = pa.array(_signatures(h, at).view(np.int64), mask=np.diff(at) == 0)
                yield pa.record_batch([*batch.slice(lo, hi - lo).columns, sig], names=[*batch.schema.names, "__sig"])

    signed = docs.mapInArrow(sign, StructType([*docs.schema.fields]).add("__sig", LongType()))
    first = F.row_number().over(Window.partitionBy("doc_id", "__sig").orderBy(F.xxhash64("text")))
    full = signed.where("__sig IS NOT NULL").join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sig") == F.col("__kept"))).withColumn("__row", first).where("__row = 1")
    return full.select(*docs.columns).unionByName(signed.where("__sig IS NULL").select(*docs.columns))


def classes(docs: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links lead to) of each document."""
    described, label = similar_sets(docs, k, percent)
    own = described.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    own = own.join(label.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    own = own.join(own.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("sig", "component_id")
    full = described.where("n_shingles > 0").join(own, "sig").select("doc_id", "n_shingles", "component_id")
    return full.unionByName(described.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
