"""SimHash near-dedup by pigeonring filtering.

A fingerprint's 64 bits lie on a ring of four segments. Where two fingerprints differ in at most three bits, some segment
begins a chain of consecutive segments in which the first l hold at most 3 * l / 4 differences, for every l: none in the first, one
in the first two, two in the first three. (If no segment began such a chain, the ring could be cut into stretches that each exceed
their budget, and their sum would exceed three.) So the index of a fingerprint has keys for each segment that begins a chain: the segment whole, and
two of the four bytes of the next two segments, in the five ways that such differences leave two equal bytes. Fingerprints that
meet under a key are held against the chain's budgets, one length after the other, and only then compared in full.

Equal fingerprints are one node. Under each key, fingerprints are first held against the one that most documents have, so large
groups of near copies give pairs in proportion to their size. Where a key's fingerprints are of several components after that,
they are compared in blocks, every two blocks in one group, and only links that join components leave it. So no link is lost, and no group's
pairs are written out.

Defined cases: a null or empty text, or one without words, has fingerprint zero and links like any other; fewer than three
words are one shingle; equal rows link; rows with equal ids are separate documents; a component of null ids alone has a null
component_id; empty tables give no rows; extra columns are dropped. Texts are read in pieces of about a megabyte, so
memory doesn't grow with a text beyond the text itself.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import materialize

SEED, SHINGLE = 42, 3
DISTANCE, SEGMENTS, WIDTH = 3, 4, 16
#: Bytes of a text that are split into words at a time, and shingles whose bits are counted at a time.
PIECE, COUNTED = 1 << 20, 1 << 17
#: Fingerprints of a block where a key's components meet, and rows of a call on average.
BLOCK, CALL_ROWS = 4096, 50_000
#: Which two of the next two segments' bytes (0 and 1 of the second, 2 and 3 of the third) a key holds besides the first segment.
#: The second segment has one difference at most, so bytes 2 and 3 alone are never the only equal ones.
BYTES = ((0, 1), (1, 3), (1, 2), (0, 3), (0, 2))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes):
    """Whole words of the text, a megabyte at a time."""
    lo = 0
    while lo < len(text):
        hi = len(text)
        if hi - lo > PIECE and (m := _SPACE.search(text, lo + PIECE)):
            hi = m.start()
        yield text[lo:hi].lower().split()
        lo = hi


def _hashes(text: bytes, k: int):
    """Hashes of the text's shingles, by pieces."""
    digest, held, some = xxhash.xxh64_intdigest, [], False
    for words in _pieces(text):
        words = held + words
        if len(words) >= k:
            some = True
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
            words = words[len(words) - k + 1 :]
        held = words
    if not some and held:
        yield np.array([digest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """Bit b is one if it is set in over half the shingles' hashes; zero without words."""
    n, ones = 0, np.zeros(64, np.int64)
    for h in _hashes(text, k):
        n += len(h)
        for lo in range(0, len(h), COUNTED):
            part = h[lo : lo + COUNTED]
            ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint, as a signed long) of each document."""

    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t.as_py() or b"", k) for t in batch.column(1)], np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit(0xFFFF))


def _byte(fp: Column, i: int, b: int) -> Column:
    """Byte b (0 to 3) of the two segments after i."""
    return F.shiftrightunsigned(fp, (WIDTH * (i + 1) + 8 * b) % 64).bitwiseAND(F.lit(0xFF))


def chain_keys(fp: Column) -> Column:
    """The keys of the chains, as longs: which of them it is above 32 bits of the segment and two bytes."""
    return F.array(
        *(
            F.shiftleft(_segment(fp, i), 16).bitwiseOR(F.shiftleft(_byte(fp, i, a), 8)).bitwiseOR(_byte(fp, i, b)).bitwiseOR(F.lit((i * len(BYTES) + w) << 32))
            for i in range(SEGMENTS)
            for w, (a, b) in enumerate(BYTES)
        )
    )


def _within_chain(x: Column, y: Column, key: Column) -> Column:
    """Whether the chain that begins at a key's segment stays within its budgets at every length; the last is the full Hamming distance."""
    d = x.bitwiseXOR(y)
    begins = F.floor(F.shiftright(key, 32) / len(BYTES))
    turned = d
    for i in range(1, SEGMENTS):
        s = WIDTH * i
        turned = F.when(begins == i, F.shiftrightunsigned(d, s).bitwiseOR(F.shiftleft(d, 64 - s))).otherwise(turned)
    good = F.lit(True)
    for length in range(1, SEGMENTS + 1):
        mask = (1 << (WIDTH * length)) - 1 if length < SEGMENTS else -1
        good = good & (F.bit_count(turned.bitwiseAND(F.lit(mask).cast("long"))) <= length * DISTANCE // SEGMENTS)
    return good


def _linked_blocks(group: pd.DataFrame) -> list[tuple[int, int]]:
    """Links between components, as few as join them, within what two blocks of a key hold."""
    key, x, y = (int(group[c].iloc[0]) for c in ("key", "x", "y"))
    fp, own = group["fp"].to_numpy().view(np.uint64), group["own"].to_numpy()
    component = np.unique(group["component"].to_numpy(), return_inverse=True)[1]
    parent = np.arange(component.max() + 1)
    shift = np.uint64(WIDTH * ((key >> 32) // len(BYTES)))
    turned = (fp >> shift) | (fp << (np.uint64(64) - shift)) if shift else fp
    left, right = (np.flatnonzero(own == b) for b in (x, y))
    out = []

    def find(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    for lo in range(0, len(left), 256):
        rows = left[lo : lo + 256]
        name = parent
        while (name[name] != name).any():
            name = name[name]
        cross = name[component[rows]][:, None] != name[component[right]][None]
        if x == y:
            cross &= rows[:, None] < right[None]
        a, b = np.nonzero(cross)
        for length in range(2, SEGMENTS + 1):  # the first segment is the key's
            mask = np.uint64((1 << (WIDTH * length)) - 1)
            good = np.bitwise_count((turned[rows[a]] ^ turned[right[b]]) & mask) <= length * DISTANCE // SEGMENTS
            a, b = a[good], b[good]
        for u, v in zip(rows[a].tolist(), right[b].tolist()):
            p, q = find(component[u]), find(component[v])
            if p != q:
                parent[p] = q
                out.append((int(fp[u].view(np.int64)), int(fp[v].view(np.int64))))
    return out


def _rest(keyed: DataFrame, label: DataFrame) -> DataFrame:
    """Links (a, b) across components among fingerprints (key, fp) that share a key, as many as it takes to join them."""
    members = keyed.join(label.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    members = materialize(members.select("key", "fp", "component"), "members")
    mixed = members.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("m")).where("c0 <> c1")
    mixed = materialize(mixed.select("key", F.ceil(F.col("m") / BLOCK).alias("blocks")), "mixed")
    dealt = members.join(mixed, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = materialize(dealt.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "fp", "component"), "dealt")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [link for _, group in pdf.groupby(["key", "x", "y"], sort=False) for link in _linked_blocks(group)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    # small groups share a call, and calls grow with the rows
    calls = 64 + dealt.count() // CALL_ROWS
    call = F.pmod(F.xxhash64("key", "x", "y"), F.lit(calls))
    return dealt.withColumn("call", call).groupBy("call").applyInPandas(run, "a long, b long")


def near_components(nodes: DataFrame) -> DataFrame:
    """(node, component) of the fingerprints (fp, copies) that hang together by links, but for each component's least."""
    keys = nodes.select("fp", "copies", F.explode(chain_keys(F.col("fp"))).alias("key"))
    # the fingerprint of most documents is the centre; keys of one fingerprint alone lead nowhere
    centre = keys.groupBy("key").agg(F.max(F.struct("copies", "fp")).alias("c"), F.count("*").alias("m")).where("m > 1")
    centre = materialize(centre.select("key", F.col("c.fp").alias("centre")), "centres")
    keyed = materialize(keys.select("key", "fp").join(centre, "key"), "keyed")
    near = keyed.where((F.col("fp") != F.col("centre")) & _within_chain(F.col("fp"), F.col("centre"), F.col("key")))
    links = materialize(near.select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b")).distinct(), "found")
    rest = materialize(_rest(keyed.select("key", "fp"), components(links)), "found")
    return components(links.unionByName(rest))


def near_duplicates(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (the smallest doc_id that links lead to) of each document."""
    told = materialize(fingerprints(docs, k), "fingerprints")
    nodes = materialize(told.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "nodes")
    label = near_components(nodes.select("fp", "copies"))
    own = nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = materialize(own.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    own = materialize(own.join(named, "component").select("fp", "component_id"), "named")
    return told.join(own, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
