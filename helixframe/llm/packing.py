"""Packing by power-of-two decomposition.

A document's tokens are cut into as many pieces of 4096 as it holds, and the rest into the powers of two of its
binary form, largest first. Every piece is a sequence of its own, so no sequence crosses documents and none is
padded; pieces of equal length share a bucket, from which batches of one shape are drawn. Sequence ids of a bucket
lie in one range: bucket * 2**56 plus a number unique to the piece.

Defined cases: a null or empty text is one piece with the end token alone; rows with equal ids are separate
documents; a null doc_id stays null; an empty table gives no rows; extra columns are dropped.

``WordBpe`` gives the ids of the public word_bpe_49k tokenizer. That tokenizer encodes each pre-token by itself, so
ids are kept by pre-token, and pre-tokens are found by NumPy over the bytes of many texts; texts with anything but
ASCII, Western European letters and common signs go to the tokenizer whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernels import byte_column, chunks, prefix_sums, window_hash

LONGEST = 4096
END_ID = 2
#: Pre-tokens kept by a Python worker before the memory starts anew.
CACHE_WORDS = 1_000_000
#: Bytes of text that are encoded at once.
CHUNK = 4 << 20

def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Classes of bytes: 0 white space, 1 letter, 2 digit, 3 sign, 9 anything that the quick way leaves to the tokenizer.
_CLASS = np.full(256, 9, np.uint8)
_CLASS[[9, 10, 13, 32]] = 0
_CLASS[33:127] = 3
_CLASS[48:58] = 2
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[0x80:0xC0] = 8  # within a character
_CLASS[[0xC2, 0xC3, 0xE2]] = 7  # first of a character, looked at below
_SIGNS_C2 = np.isin(np.arange(256), [*range(0xA1, 0xB2), 0xB4, 0xB6, 0xB7, 0xB8, 0xBB, 0xBF]) & (np.arange(256) != 0xAA)


def _bytes_as_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    table = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class WordBpe:
    """Ids of texts, with the ids of pre-tokens kept under their 64-bit hashes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.letters = dict(enumerate(_bytes_as_letters()))
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.len = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        tokenize, letters = self.full.model.tokenize, self.letters
        ids = [[t.id for t in tokenize(w.decode("latin-1").translate(letters))] for w in words]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for part in ids for x in part), np.uint32, int(n.sum()))
        at = len(self.flat) + np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.len = keys[order], np.concatenate((self.at, at))[order], np.concatenate((self.len, n))[order]
        self.flat = np.concatenate((self.flat, flat))

    def _split(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, starts and ends of pre-tokens, and which texts need the tokenizer itself."""
        low = data.copy()
        low[(data >= 65) & (data <= 90)] += 32
        cls = _CLASS[data]
        n = len(data)
        nxt = np.append(data[1:], np.uint8(0))
        for lead in np.flatnonzero(cls == 7)[None, :]:
            kind, second = data[lead], nxt[lead]
            a = lead[kind == 0xC3]
            letter = ~np.isin(nxt[a], (0x97, 0xB7))
            cls[a] = cls[np.minimum(a + 1, n - 1)] = np.where(letter, 1, 3)
            up = a[(nxt[a] < 0x9F) & letter]
            low[up + 1] += 32
            b = lead[(kind == 0xC2) & _SIGNS_C2[second]]
            cls[b] = cls[b + 1] = 3
            c = lead[(kind == 0xE2) & ((second == 0x80) | (second == 0x81))]
            third = data[np.minimum(c + 2, n - 1)]
            point = ((nxt[c].astype(np.int64) & 63) << 6) | (third & 63)
            c = c[((point >= 0x10) & (point <= 0x27)) | ((point >= 0x30) & (point <= 0x5E))]
            cls[c] = cls[c + 1] = cls[c + 2] = 3
        odd = np.flatnonzero(cls >= 7)
        slow = np.zeros(len(off) - 1, bool)
        slow[np.searchsorted(off, odd, "right") - 1] = True
        # special tokens of the vocabulary begin with <|
        mark = np.flatnonzero((data == 60) & (nxt == 124))
        slow[np.searchsorted(off, mark, "right") - 1] = True
        before = np.append(np.uint8(0), cls[:-1])
        first = off[:-1][off[:-1] < n]
        begin = (cls != before) | ((cls == 2) & (before == 2))
        begin[first] = True
        cut = np.flatnonzero(begin)
        end = np.append(cut[1:], n)
        solid = cls[cut] != 0
        start, end = cut[solid], end[solid]
        kind = cls[start]
        # 's 't 'm 'd and 're 've 'll are pre-tokens of their own
        q = np.flatnonzero((low[start] == 39) & (end - start == 1))
        q = q[q + 1 < len(start)]
        q = q[(start[q + 1] == end[q]) & (kind[q + 1] == 1) & ~np.isin(end[q], first)]
        x = low[start[q + 1]]
        y = np.where(end[q + 1] - start[q + 1] > 1, low[np.minimum(start[q + 1] + 1, n - 1)], 0)
        k = np.where(np.isin(x, (115, 116, 109, 100)), 1, np.where(((x == 114) & (y == 101)) | ((x == 118) & (y == 101)) | ((x == 108) & (y == 108)), 2, 0))
        end[q] += k
        start[q + 1] += k
        keep = start < end
        return low, start[keep], end[keep], slow

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offsets of each text's."""
        low, start, end, slow = self._split(data, off)
        if len(self.keys) > CACHE_WORDS:
            self._clear()
        sums = prefix_sums(low)
        doc = np.searchsorted(off, start, "right") - 1
        if slow.any():
            fast = ~slow[doc]
            start, end, doc = start[fast], end[fast], doc[fast]
        keys, back = np.unique(window_hash(sums, start, end), return_inverse=True)
        where = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == keys[inside]
        if not known.all():
            sample = np.zeros(len(keys), np.int64)
            sample[back] = np.arange(len(back))
            new = np.flatnonzero(~known)
            raw = low.tobytes()
            self._learn(keys[new], [raw[a:b] for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())])
            where = np.searchsorted(self.keys, keys)
        at, n = self.at[where][back], self.len[where][back]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = self.flat[np.repeat(at - total[:-1], n) + np.arange(total[-1])] if len(n) else np.zeros(0, np.uint32)
        sizes = np.bincount(doc, n, minlength=len(off) - 1).astype(np.int64) if len(n) else np.zeros(len(off) - 1, np.int64)
        if slow.any():
            ends = np.cumsum(sizes)
            parts = []
            for d in range(len(off) - 1):
                if slow[d]:
                    text = data[off[d] : off[d + 1]].tobytes().decode("utf-8", "replace")
                    part = np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
                    sizes[d] = len(part)
                else:
                    part = ids[ends[d] - sizes[d] : ends[d]]
                parts.append(part)
            ids = np.concatenate(parts)
        return ids, np.concatenate(([0], np.cumsum(sizes)))


_loaded: dict[str, WordBpe] = {}


def pieces_of(n: int) -> list[int]:
    """Lengths of the pieces of n tokens, largest first."""
    rest = n % LONGEST
    return [LONGEST] * (n // LONGEST) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


PIECES = "doc_id long, start long, length long, doc_tokens long, bucket int, ids binary"


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, bucket (log2 of the length), ids (little-endian 32-bit), sequence_id, offset (always 0)."""
    path = tokenizer or tokenizer_path()

    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        bpe = _loaded.get(path) or _loaded.setdefault(path, WordBpe(path))
        end = np.array([END_ID], "<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("bucket", pa.int32()), ("ids", pa.binary())])
        for batch in batches:
            data, off = byte_column(batch, "text")
            doc_ids = batch.column(0).to_pylist()
            for lo, hi in chunks(off, CHUNK):
                rows: tuple[list, ...] = ([], [], [], [], [], [])
                ids, at_id = bpe.encode(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                ids = ids.astype("<u4").tobytes()
                for i, d in enumerate(doc_ids[lo:hi]):
                    tokens = ids[4 * at_id[i] : 4 * at_id[i + 1]] + end
                    n, at = len(tokens) // 4, 0
                    for m in pieces_of(n):
                        for col, v in zip(rows, (d, at, m, n, m.bit_length() - 1, tokens[4 * at : 4 * (at + m)])):
                            col.append(v)
                        at += m
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    out = texts.mapInArrow(cut, PIECES)
    # distinct up to eight million tasks
    number = F.col("bucket").cast("long") * F.lit(1 << 56) + F.monotonically_increasing_id()
    return out.withColumn("sequence_id", number).withColumn("offset", F.lit(0).cast("long"))


BATCHES = "bucket int, length long, n int, doc_ids array<long>, ids binary"


def length_batches(pieces: DataFrame, batch_tokens: int = 1 << 18) -> DataFrame:
    """Pieces of equal length side by side: bucket, length, n, doc_ids, and the ids of all n, for batches of `batch_tokens` tokens.

    Pieces are spread over all tasks whatever their bucket, so a frequent length is no hot key; a task's last batch of a length may be short.
    """

    def gather(batches):
        held: dict[int, tuple[list, list]] = {}
        schema = pa.schema([("bucket", pa.int32()), ("length", pa.int64()), ("n", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("ids", pa.binary())])

        def told(bucket: int):
            docs, ids = held.pop(bucket)
            return pa.RecordBatch.from_pylist([{"bucket": bucket, "length": 1 << bucket, "n": len(docs), "doc_ids": docs, "ids": b"".join(ids)}], schema=schema)

        for batch in batches:
            for d, bucket, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                docs, parts = held.setdefault(bucket, ([], []))
                docs.append(d)
                parts.append(ids)
                if len(docs) << bucket >= batch_tokens:
                    yield told(bucket)
        for bucket in sorted(held):
            yield told(bucket)

    return pieces.select("doc_id", "bucket", "ids").mapInArrow(gather, BATCHES)


def piece_digests(docs: DataFrame) -> DataFrame:
    """The pieces with a checksum in the place of their ids."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
