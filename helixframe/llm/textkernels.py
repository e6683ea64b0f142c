"""Vectorised byte-level kernels over Arrow text columns, shared by the operators.

All work on chunks of whole documents of about a megabyte, so memory per task is bounded by the
chunk or by one document, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE_KEYS = _RNG.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {"n": 0}


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """p**i and its inverse modulo 2**64 for i < n, grown on demand."""
    if _powers["n"] < n:
        size = max(n, 1 << 20)
        for key, base in (("up", _P), ("down", _P_INV)):
            t = np.full(size, base, U64)
            t[0] = 1
            _powers[key] = np.multiply.accumulate(t)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def byte_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its offsets; nulls are empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.cast(pa.large_binary()).fill_null(b"")
        kind = np.int64
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], kind, n + 1 + col.offset)[col.offset :].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes sum to about `most`; a longer row stands alone."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """The white-space separated words of a chunk of texts, A-Z lower-cased."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.n_docs = len(off) - 1
        n = len(data)
        low = _LOWER[data]
        solid = ~_SPACE[low]
        first = solid.copy()
        last = solid.copy()
        if n:
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            edges = off[1:-1]
            edges = edges[(edges > 0) & (edges < n)]
            first[edges] = solid[edges]
            last[edges - 1] = solid[edges - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        #: word index range of each document
        self.doc_off = np.searchsorted(self.start, off)
        self.doc_off[-1] = len(self.start)
        self.low = low

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.low)
        up, down = _pow_tables(n + 1)
        s = np.zeros(n + 1, U64)
        np.cumsum(_BYTE_KEYS[self.low] * up[:n], out=s[1:])
        return mix((s[self.end] - s[self.start]) * down[self.start])

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.doc_off))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums s with s[i] over data[:i]; see window_hash."""
    return symbol_sums(_BYTE_KEYS[data])


def symbol_sums(keys: np.ndarray) -> np.ndarray:
    """The same over symbols that already are 64-bit hashes."""
    up, _ = _pow_tables(len(keys) + 1)
    s = np.zeros(len(keys) + 1, U64)
    np.cumsum(keys * up[: len(keys)], out=s[1:])
    return s


def window_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], equal for equal bytes."""
    _, down = _pow_tables(len(s))
    return mix((s[end] - s[start]) * down[start])


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingle hashes of each document, concatenated, and their offsets.

    A document of fewer than k words has its whole word sequence as its only shingle; one without words has none.
    """
    w = Words(data, off)
    h = w.hashes()
    n_words = np.diff(w.doc_off)
    n = len(h)
    keys = [mix(np.array([i * 2 + 1], U64) * U64(0xD6E8FEB86659FD93))[0] | U64(1) for i in range(k)]
    full = np.zeros(max(n - k + 1, 0), U64)
    for i in range(k):
        full += h[i : n - k + 1 + i] * keys[i] if n >= k else U64(0)
    full = mix(full)
    out, lens = [], np.zeros(w.n_docs, np.int64)
    for d in range(w.n_docs):
        a, b = w.doc_off[d], w.doc_off[d + 1]
        m = n_words[d]
        if m >= k:
            x = np.sort(full[a : b - k + 1])
            x = x[np.concatenate(([True], x[1:] != x[:-1]))]
        elif m:
            x = mix(np.array([(int((h[a:b] * np.array(keys[:m], U64)).sum(dtype=U64)) + 0x51ED270B * int(m)) % 2**64], U64))
        else:
            continue
        lens[d] = len(x)
        out.append(x)
    return (np.concatenate(out) if out else np.zeros(0, U64)), np.concatenate(([0], np.cumsum(lens)))
