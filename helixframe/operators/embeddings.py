"""Embeddings of sequences: a plug-in interface, a registry with the models' widths, and a deterministic stand-in.

A model returns one array per sequence with a row for its start, its residues and its end. Models are loaded once per Python worker.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.refdata import EMBEDDERS


class Embedder(Protocol):
    width: int

    def embed(self, sequences: list[str]) -> list[np.ndarray]: ...


class HashEmbedder:
    """Rows from a hash of each residue with its neighbours; needs no weights, so that shapes and storage can be tested."""

    def __init__(self, width: int):
        self.width, self._rows = width, {}

    def _row(self, around: str) -> np.ndarray:
        """The row of a residue with its neighbours, kept for the next one like it while the kept rows have few bytes."""
        if around not in self._rows:
            if len(self._rows) * self.width > 1 << 24:
                self._rows.clear()
            self._rows[around] = np.random.default_rng(zlib.crc32(around.encode())).standard_normal(self.width, np.float32)
        return self._rows[around]

    def embed(self, sequences: list[str]) -> list[np.ndarray]:
        if not sequences:
            return []
        places: dict[str, int] = {}
        at = [places.setdefault(p[max(i - 1, 0) : i + 2], len(places)) for p in (f"<{s}>" for s in sequences) for i in range(len(p))]
        rows = np.stack([self._row(around) for around in places])[at]
        ends = np.cumsum([len(s) + 2 for s in sequences]).tolist()
        return [rows[lo:hi] for lo, hi in zip([0, *ends], ends)]


_factories: dict[str, Callable[[], Embedder]] = {}


def register(name: str, factory: Callable[[], Embedder]) -> None:
    _factories[name] = factory


def factory_of(name: str) -> Callable[[], Embedder]:
    """What makes the model of a name; it goes to the executors, the registry stays with the driver."""
    if name not in _factories:
        raise NotImplementedError(f"no model is registered for {name}; known widths: {EMBEDDERS}")
    return _factories[name]


#: Tokens of a model's batch, padding counted, and ranges of lengths.
TOKENS = 16_384


def batches_by_tokens(lengths: list[int], tokens: int) -> list[tuple[int, int]]:
    """Cuts of a list of rising lengths into stretches that fit the budget once padded to their longest; one that alone exceeds it stands alone."""
    cuts, lo = [], 0
    for k, n in enumerate(lengths):
        if k > lo and (k - lo + 1) * n > tokens:
            cuts.append((lo, k))
            lo = k
    return cuts + ([(lo, len(lengths))] if lo < len(lengths) else [])


def embeddings(sequences: DataFrame, factory: Callable[[], Embedder], tokens: int = TOKENS, ranges: int | None = None) -> DataFrame:
    """protein_id, emb (array<array<float>>, rows = residues + 2) of sequences (protein_id, sequence); null sequences are left out.

    Sequences are dealt by their ids and sorted by length where they lie, so those of a batch are about equally long whatever order they came in, and a
    batch, padded to its longest, has `tokens` tokens at most (start and end counted). A batch may span Arrow batches. Dealing by a hash needs no
    sample, for which all that comes before would run twice. ranges: how many parts; the session's shuffle partitions where none is given.
    """

    def run(batches):
        model, held = factory(), []

        def embedded(part):
            found = model.embed([s for _, s in part])
            for (_, s), e in zip(part, found, strict=True):
                if e.shape != (len(s) + 2, model.width):
                    raise ValueError(f"a sequence of {len(s)} residues got an array of shape {e.shape}")
            values = np.concatenate([np.asarray(e, np.float32).ravel() for e in found])
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, model.width, np.int32)), pa.array(values))
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            return pa.record_batch([pa.array([p for p, _ in part], pa.string()), pa.ListArray.from_arrays(pa.array(ends), rows)], names=["protein_id", "emb"])

        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            cuts = batches_by_tokens([len(s) + 2 for _, s in held], tokens)
            for lo, hi in cuts[:-1]:  # the last may go on in the next frame
                yield embedded(held[lo:hi])
            held = held[cuts[-1][0] :] if cuts else []
        if held:
            yield embedded(held)

    rows = sequences.select("protein_id", "sequence").where("sequence IS NOT NULL").withColumns({"_n": F.length("sequence"), "_any": F.xxhash64("protein_id")})
    parts = ranges or int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartition(parts, "_any").sortWithinPartitions("_n", "_any")
    return spread.select("protein_id", "sequence").mapInArrow(run, "protein_id string, emb array<array<float>>")
