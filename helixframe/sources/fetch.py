"""Fetching structures of ids from a store, through an interface that any store can fill.

A fetcher is made once per Python worker; calling it with an id gives the file's bytes or raises. Ids are spread by Spark,
those of a task are fetched by a few threads, and what fails stays a row with its error.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame

Fetcher = Callable[[str], bytes]
FETCHED = "protein_id string, content binary, error string, attempts int"


class Store(NamedTuple):
    """How to get files of a database: what makes a fetcher, and the kind of its files (cif, bcif or pdb)."""

    factory: Callable[[], Fetcher]
    kind: str = "cif"
    attempts: int = 4
    delay_s: float = 1.0
    workers: int = 8


_stores: dict[str, Store] = {}


def register(name: str, store: Store) -> None:
    _stores[name] = store


def store_of(name: str) -> Store:
    if name not in _stores:
        raise NotImplementedError(f"no store is registered as {name}")
    return _stores[name]


def _tried(fetcher: Fetcher, name: str, store: Store) -> tuple[str, bytes | None, str | None, int]:
    for n in range(1, store.attempts + 1):
        try:
            return name, fetcher(name), None, n
        except Exception as e:  # whatever a store raises is that id's error
            error = f"{type(e).__name__}: {e}"
            if n < store.attempts:
                time.sleep(store.delay_s)
    return name, None, error, store.attempts


def fetch(ids: DataFrame, store: Store) -> DataFrame:
    """protein_id, content, error, attempts of ids (protein_id): one row for each, with content or an error."""

    def run(frames):
        fetcher = store.factory()
        with ThreadPoolExecutor(store.workers) as pool:
            for pdf in frames:
                names = pdf["protein_id"].tolist()
                for lo in range(0, len(names), 4 * store.workers):
                    rows = list(pool.map(lambda n: _tried(fetcher, n, store), names[lo : lo + 4 * store.workers]))
                    yield pd.DataFrame(rows, columns=["protein_id", "content", "error", "attempts"])

    return ids.select("protein_id").where("protein_id IS NOT NULL").distinct().mapInPandas(run, FETCHED)


def fetched_missing(fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What came (protein_id, content), and what didn't (protein_id, error)."""
    return fetched.where("error IS NULL").select("protein_id", "content"), fetched.where("error IS NOT NULL").select("protein_id", "error")
