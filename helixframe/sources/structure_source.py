"""Structures by id as a Spark data source: `spark.read.format("structures")` over a folder, or over a store.

Rows are protein_id, kind, content and error: what can't be read stays a row with its error. A filter on protein_id
(equality or a list) is pushed down, where the session allows that (spark.sql.python.filterPushdown.enabled): then
nothing is listed, and only the files of those ids are asked for. Ids are dealt to the partitions that Spark plans.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from .fetch import Store, _tried

SCHEMA = "protein_id string, kind string, content binary, error string"
KINDS = ("cif", "pdb", "bcif")


class Files(InputPartition):
    """Ids with the names of their files, or with None where the file is to be found out."""

    def __init__(self, names: list[tuple[str, str | None]]):
        self.names = names


def _dealt(names: list, parts: int) -> list[Files]:
    return [Files(names[k::parts]) for k in range(min(parts, len(names)))]


class _ById(DataSourceReader):
    """A reader that takes ids from filters."""

    def __init__(self, options):
        self.parts, self.ids = int(options.get("partitions", "16")), None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("protein_id",):
                given = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.ids = given if self.ids is None else self.ids & given
            else:
                yield f


class FolderReader(_ById):
    """Files `<id>.<kind>` of a folder; of one id cif wins over pdb, and pdb over bcif."""

    def __init__(self, options):
        super().__init__(options)
        self.path = options["path"].rstrip("/")

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def partitions(self) -> list[InputPartition]:
        if self.ids is not None:
            return _dealt([(i, None) for i in sorted(i for i in self.ids if i is not None)], self.parts)
        from pyarrow import fs

        system, at = self._system()
        best: dict[str, str] = {}
        for f in system.get_file_info(fs.FileSelector(at)):
            stem, _, kind = f.base_name.rpartition(".")
            if f.type == fs.FileType.File and kind in KINDS and KINDS.index(kind) <= KINDS.index(best.get(stem, KINDS[-1])):
                best[stem] = kind
        return _dealt(sorted((s, f"{s}.{k}") for s, k in best.items()), self.parts)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, at = self._system()
        for name, known in partition.names:
            yield _row(*self._one(system, at, name, known))

    def _one(self, system, at, name, known):
        from pyarrow import fs

        if "/" in name:
            return name, None, None, "ValueError: an id names no folder"
        files = [known] if known else [f"{name}.{k}" for k in KINDS]
        try:
            for f in files:
                if known or system.get_file_info(f"{at}/{f}").type == fs.FileType.File:
                    with system.open_input_stream(f"{at}/{f}") as stream:
                        return name, f.rpartition(".")[2], stream.read(), None
            return name, None, None, "FileNotFoundError: no file of this id"
        except OSError as e:
            return name, None, None, f"{type(e).__name__}: {e}"


def _row(name, kind, content, error) -> pa.RecordBatch:
    return pa.record_batch([pa.array([name]), pa.array([kind], pa.string()), pa.array([content], pa.binary()), pa.array([error], pa.string())], names=["protein_id", "kind", "content", "error"])


class StructureSource(DataSource):
    """Structure files of a folder: option path; partitions as many tasks at most."""

    @classmethod
    def name(cls) -> str:
        return "structures"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(self.options)


def store_source(name: str, store: Store) -> type[DataSource]:
    """A data source over a store, to be read with a filter on protein_id: a store can't be listed."""

    class StoreReader(_ById):
        def partitions(self) -> list[InputPartition]:
            if self.ids is None:
                raise ValueError(f"the store {name} is read by id: filter protein_id by equality or a list, with spark.sql.python.filterPushdown.enabled")
            return _dealt([(i, None) for i in sorted(i for i in self.ids if i is not None)], self.parts)

        def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
            fetcher = store.factory()
            for one, _ in partition.names:
                _, content, error, _ = _tried(fetcher, one, store)
                yield _row(one, store.kind if error is None else None, content, error)

    class StoreSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return StoreReader(self.options)

    return StoreSource


def register(spark: SparkSession, *stores: tuple[str, Store]) -> None:
    """Makes `structures`, and each store under its name, known to the session."""
    for source in (StructureSource, *(store_source(*s) for s in stores)):
        spark.dataSource.register(source)
