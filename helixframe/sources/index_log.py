"""An index that grows: immutable deltas, newest wins on read, compaction.

Under a root lie `deltas` (a folder of Parquet files per append or compaction) and `log` (a small file per commit, numbered without
gaps in time: it names its folder and the run that made it). Only what a commit names is read, so files of a run that died are never
seen, and a run that is repeated finds its own commit and adds nothing. A commit is a file created only if it doesn't
exist; of two writers that meet at one number, one goes on to the next.

Every folder is bucketed and sorted by protein_id into the same number of buckets. The last compaction, which holds nearly all of an
index, is thus joined with the few deltas after it and with requested ids where its buckets lie: only the other sides are dealt to
the buckets, and the index itself goes through no exchange.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "protein_id"
SCHEMA = f"{KEY} string, path string, deleted boolean, seq long, folder string"


@dataclass(frozen=True)
class Commit:
    seq: int
    run: str
    folder: str
    #: All commits up to this number are contained in the folder; -1 for an append.
    contains: int = -1


class IndexLog:
    """The log at a root folder; buckets: as many as tasks should read it, fixed when the log begins."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        held = self._read(f"{self.root}/buckets")
        if held is None and not self._create(f"{self.root}/buckets", str(buckets)):
            held = self._read(f"{self.root}/buckets")
        self.buckets = int(held or buckets)

    # --- small files, through Spark's own file systems

    def _path(self, path: str):
        p = self._fs_of(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._path(path)
        return fs.exists(p)

    def _create(self, path: str, text: str) -> bool:
        """Writes a new file; False if there is one."""
        fs, p = self._path(path)
        if fs.exists(p):
            return False
        try:
            out = fs.create(p, False)
        except Py4JJavaError as e:
            if fs.exists(p):
                return False
            raise e
        out.write(text.encode())
        out.close()
        return True

    def _read(self, path: str) -> str | None:
        fs, p = self._path(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def commits(self) -> list[Commit]:
        """All commits, oldest first; a file that its writer didn't finish is none."""
        fs, p = self._path(f"{self.root}/log")
        if not fs.exists(p):
            return []
        found = []
        for name in sorted(f.getPath().getName() for f in fs.listStatus(p)):
            try:
                found.append(Commit(**json.loads(self._read(f"{self.root}/log/{name}") or "")))
            except ValueError:
                continue
        return found

    def live(self) -> list[Commit]:
        """The last compaction and the appends after those that it contains."""
        every = self.commits()
        base = max((c for c in every if c.contains >= 0), key=lambda c: (c.contains, c.seq), default=None)
        return [c for c in every if c is base or (c.contains < 0 and (base is None or c.seq > base.contains))]

    def _commit(self, run: str, folder: str, contains: int = -1) -> Commit:
        fs, p = self._path(f"{self.root}/log")
        n = max((int(f.getPath().getName()[:12]) for f in fs.listStatus(p)), default=-1) + 1 if fs.exists(p) else 0
        while True:
            made = Commit(n, run, folder, contains)
            if self._create(f"{self.root}/log/{n:012d}.json", json.dumps(made.__dict__)):
                return made
            n += 1

    # --- tables

    def _name(self, folder: str) -> str:
        return f"index_{zlib.crc32(self.root.encode()):08x}_{folder.replace('-', '_')}"

    def _write(self, rows: DataFrame) -> str:
        """One row per id in a new folder: a file for each bucket, sorted."""
        folder = uuid.uuid4().hex
        dealt = rows.withColumn("folder", F.lit(folder)).repartition(self.buckets, KEY).sortWithinPartitions(KEY)
        writer = dealt.write.format("parquet").bucketBy(self.buckets, KEY).sortBy(KEY).option("path", f"{self.root}/deltas/{folder}")
        writer.saveAsTable(self._name(folder))
        return folder

    def _table(self, folder: str) -> DataFrame:
        name = self._name(folder)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/deltas/{folder}'")
        return self.spark.table(name)

    def append(self, rows: DataFrame, run: str | None = None, order: Iterable[str] = (), deleted: bool = False) -> Commit:
        """Adds the rows (protein_id, path) as newest; of rows with one id the last in `order` counts, then the greatest path.

        run names the work that made them: if it has been committed, nothing happens. deleted: the ids are no longer in the index.
        Rows without id are left out.
        """
        run = run or uuid.uuid4().hex
        for c in self.commits():
            if c.run == run:
                return c
        path = F.lit(None).cast("string") if deleted else F.col("path").cast("string")
        given = rows.where(F.col(KEY).isNotNull()).select(F.col(KEY).cast("string").alias(KEY), path.alias("path"), F.struct(*order, path.alias("_p")).alias("o"))
        # the number isn't known before the commit, so rows of an append have their folder's name instead
        once = given.groupBy(KEY).agg(F.max_by("path", "o").alias("path")).select(KEY, "path", F.lit(deleted).alias("deleted"), F.lit(None).cast("long").alias("seq"))
        return self._commit(run, self._write(once))

    def _of(self, commits: list[Commit]) -> DataFrame:
        """The newest row of each id in these folders, deletions included."""
        if len(commits) == 1:
            return self._table(commits[0].folder).select(KEY, "path", "deleted", F.coalesce("seq", F.lit(commits[0].seq).cast("long")).alias("seq"))
        number = F.create_map(*(F.lit(v) for c in commits for v in (c.folder, c.seq)))
        seq = F.coalesce("seq", F.try_element_at(number, F.col("folder")).cast("long"))
        both = reduce(DataFrame.union, [self._table(c.folder) for c in commits])
        newest = both.withColumn("seq", seq).groupBy(KEY).agg(F.max(F.struct("seq", "path", "deleted")).alias("v"))
        return newest.select(KEY, "v.path", "v.deleted", "v.seq")

    def _sides(self) -> tuple[DataFrame, DataFrame | None]:
        """The oldest live folder, whose buckets are read as they lie, and what the few after it say, if there are any."""
        live = self.live()
        if not live:
            return self.spark.createDataFrame([], SCHEMA).drop("folder"), None
        base = next((c for c in live if c.contains >= 0), live[0])
        later = [c for c in live if c is not base]
        return self._of([base]), self._of(later) if later else None

    def _newest(self) -> DataFrame:
        base, later = self._sides()
        return base if later is None else base.join(later, KEY, "left_anti").unionByName(later)

    def latest(self) -> DataFrame:
        """protein_id and path: what the newest delta says of each id."""
        return self._newest().where("NOT deleted").select(KEY, "path")

    def lookup(self, requested: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Requested ids (protein_id) with their newest path, and those that the index lacks; repeated ids count once."""
        base, later = self._sides()
        ids = requested.select(F.col(KEY).cast("string").alias(KEY)).distinct()
        told = ids.join(base.select(KEY, F.struct("path", "deleted").alias("v")), KEY, "left")
        if later is not None:
            told = told.join(later.select(KEY, F.struct("path", "deleted").alias("w")), KEY, "left").withColumn("v", F.coalesce("w", "v"))
        there = F.coalesce(~F.col("v.deleted"), F.lit(False))
        return told.where(there).select(KEY, "v.path"), told.where(~there).select(KEY)

    def compact(self, run: str | None = None) -> Commit | None:
        """Writes what is newest as one folder, and commits that in place of all there is; None where that is one folder already.

        Appends that are committed meanwhile stay newer.
        """
        live = self.live()
        if len(live) < 2:
            return None
        upto = max(c.seq for c in live)
        folder = self._write(self._newest().where("NOT deleted").select(KEY, "path", "deleted", "seq"))
        return self._commit(run or uuid.uuid4().hex, folder, upto)

    def vacuum(self) -> int:
        """Deletes folders that no live commit names, and tells how many. Only when no other reader or writer is at work."""
        fs, p = self._path(f"{self.root}/deltas")
        keep = {c.folder for c in self.live()}
        gone = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName() not in keep] if fs.exists(p) else []
        for g in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(g.getName())}")
            fs.delete(g, True)
        return len(gone)
