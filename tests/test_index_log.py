"""The growing index: appends, deletions, compaction, reruns, plans without an exchange, and the stream that builds on it."""

import json
import re

import pytest

from helixframe.operators import catalog
from helixframe.sources import readers
from helixframe.sources.index_log import IndexLog
from helixframe.streaming import incremental

ROWS = "protein_id string, path string, at int"


def index(spark, *rows):
    return spark.createDataFrame(rows, ROWS).repartition(3)


def held(log):
    return dict(map(tuple, log.latest().collect()))


@pytest.fixture
def log(spark, tmp_path):
    return IndexLog(spark, str(tmp_path / "log"), buckets=4)


def test_newest_wins(spark, log):
    assert held(log) == {} and log.compact() is None
    log.append(index(spark, ("a", "1", 1), ("a", "2", 0), ("b", "3", 0), (None, "x", 0), ("c", None, 0)), order=("at",))
    assert held(log) == {"a": "1", "b": "3", "c": None}
    log.append(index(spark, ("a", "4", 0), ("a", "4", 0)))
    log.append(index(spark, ("b", None, 0)), deleted=True)
    log.append(index(spark).limit(0))
    assert held(log) == {"a": "4", "c": None}
    log.append(index(spark, ("b", "5", 0)))
    assert held(log) == {"a": "4", "b": "5", "c": None}


def test_compaction_keeps_what_is_newer(spark, log):
    for k in range(4):
        log.append(index(spark, ("a", f"a{k}", 0), (f"p{k}", f"{k}", 0)))
    log.append(index(spark, ("p1", "", 0)), deleted=True)
    before = held(log)
    # an append that is committed between a compaction's read and its commit
    write, late = log._write, []

    def slow(rows):
        folder = write(rows)
        log._write = write
        late.append(log.append(index(spark, ("a", "late", 0))))
        return folder

    log._write = slow
    made = log.compact()
    assert made.seq > late[0].seq > made.contains and held(log) == before | {"a": "late"}
    assert [c.contains for c in log.live()] == [-1, 4] and log.vacuum() == 5
    assert held(log) == before | {"a": "late"}
    assert log.compact() and held(log) == before | {"a": "late"} and len(log.live()) == 1


def test_reruns_and_crashes(spark, log):
    first = log.append(index(spark, ("a", "1", 0)), "run-1")
    assert log.append(index(spark, ("a", "2", 0)), "run-1") == first and held(log) == {"a": "1"}
    log._write(log._newest())  # files without a commit
    assert log._create(f"{log.root}/log/{7:012d}.json", "{unfinished")
    assert held(log) == {"a": "1"}
    assert log.append(index(spark, ("b", "2", 0)), "run-2").seq == 8
    assert not log._create(f"{log.root}/log/{8:012d}.json", "other") and held(log) == {"a": "1", "b": "2"}
    again = IndexLog(spark, log.root, buckets=99)  # the log's own number counts
    assert again.buckets == 4 and held(again) == {"a": "1", "b": "2"}
    for c in log.live():  # as in a new session, which knows no tables
        spark.sql(f"DROP TABLE {log._name(c.folder)}")
    assert held(again) == {"a": "1", "b": "2"}


def exchanges_above(df, folder):
    """Exchanges through which the rows of a folder go."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda s: len(re.match(r"[ :|+\-*(\d)]*", s).group())
    found = 0
    for k, line in enumerate(lines):
        if "FileScan" in line and folder in line:
            at = depth(line)
            for above in reversed(lines[:k]):
                if depth(above) < at:
                    at = depth(above)
                    found += "Exchange " in above
    return found


def test_the_index_is_not_shuffled(spark, log):
    for k in range(3):
        log.append(spark.range(k, 3000, 2).selectExpr("concat('p', id) AS protein_id", f"'{k}' AS path"))
    base = log.compact().folder
    last = log.append(spark.range(0, 3000, 100).selectExpr("concat('p', id) AS protein_id", "'new' AS path")).folder
    log.append(spark.range(50, 3000, 100).selectExpr("concat('p', id) AS protein_id", "'' AS path"), deleted=True)
    asked = spark.range(2000).selectExpr("concat('p', id * 2) AS protein_id").union(spark.createDataFrame([(None,), ("p0",)], "protein_id string"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        present, missing = log.lookup(asked)
        for df, n in ((log.latest(), 2970), (present, 1470), (missing, 531)):
            assert exchanges_above(df, base) == 0 and exchanges_above(df, last) > 0
            assert df.count() == n
        assert {r.path for r in present.where("protein_id IN ('p0', 'p100')").collect()} == {"new"}
        assert sorted(map(tuple, present.collect())) == sorted(map(tuple, catalog.present_missing(asked.where("protein_id IS NOT NULL").distinct(), log.latest())[0].collect()))
    finally:
        for k in off:
            spark.conf.unset(k)


def test_json_index_with_ids_that_repeat(spark, tmp_path):
    rows = index(spark, ("a", "1", 2), ("a", "2", 1), ("b", "2", 0), ("b", "2", 0), ("c", None, 0), (None, "9", 0))
    readers.write_json_index(rows, str(tmp_path / "x"), order=("at",))
    assert sorted(map(tuple, readers.json_index(spark, str(tmp_path / "x.idx"), lines=True).collect())) == [("a", "1"), ("b", "2"), ("c", None)]
    assert sorted(map(tuple, readers.json_index(spark, str(tmp_path / "x_reversed.idx"), reverse=True, lines=True).collect())) == [("a", "1"), ("b", "2")]
    many = spark.range(500).selectExpr("concat('p', id) AS protein_id", "concat('f', id % 7) AS path")
    readers.write_json_index(many, str(tmp_path / "y"), each=50)
    lines = [r.value for r in spark.read.text(str(tmp_path / "y.idx")).collect()]
    assert len(lines) == 10 and sum(len(json.loads(x)) for x in lines) == 500
    readers.write_json_index(many.limit(0), str(tmp_path / "z"))
    assert spark.read.text(str(tmp_path / "z.idx")).count() == 0


def test_stream_builds_each_id_once(spark, tmp_path, log):
    ids, built, broken = tmp_path / "ids", [], []
    ids.mkdir()
    log.append(index(spark, ("a", "old", 0)))

    def build(new, number):
        found = sorted(r.protein_id for r in new.collect())
        if broken:
            raise RuntimeError("a store is away")
        built.append(found)
        return new.selectExpr("protein_id", f"'batch {number}' AS path").where("protein_id <> 'lost'")

    def run():
        incremental.build_missing(incremental.watch_ids(spark, str(ids), 1), log, build, str(tmp_path / "cp")).awaitTermination()

    (ids / "1.txt").write_text("a\nb\nb\nlost\n")
    run()
    assert built == [["b", "lost"]] and held(log) == {"a": "old", "b": "batch 0"}
    (ids / "2.txt").write_text("b\nc\na\n")
    broken.append(True)
    with pytest.raises(Exception, match="store is away"):
        run()
    broken.clear()
    run()  # from the checkpoint: the batch that failed runs again
    assert built[1:] == [["c"]] and held(log) == {"a": "old", "b": "batch 0", "c": "batch 1"}
    n = len(log.commits())
    (ids / "3.txt").write_text("c\nlost\n")
    run()
    assert built[2:] == [] and len(log.commits()) == n


def test_stream_from_nothing(spark, tmp_path, log):
    (tmp_path / "ids").mkdir()
    (tmp_path / "ids" / "1.txt").write_text("x\n\ny\nx\n")
    q = incremental.build_missing(incremental.watch_ids(spark, str(tmp_path / "ids")), log, lambda new, n: new.selectExpr("protein_id", "'p' AS path"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert held(log) == {"x": "p", "y": "p"}


def test_stream_keeps_its_ids_in_sparks_state(spark, tmp_path, log):
    """Known ids that come with new ones in the first batch, and in later ones; no Python process is asked key by key."""
    (tmp_path / "ids").mkdir()
    log.append(spark.range(0, 3000, 3).selectExpr("cast(id AS string) AS protein_id", "'old' AS path"))
    for k in range(3):
        (tmp_path / "ids" / f"{k}.txt").write_text("".join(f"{i}\n" for i in range(2000) if i % 4 != k))
    q = incremental.build_missing(incremental.watch_ids(spark, str(tmp_path / "ids"), 1), log, lambda new, n: new.selectExpr("protein_id", "'made' AS path"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert {o.operatorName for p in q.recentProgress for o in p.stateOperators} == {"dedupe"}
    assert held(log) == {str(i): "old" if i % 3 == 0 else "made" for i in range(3000) if i < 2000 or i % 3 == 0}
